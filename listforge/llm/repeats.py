"""What substring operators share: candidate runs of windows under content-determined keys.

Both substring operators give every window (of words or of bytes) a key that depends on the window's content alone, so
equal windows have equal keys wherever they stand. Consecutive windows of a document under one key are a run
(key, doc_id, run), where ``run`` packs its first window, their number and some bits of the text's hash, so that few bytes are
shuffled. A key that occurs
once clears its run; the others are candidates.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more runs is hot: its windows are dealt out one by one, by their own content.
HOT = 2_000
#: Up to so many bytes of spans are sent to every executor; beyond, the spans are joined by shuffle.
SEND_BYTES = 32 << 20


#: Bits of a text's hash that go with doc_id, so that rows which repeat a doc_id with another text stay apart.
TEXT_BITS = 20


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text) of the rows with a doc_id."""
    rows = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long"), "text")
    return rows.select("doc_id", text_hash().alias("th"), "text")


def text_hash() -> Column:
    return F.xxhash64("text").bitwiseAND((1 << TEXT_BITS) - 1).cast("int")


def candidates(runs: DataFrame, across: bool, hot: int = HOT) -> DataFrame:
    """(doc_id, th, hits array<long>): by row the packed runs whose key occurs again, shifted left by a bit for hot keys.

    across: only keys of two or more documents count.
    """
    keys = runs.groupBy("key").agg(F.count("*").alias("c"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    keys = keys.where("lo < hi") if across else keys.where("c > 1 OR lo < hi")
    # another expression than the grouping's: both sides of the join get a plain exchange, so that a hot key can be split
    keys = keys.select(F.col("key").bitwiseXOR(F.lit(0)).alias("__k"), (F.col("c") > hot).alias("hot"))
    hit = F.shiftleft("run", 1) + F.col("hot").cast("long")
    found = runs.join(keys, F.col("key") == F.col("__k")).select("doc_id", F.shiftright("run", 8).bitwiseAND((1 << TEXT_BITS) - 1).cast("int").alias("th"), hit.alias("hit"))
    return found.groupBy("doc_id", "th").agg(F.collect_list("hit").alias("hits"))


def short_keys(key: np.ndarray) -> np.ndarray:
    """Keys for counting, of 48 bits: two that fall together only make one candidate more, and fewer bytes are shuffled."""
    return (key & np.uint64((1 << 48) - 1)).view(np.int64)


def pack_runs(start: np.ndarray, n: np.ndarray, th: np.ndarray) -> np.ndarray:
    """First window (under 2**34), the text's hash and the number of windows (under 256) in one integer."""
    return start.astype(np.int64) << 8 + TEXT_BITS | th.astype(np.int64) << 8 | n


def unpack_hits(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number, hot) of packed hits."""
    return hit >> 9 + TEXT_BITS, hit >> 1 & 255, (hit & 1).astype(bool)


def with_spans(docs: DataFrame, spans: DataFrame, size: str, limit: int = SEND_BYTES) -> DataFrame:
    """docs(doc_id, text) left-joined with spans(doc_id, th, ..., n bytes in column ``size``), which must be a written table.

    The spans are broadcast if all of them fit the limit, else both sides are shuffled.
    """
    total = spans.agg(F.sum(F.col(size) + 48)).first()[0] or 0
    spans = spans.withColumnsRenamed({"doc_id": "__id", "th": "__th"}).drop(size)
    side = F.broadcast(spans) if total <= limit else spans
    return docs.join(side, (F.col("doc_id") == F.col("__id")) & (text_hash() == F.col("__th")), "left").drop("__id", "__th")
