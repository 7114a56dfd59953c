"""Best-fit packing in bulk-synchronous supersteps.

Documents of equal length are interchangeable, so a superstep handles all documents of one length at once, longest first:
they take the smallest gaps that hold them (successor sweep over the sorted gaps), documents beyond the gaps' number are
told apart by rank and move to the next larger gap, gaps are updated, and what finds no gap opens sequences. The state of
a superstep is a histogram of lengths and gaps: ``capacity`` rows at most, at any size of the corpus, so the sweep runs
on it directly. Tokenising, ranking and placing the documents are distributed: a piece's rank among the pieces of its
length comes from counts per (length, bucket), and its place from the sorted list of rank runs.

Defined results: a null or empty text is one piece of the closing id. Rows that repeat a doc_id, or have none, are packed
one by one. An empty table gives no pieces. Further columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import durable
from . import kernel
from .tokens import default_path, word_ids

CAPACITY, END_ID, PER_BUCKET = 2048, 0, 20_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece of each document: its ids closed by END_ID, cut where they exceed the capacity."""
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(tokenizer)
        for b in batches:
            data, off = kernel.utf8(b.column("text"))
            rows: list[tuple] = []
            for i, doc in enumerate(b.column("doc_id").to_pylist()):
                raw = ids.text(data[off[i] : off[i + 1]].tobytes()) + end
                for k, a in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[a : a + 4 * capacity]
                    rows.append((doc, k, a // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_fit(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Supersteps over {length: count} -> runs (length, first rank, count, first sequence, offset).

    The i-th document of a run goes to the i-th sequence from the first on, at the offset.
    """
    sizes: list[int] = []  # gaps that exist, ascending
    held: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences (first, count)
    runs, opened = [], 0

    def give(gap: int, first: int, n: int) -> None:
        if gap > 0:
            if gap not in held:
                insort(sizes, gap)
                held[gap] = []
            held[gap].append((first, n))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, n = held[gap].pop()
                take = min(n, left)
                if take < n:
                    held[gap].append((first + take, n - take))
                if not held[gap]:
                    del held[gap]
                    sizes.pop(at)
            else:  # as many new sequences as these documents fill
                per = capacity // length
                gap, first, take = capacity, opened, -(-left // per)
                opened += take
            runs.append((length, rank, take, first, capacity - gap))
            give(gap - length, first, take)
            rank, left = rank + take, left - take
    return runs


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces(length, ...) plus sequence_id and offset."""
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").count().collect()  # capacity rows at most
    total = sum(r["count"] for r in counted)
    buckets = max(1, total // PER_BUCKET)
    keyed = pieces.withColumn("__b", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    cells = keyed.groupBy("length", "__b").agg(F.count("*").alias("__c"))
    before = F.sum("__c").over(Window.partitionBy("length").orderBy("__b")) - F.col("__c")
    cells = cells.select("length", "__b", before.alias("__r0"))
    inside = Window.partitionBy("length", "__b").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.join(cells, ["length", "__b"]).withColumn("__rank", F.col("__r0") + F.row_number().over(inside) - 1).drop("__b", "__r0")

    runs = sorted(best_fit({r["length"]: r["count"] for r in counted}, capacity))
    base = np.array(runs, dtype=np.int64).reshape(-1, 5)
    plan = spark.sparkContext.broadcast((base[:, 0] << 42 | base[:, 1], base[:, 3], base[:, 4]))  # rank runs of bounded lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, firsts, offsets = plan.value
        for b in batches:
            key = (b.column("length").to_numpy() << 42) | b.column("__rank").to_numpy()
            at = np.searchsorted(keys, key, "right") - 1
            keep = [n for n in b.schema.names if n != "__rank"]
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in keep] + [pa.array(firsts[at] + key - keys[at]), pa.array(offsets[at])], [*keep, "sequence_id", "offset"]
            )

    fields = ", ".join(f"`{n}` {t}" for n, t in ranked.drop("__rank").dtypes)
    return ranked.mapInArrow(run, fields + ", sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of docs with their places."""
    return place(durable(cut(docs, tokenizer or default_path(), capacity), "pieces"), capacity)


def op4(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return pack(docs.select("doc_id", "text"))
