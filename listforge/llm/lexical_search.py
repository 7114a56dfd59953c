"""Ranked lexical search: pipelined evaluation over term owners.

The terms of the items are dealt to a few owners, rare terms first, so that each owner holds about as many postings as the others.
A bundle is an item's sparse accumulators over one block of documents. Bundles pass through the owners one after the other:
each stage cogroups them by block with the owner's postings, adds the integer contributions and hands them on. Between
stages the 50th best partial score of an item becomes its floor: an accumulator that can't reach it with all that is still to
come leaves its bundle. That bound is exact, so no document of a result is lost. The final selection ranks what is left.

Texts are read once; what follows reads an index with the terms of items only. Items are taken in blocks of ``ITEM_BYTES``
of terms, so what the driver and the tasks hold of them is bounded. Blocks of documents have ``BLOCK`` rows of one task of the
index, so no source, text or id can make a block large.

Defined cases: a null text has no terms and doesn't count; a document of null doc_id is ranked under a null id, last among equals;
rows that repeat a doc_id are documents of their own; rows of one item_id are one item with the terms of all; items of null item_id
and items without terms have no result rows; further columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import durable
from .common import ascii_lower, table

#: Code points that are in no term; A-Z come after lower-casing and never occur in terms.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bytes to bytes: separators become blanks, A-Z small letters; bytes from 0x80 on belong to terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Documents of a block, as a power of two; owners that a bundle passes; bytes of item terms held at once.
BLOCK_BITS, STAGES, ITEM_BYTES = 12, 4, 16 << 20
#: A text longer than this is counted in slices.
SLICE = 1 << 20
TOP = 50
#: Stands for a null doc_id inside the stages: sorts last.
NO_ID = (1 << 63) - 1

INDEX = "is_doc boolean, doc_id long, n long, terms array<int>, counts array<long>, most array<long>"
POSTINGS = "block long, pos int, doc_id long, m long, terms array<int>, tfs array<long>"
BUNDLES = "block long, item int, pos array<int>, acc array<long>, best array<long>, doc_ids array<long>"


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, terms): the different terms of an item."""
    found = items.where("item_id IS NOT NULL").select("item_id", F.explode(F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0)))).alias("term"))
    return found.groupBy("item_id").agg(F.collect_set("term").alias("terms"))


def slices(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, slice by slice; a slice ends at a separator."""
    low, at = raw.translate(TERM_BYTES), 0
    while len(low) - at > SLICE:
        end = low.find(b" ", at + SLICE)
        end = len(low) if end < 0 else end
        yield low[at:end].split()
        at = end
    yield low[at:].split()


def lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(kind.to_pandas_dtype(), copy=False), kind))


def _index(vocabulary):
    """Batches of (doc_id, text) to index rows; each task ends with one row of its own sums."""
    kinds = (pa.int32(), pa.int64(), pa.int64())

    def batch_of(flags, ids, ns, *columns):
        arrays = [pa.array(flags, pa.bool_()), pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), *map(lists, columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["is_doc", "doc_id", "n", "terms", "counts", "most"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        df, most = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
        n_docs = n_terms = 0
        none = np.zeros(0, np.int64)
        for batch in batches:
            ids, ns, terms, counts = [], [], [], []
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                seen: Counter = Counter()
                for words in slices(raw.as_py() or b""):
                    seen.update(words)
                n = seen.total()
                if not n:
                    continue
                hit = seen.keys() & number.keys()
                at, tf = np.fromiter((number[t] for t in hit), np.int64, len(hit)), np.fromiter((seen[t] for t in hit), np.int64, len(hit))
                df[at] += 1
                most[at] = np.maximum(most[at], tf)
                n_docs, n_terms = n_docs + 1, n_terms + n
                ids.append(doc_id), ns.append(n), terms.append(at), counts.append(tf)
            if ids:
                yield batch_of([True] * len(ids), ids, ns, terms, counts, [none] * len(ids))
        if n_docs:
            held = np.flatnonzero(df)
            yield batch_of([False], [n_docs], [n_terms], [held], [df[held]], [most[held]])

    return run


def _owned(owner: np.ndarray, stage: int, n_docs: int, n_terms: int):
    """Index rows to the postings of one owner; every document of the block comes along, with its length as m."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, counts = batch.column("terms"), batch.column("counts")
            flat, tfs = terms.flatten().to_numpy(zero_copy_only=False), counts.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(batch)), np.diff(terms.offsets.to_numpy()))
            mine = owner[flat] == stage
            offsets = np.zeros(len(batch) + 1, np.int32)
            np.cumsum(np.bincount(row[mine], minlength=len(batch)), out=offsets[1:])
            m = pa.array([50 + 50 * n * n_docs // n_terms for n in batch.column("n").to_pylist()], pa.int64())
            made = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[mine].astype(np.int32))), pa.ListArray.from_arrays(pa.array(offsets), pa.array(tfs[mine]))]
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("pos"), batch.column("doc_id"), m, *made], names=["block", "pos", "doc_id", "m", "terms", "tfs"])

    return run


def _pass_owner(held, floors: dict[int, int], last: bool, top: int):
    """Add one owner's contributions to the bundles of a block.

    held: broadcast (weight by term, [(item, its terms at this owner, most that is still to come)]).
    """

    def run(bundles: pa.Table, postings: pa.Table) -> pa.Table:
        weight, items = held.value
        size = 1 << BLOCK_BITS
        terms, tfs, pos = postings["terms"].combine_chunks(), postings["tfs"].combine_chunks(), postings["pos"].to_numpy()
        block = postings["block"][0].as_py()
        each = np.diff(terms.offsets.to_numpy())
        flat, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
        add = weight[flat] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(postings["m"].to_numpy(), each)))
        by_term = np.argsort(flat, kind="stable")
        where, add = np.repeat(pos, each)[by_term], add[by_term]
        there, start = np.unique(flat[by_term], return_index=True)
        ends = np.append(start[1:], len(flat))
        before = {}
        for item, p, a in zip(bundles["item"].to_pylist(), bundles["pos"], bundles["acc"], strict=True):
            before[item] = p.values.to_numpy(), a.values.to_numpy()
        out = []
        if last:
            names = np.full(size, NO_ID)
            known = postings["doc_id"].is_valid().to_numpy()
            names[pos[known]] = postings["doc_id"].filter(postings["doc_id"].is_valid()).to_numpy()
        for item, own, to_come in items:
            acc = np.zeros(size, np.int64)
            if item in before:
                acc[before[item][0]] = before[item][1]
            if len(there):
                at = np.searchsorted(there, own)
                at[at == len(there)] = 0
                for k in at[there[at] == own]:
                    acc[where[start[k] : ends[k]]] += add[start[k] : ends[k]]
            live = np.flatnonzero(acc)
            if not len(live):
                continue
            got = acc[live]
            best = -np.sort(-got)[:top] if len(got) <= 4 * top else -np.sort(-np.partition(got, len(got) - top)[-top:])
            least = max(floors.get(item, 1), int(best[-1]) if len(best) == top else 1)
            live = live[got + to_come >= least]
            if last and len(live) > top:
                live = live[np.lexsort((names[live], -acc[live]))[:top]]
            if len(live):
                out.append((item, live, acc[live], best, names[live] if last else live[:0]))
        cols = [pa.array(np.full(len(out), block), pa.int64()), pa.array([o[0] for o in out], pa.int32())]
        cols += [lists([o[k] for o in out], t) for k, t in ((1, pa.int32()), (2, pa.int64()), (3, pa.int64()), (4, pa.int64()))]
        return pa.Table.from_arrays(cols, names=["block", "item", "pos", "acc", "best", "doc_ids"])

    return run


def owners(df: np.ndarray, stages: int) -> np.ndarray:
    """The owner of each term: rare terms first, each owner with about the same number of postings."""
    order = np.argsort(df, kind="stable")
    total = np.cumsum(df[order])
    out = np.zeros(len(df), np.int64)
    out[order] = np.minimum((total - df[order]) * stages // max(int(total[-1]) if len(total) else 1, 1), stages - 1)
    return out


def _search_block(docs: DataFrame, items: list, id_type: str, top: int, stages: int) -> DataFrame | None:
    """Results of the items of one block, as (item_id, doc_id, score) with at most ``top`` rows an item and block."""
    spark = docs.sparkSession
    words = sorted({t for r in items for t in r["terms"]})
    number = {t.encode(): i for i, t in enumerate(words)}
    index = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_index(spark.sparkContext.broadcast(number)), INDEX)
    index = durable(index.withColumn("rid", F.monotonically_increasing_id()), "lexical-index")
    sums = index.where("NOT is_doc")
    n_docs, n_terms = (int(x or 0) for x in sums.agg(F.sum("doc_id"), F.sum("n")).first())
    if not n_docs:
        return None
    per_term = sums.select(F.explode(F.arrays_zip("terms", "counts", "most")).alias("t")).groupBy("t.terms").agg(F.sum("t.counts").alias("df"), F.max("t.most").alias("most")).toPandas()
    df, most = np.zeros(len(words), np.int64), np.ones(len(words), np.int64)
    df[per_term["terms"]], most[per_term["terms"]] = per_term["df"], per_term["most"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    owner = owners(df, stages)
    # m is 50 at least, so that no document adds more for a term than this
    limit = weight * (1_000_000_000 * most // (1000 * most + 1000))
    mine = [np.array(sorted(number[t.encode()] for t in r["terms"]), np.int64) for r in items]
    rows = index.where("is_doc").select(F.shiftright("rid", BLOCK_BITS).alias("block"), F.col("rid").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("pos"), "doc_id", "n", "terms", "counts")
    bundles, floors = spark.createDataFrame([], BUNDLES), {}
    for stage in range(stages):
        last = stage == stages - 1
        now = [(i, t[(owner[t] == stage) & (df[t] > 0)], int(limit[t[owner[t] > stage]].sum())) for i, t in enumerate(mine)]
        step = _pass_owner(spark.sparkContext.broadcast((weight, now)), floors, last, top)
        postings = rows.mapInArrow(_owned(owner, stage, n_docs, n_terms), POSTINGS)
        bundles = bundles.groupBy("block").cogroup(postings.groupBy("block")).applyInArrow(step, BUNDLES)
        if not last:
            bundles = durable(bundles, "lexical-bundles")
            best = bundles.select("item", F.explode("best").alias("s")).withColumn("k", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("s"))))
            floors = {r["item"]: r["s"] for r in best.where(F.col("k") <= top).groupBy("item").agg(F.min("s").alias("s"), F.count("*").alias("c")).where(F.col("c") == top).collect()}
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(items)], f"number int, item_id {id_type}")
    found = bundles.select("item", F.explode(F.arrays_zip("acc", "doc_ids")).alias("d")).select("item", F.col("d.acc").alias("score"), F.nullif("d.doc_ids", F.lit(NO_ID)).alias("doc_id"))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= top)
    return found.join(F.broadcast(names), F.col("item") == F.col("number")).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, stages: int = STAGES, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The ``top`` highest-scoring documents of each item: (item_id, rank int, doc_id long, score long)."""
    spark = docs.sparkSession
    terms = item_terms(items)
    total = terms.agg(F.sum(F.octet_length(F.array_join("terms", " ")))).first()[0] or 0
    blocks = max(1, -(-int(total) // item_bytes))
    id_type, out = dict(items.dtypes)["item_id"], None
    for b in range(blocks):
        # an item's block depends on its id alone; what is collected is a block
        part = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id").collect()
        found = _search_block(docs, part, id_type, top, stages) if part else None
        if found is not None:
            out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH words AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL),
docs AS (SELECT rid, doc_id, ts, len(ts) AS n FROM words WHERE len(ts) > 0),
corpus AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM docs),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE item_id IS NOT NULL),
tf AS (SELECT rid, doc_id, n, term, count(*) AS tf FROM (SELECT rid, doc_id, n, unnest(ts) AS term FROM docs) GROUP BY rid, doc_id, n, term),
held AS (SELECT * FROM tf WHERE term IN (SELECT term FROM items)),
weights AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * big_n + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM held, corpus GROUP BY term, big_n),
parts AS (
  SELECT i.item_id, h.rid, h.doc_id, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * big_n) // big_l)))) AS s
  FROM items i JOIN held h USING (term) JOIN weights USING (term), corpus),
scores AS (SELECT item_id, rid, doc_id, CAST(sum(s) AS BIGINT) AS score FROM parts GROUP BY item_id, rid, doc_id HAVING sum(s) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
