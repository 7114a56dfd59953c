"""Near copies by word shingles: one text of each group of texts of Jaccard similarity ``LEAST`` or more stays.

1. A text is the set of its hashed shingles of ``WIDTH`` words (A-Z lower-cased). Texts of equal sets collapse to one.
2. Every set gets a 64-bit SimHash of its shingles; pairs within 2 bits come from the segment-popcount grid of ``simhash``.
   Pairs of similarity 0.8 lie up to 11 bits apart, where a grid of segments no longer divides the texts, so
3. ``BANDS`` band keys a set, each of ``ROWS`` least hashes, give the others. Two sets of similarity s share a key with
   probability 1 - (1 - s**ROWS)**BANDS: 0.9996 at 0.8, and more above.
4. The sets of a cell (a band key) are paired. In a cell of more than ``CELL`` sets each one is first paired with ``HEADS`` of
   them: those least under fixed orders, so that the cells of one group choose mostly the same.
5. Every pair is tested on the whole sets; only pairs of ``LEAST`` or more are links. Components by star contraction.
6. A crowded cell whose sets are by then in one component is settled: further links in it change nothing. The sets of the
   others get ``LONG_BANDS`` keys of ``LONG_ROWS`` least hashes. In the cells of these each component is first stood for by one set; components
   that this links are one from then on, and then all pairs across components that are left are
   tested, without limit. Two sets of 0.8 share such a key with probability 0.9994. This is the way for all that step 4 leaves;
   its work grows with pairs of similar sets in different components, not with copies of one text.

Defined results: null and wordless texts are equal; a text under ``WIDTH`` words is one shingle. Rows without doc_id stay. Rows
that repeat a doc_id stay or go together. Texts of any length are compared whole. An empty table stays empty. Further columns,
of whatever name, stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from . import kernel
from .common import fresh
from .components import components
from .simhash import near_links

WIDTH, LEAST, BANDS, ROWS, CELL, HEADS = 5, 0.8, 20, 5, 16, 4
LONG_BANDS, LONG_ROWS = 40, 8
_HASHES = BANDS * ROWS + LONG_BANDS * LONG_ROWS  # the long keys take hashes of their own
_SALT, _ODD = kernel._splitmix(_HASHES, 11), kernel._splitmix(_HASHES, 13) | np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(distinct hashes, offsets by document); no document is without a hash."""
    low = kernel.ASCII_LOWER[data]
    starts, ends, by_doc = kernel.words(low, offsets)
    h = kernel.hash_spans(low, starts, ends)
    n = np.diff(by_doc)
    rolled = kernel.rolling(h, width)
    long = np.flatnonzero(n >= width)
    count = np.where(n >= width, n - width + 1, 1)
    to = np.concatenate([[0], np.cumsum(count)])
    out = np.zeros(to[-1], np.uint64)
    if len(long):
        at = np.arange(count[long].sum()) - np.repeat(np.cumsum(count[long]) - count[long], count[long])
        out[np.repeat(to[long], count[long]) + at] = rolled[np.repeat(by_doc[long], count[long]) + at]
    for d in np.flatnonzero((n < width) & (n > 0)).tolist():
        out[to[d]] = kernel.rolling(h[by_doc[d] : by_doc[d + 1]], int(n[d]))[0] + np.uint64(n[d])
    doc = np.repeat(np.arange(len(n)), count)
    order = np.lexsort((out, doc))
    out, doc = kernel.mix(out[order], 5), doc[order]
    first = np.ones(len(out), bool)
    first[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[first], np.searchsorted(doc[first], np.arange(len(n) + 1))


def bands(sets: np.ndarray, offsets: np.ndarray, count: int = BANDS, rows: int = ROWS, skip: int = 0) -> np.ndarray:
    """Band keys, a row for each document; ``skip`` hashes are left to other keys."""
    keys = np.zeros((len(offsets) - 1, count), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(count * rows):
            b, h = k // rows, skip + k
            keys[:, b] = kernel.mix(keys[:, b] * kernel.BASE + np.minimum.reduceat((sets ^ _SALT[h]) * _ODD[h], offsets[:-1]), b)
    return keys


def fingerprints(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """SimHash of each document's shingles: a bit is 1 if set in over half of them."""
    out = np.zeros(len(offsets) - 1, np.uint64)
    n = np.diff(offsets)
    for bit in range(64):
        votes = np.add.reduceat(((sets >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), offsets[:-1])
        out |= (2 * votes > n).astype(np.uint64) << np.uint64(bit)
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = kernel.utf8(batch.column("text"))
        for i, j, d, o in kernel.chunks(data, off):
            s, by = shingles(d, o)
            keys = bands(s, by)
            whole = kernel.mix(np.add.reduceat(s, by[:-1]) + np.diff(by).astype(np.uint64), 3)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(i, j - i), batch.column("th").slice(i, j - i), pa.array(whole.view(np.int64)), pa.array(fingerprints(s, by).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1).view(np.int64))),
                ],
                ["doc_id", "th", "sh", "fp", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, off = kernel.utf8(batch.column("text"))
        for i, j, d, o in kernel.chunks(data, off):
            s, by = shingles(d, o)
            yield pa.RecordBatch.from_arrays(
                [batch.column("sh").slice(i, j - i), pa.ListArray.from_arrays(pa.array(by.astype(np.int32)), pa.array(s.view(np.int64)))], ["sh", "set"]
            )


def _long_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sets = batch.column("set")
        off = sets.offsets.to_numpy()
        keys = bands(sets.values.to_numpy().view(np.uint64)[off[0] : off[-1]], off - off[0], LONG_BANDS, LONG_ROWS, BANDS * ROWS)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * LONG_BANDS), pa.array(keys.reshape(-1).view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("sh"), batch.column("component"), pa.array(np.diff(off).astype(np.int64)), lists], ["sh", "component", "n", "bands"])


def cells(firsts: DataFrame, heads: int = HEADS) -> DataFrame:
    """firsts(sh, bands) -> (cell, sh, n, heads) of the cells of two sets and more."""
    member = firsts.select("sh", F.explode("bands").alias("cell"))
    orders = [F.xxhash64(F.lit(k), "sh") for k in range(heads)]
    picked = F.array_distinct(F.array(*[F.min_by("sh", o) for o in orders]))
    sizes = member.groupBy("cell").agg(F.count("*").alias("n"), picked.alias("heads")).where("n > 1")
    return member.join(sizes.select(F.col("cell").bitwiseXOR(F.lit(0)).alias("__c"), "n", "heads"), F.col("cell") == F.col("__c")).drop("__c")


def candidates(known: DataFrame, crowded: DataFrame, cell: int = CELL) -> DataFrame:
    """Pairs (u, v), u < v: all of cells of ``cell`` sets at most, those with the heads of crowded ones."""
    sparse = known.where(F.col("n") <= cell)
    pairs = sparse.select("cell", F.col("sh").alias("u")).join(sparse.select("cell", F.col("sh").alias("v")), "cell").where("u < v").select("u", "v")
    headed = crowded.select("sh", F.explode("heads").alias("h")).where("sh <> h")
    return pairs.union(headed.select(F.least("sh", "h").alias("u"), F.greatest("sh", "h").alias("v"))).distinct()


def between(member: DataFrame, least: float) -> DataFrame:
    """member(cell, sh, component, n) -> pairs (u, v, cu, cv) of sets of different components that meet in a cell and may be alike by their sizes."""
    left, right = (member.select("cell", *[F.col(c).alias(c + side) for c in ("sh", "component", "n")]) for side in "uv")
    met = left.join(right, "cell").where("componentu < componentv").where(F.least("nu", "nv") >= least * F.greatest("nu", "nv"))
    return met.select(F.col("shu").alias("u"), F.col("shv").alias("v"), F.col("componentu").alias("cu"), F.col("componentv").alias("cv")).distinct()


def across(crowded: DataFrame, sets: DataFrame, found: DataFrame, least: float = LEAST) -> DataFrame:
    """Links (u, v) that crowded cells leave open: of sets in different components of the links that are found.

    Each component first sends one set to each cell. What these link is one component from then on, and only the sets of components that
    are still apart are paired with one another.
    """
    parts = components(found).withColumnRenamed("node", "sh")
    state = crowded.select("cell", "sh").join(parts, "sh", "left").withColumn("component", F.coalesce("component", "sh"))

    def mixed(member: DataFrame) -> DataFrame:
        spans = member.groupBy("cell").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
        return member.join(spans.select(F.col("cell").bitwiseXOR(F.lit(0)).alias("__c")), F.col("cell") == F.col("__c")).drop("__c")

    still = mixed(state).select("sh", "component").distinct()
    keyed = still.join(sets, "sh").select("sh", "component", "set").mapInArrow(_long_bands, "sh long, component long, n long, bands array<long>")
    member = durable(mixed(durable(keyed, "long-bands").select("sh", "component", "n", F.explode("bands").alias("cell"))), "open-cells")
    heads = member.groupBy("cell", "component").agg(F.min(F.struct("n", "sh")).alias("h")).select("cell", "component", "h.sh", "h.n")
    first = durable(between(heads, least), "first-pairs")
    linked = durable(verified(first.select("u", "v").distinct(), sets, least), "first-links")
    merged = components(linked.join(first, ["u", "v"]).select(F.col("cu").alias("u"), F.col("cv").alias("v")).distinct())
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("into"))
    apart = member.join(merged, "component", "left").withColumn("component", F.coalesce("into", "component")).drop("into")
    rest = between(mixed(apart), least).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    return linked.union(verified(durable(rest, "open-pairs"), sets, least))


def simhash_pairs(firsts: DataFrame) -> DataFrame:
    """firsts(sh, fp) -> pairs (u, v) of sets whose fingerprints are equal or in one SimHash link; of equal ones each with the first."""
    heads = durable(firsts.groupBy("fp").agg(F.min("sh").alias("head")), "fps")
    equal = firsts.select("sh", "fp").join(heads, "fp").where("sh <> head").select("sh", "head")
    found = durable(near_links(heads.select("fp")), "fp-links")  # a plan of its own: the driver holds one at a time
    near = found.join(heads.select(F.col("fp").alias("u"), F.col("head").alias("hu")), "u").join(heads.select(F.col("fp").alias("v"), F.col("head").alias("hv")), "v")
    return equal.union(near.select("hu", "hv")).select(F.least("sh", "head").alias("u"), F.greatest("sh", "head").alias("v"))


def verified(pairs: DataFrame, sets: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs whose whole sets are as similar as wanted."""
    both = (
        pairs.join(sets.select(F.col("sh").alias("u"), F.col("set").alias("a")), "u")
        .join(sets.select(F.col("sh").alias("v"), F.col("set").alias("b")), "v")
        .where((F.least(F.size("a"), F.size("b")) >= least * F.greatest(F.size("a"), F.size("b"))))
        .withColumn("common", F.size(F.array_intersect("a", "b")))
    )
    return both.where(F.col("common") >= least * (F.size("a") + F.size("b") - F.col("common"))).select("u", "v")


def links(docs: DataFrame, signed: DataFrame, least: float = LEAST, cell: int = CELL, heads: int = HEADS) -> DataFrame:
    """Links (u, v) between the sets of ``signed`` whose components are those of all pairs as similar as wanted."""
    firsts = durable(signed.groupBy("sh").agg(F.min("th").alias("th"), F.min("fp").alias("fp"), F.min("bands").alias("bands")), "sets")
    known = cells(firsts, heads)
    crowded = durable(known.where(F.col("n") > cell).select("cell", "sh", "heads"), "crowded")
    pairs = durable(candidates(known, crowded, cell).union(simhash_pairs(firsts)).distinct(), "near-pairs")
    wanted = firsts.join(pairs.select(F.col("u").alias("sh")).union(pairs.select("v")).distinct(), "sh").select("sh", F.col("th").alias("__th"))
    texts = docs.select(F.xxhash64("text").alias("th"), "text").join(wanted, F.col("th") == F.col("__th")).dropDuplicates(["sh"]).select("sh", "text")
    sets = durable(texts.mapInArrow(_sets, "sh long, set array<long>"), "shingles")
    found = durable(verified(pairs, sets, least), "near-links")
    return found.union(across(crowded, sets, found, least))


def groups(docs: DataFrame, **limits) -> DataFrame:
    """(doc_id, component_id): component_id is the smallest doc_id of the row's group of near copies."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")
    signed = durable(rows.mapInArrow(_signatures, "doc_id long, th long, sh long, fp long, bands array<long>"), "bands")
    linked = components(links(docs, signed, **limits)).withColumnRenamed("node", "sh")
    firsts = signed.groupBy("sh").agg(F.min("doc_id").alias("first")).join(linked, "sh", "left").withColumn("component", F.coalesce("component", "sh"))
    heads = firsts.groupBy("component").agg(F.min("first").alias("component_id"))
    return signed.select("doc_id", "sh").join(firsts.join(heads, "component").select("sh", "component_id"), "sh").select("doc_id", "component_id")


def keep_one(docs: DataFrame, **limits) -> DataFrame:
    """docs without the near copies: of each group the row with the smallest doc_id stays; rows without doc_id stay."""
    (id_,) = fresh(docs, "__id")
    out = groups(docs, **limits).where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(id_)).distinct()
    return docs.join(out, docs["doc_id"] == F.col(id_), "left_anti")
