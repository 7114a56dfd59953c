"""SimHash near-dedup through a segment-popcount embedding.

1. A 64-bit fingerprint per document (Arrow batches; XXH64 of word shingles, majority vote per bit).
2. Equal fingerprints collapse to one; everything below runs on distinct fingerprints.
3. Each fingerprint is embedded as the bit counts of 32 two-bit segments. Flipping one bit moves the vector by one in
   Manhattan distance, so that distance is a lower bound of the Hamming distance.
4. Grid range-join: the 32 coordinates form ``2 + radius`` blocks. Vectors within Manhattan distance ``radius`` differ in
   at most ``radius`` blocks, so they agree on two blocks at least: the cells of the grid are the pairs of blocks with
   their coordinates. Pairs that meet in a cell pass the Manhattan bound, then the exact Hamming test.
5. A cell with more than ``CELL`` fingerprints isn't paired. Its members go through radius-one balls: two fingerprints
   within 2 bits have a common word within 1 bit of each, and any two that share such a word are within 2 bits, so linking
   each member to the words of its ball gives the same components with 65 rows a member and no pairs.
6. Components by star contraction.

Defined results: a null or wordless text has fingerprint zero. Rows without doc_id take part with their fingerprint but
can't name a component: they get the smallest doc_id of it (null if none has one). Repeated rows give repeated rows. Texts of any
length are voted whole. An empty table gives an empty result. Further columns, of whatever name, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel
from ..session import durable
from .components import components

SHINGLE, RADIUS, SEGMENT, CELL = 3, 2, 2, 64
#: Long texts are voted in blocks of so many shingles.
BLOCK = 50_000


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of one text in UTF-8."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    n = max(len(words) - width + 1, 1)
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[:n].tolist()
    ends = ends[min(width, len(words)) - 1 :].tolist()
    votes, h = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for a in range(0, n, BLOCK):
        block = np.array([h(joined[s:e], 42) for s, e in zip(starts[a : a + BLOCK], ends[a : a + BLOCK], strict=True)], dtype=np.uint64)
        votes += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


_LOWER = bytes(kernel.ASCII_LOWER)


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long): the fingerprint as a signed 64-bit value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = kernel.utf8(b.column("text"))
            raw = [fingerprint(data[off[i] : off[i + 1]].tobytes(), width) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.array(raw, dtype=np.uint64).view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def embedding(fp: Column, segment: int = SEGMENT) -> list[Column]:
    """Bit counts of the segments."""
    mask = (1 << segment) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, i).bitwiseAND(mask)) for i in range(0, 64, segment)]


def near_links(fps: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """Distinct fps(fp) -> edges (u, v) whose components are those of the links within ``radius`` (2 at most)."""
    if radius != 2:
        raise ValueError("the exact way for crowded cells holds for radius 2")
    blocks = radius + 2
    width = 64 // SEGMENT // blocks
    counts = fps.withColumn("vec", F.array(*embedding(F.col("fp"))))

    base = SEGMENT + 1

    def code(block: int) -> Column:
        return sum((F.get("vec", F.lit(block * width + i)) * base**i for i in range(width)), F.lit(0))

    side = base**width
    corners = list(combinations(range(blocks), 2))
    cells = F.array(*[((F.lit(k) * side + code(a)) * side + code(b)).cast("long") for k, (a, b) in enumerate(corners)])

    def finer() -> Column:
        """Of a member of a cell, the codes of the three parts of the other blocks' coordinates."""
        of_pair = []
        for a, b in corners:
            rest = [x * width + i for x in range(blocks) if x not in (a, b) for i in range(width)]
            parts = [rest[0:6], rest[6:11], rest[11:]]
            of_pair.append(F.array(*[sum((F.get("vec", F.lit(c)) * base**i for i, c in enumerate(p)), F.lit(0)) for p in parts]))
        pick = F.array(*of_pair)[(F.col("cell") / (side * side)).cast("int")]
        return F.transform(pick, lambda x, j: ((F.col("cell") * 3 + j) * base**6 + x).cast("long"))

    def split(member: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of cells that are paired, and of crowded ones; a member that is alone leaves."""
        sizes = member.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > 1).select(F.col("cell").bitwiseXOR(F.lit(0)).alias("__c"), "n")
        known = member.join(sizes, F.col("cell") == F.col("__c")).drop("__c")
        return known.where(F.col("n") <= cell).drop("n"), known.where(F.col("n") > cell).drop("n")

    apart = sum((F.abs(a - b) for a, b in zip(embedding(F.col("u")), embedding(F.col("v")), strict=True)), F.lit(0))

    def paired(sparse: DataFrame) -> DataFrame:
        left, right = sparse.select("cell", F.col("fp").alias("u")), sparse.select("cell", F.col("fp").alias("v"))
        near = left.join(right, "cell").where(F.col("u") < F.col("v")).where(apart <= radius)
        return near.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius).select("u", "v")

    sparse, crowded = split(counts.select("fp", F.explode(cells).alias("cell")))
    fine, dense = split(crowded.withColumn("vec", F.array(*embedding(F.col("fp")))).select("fp", F.explode(finer()).alias("cell")))
    pairs = paired(sparse).union(paired(fine))
    dense = dense.select("fp").distinct()
    flips = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])
    ball = dense.select("fp", F.explode(flips).alias("word"))
    heads = ball.groupBy("word").agg(F.min("fp").alias("head"), F.count("*").alias("n")).where(F.col("n") > 1)
    balls = ball.join(heads, "word").where(F.col("fp") != F.col("head")).select(F.col("head").alias("u"), F.col("fp").alias("v"))
    return pairs.union(balls).distinct()


def near_components(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """prints(doc_id, fp) -> doc_id, fp, component_id."""
    prints = durable(prints, "prints")
    firsts = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "fps")
    linked = components(near_links(firsts.select("fp"), radius))
    classes = firsts.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    heads = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = classes.join(heads, "component").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def op7(spark: SparkSession, docs: DataFrame) -> DataFrame:
    out = near_components(fingerprints(docs))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
