"""Hash trees over the keys of a version: what differs is found before any row is read.

A key's place is the top of its hash, so a node of the tree stands for a range of hashes. Its digest is made of sums over its rows,
without regard to order, so a node's digest is that of its children together. Equal roots say that two versions are the same;
else the tree is followed down through unequal nodes, and only the ranges at its bottom that differ are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .versioning import diff

#: Bits that each level adds, and keys of a range at the bottom.
FAN_BITS, RANGE_KEYS = 4, 50_000


def digest_columns(keys: Sequence[str], hash_col: str) -> list[Column]:
    """Aggregates that together tell the rows of a group apart from any others."""
    one = F.xxhash64(*keys, hash_col)
    two = F.xxhash64(F.lit(1), *keys, hash_col)
    return [F.count("*").alias("n"), F.bit_xor(one).alias("x"), F.sum(two.cast("decimal(20,0)")).alias("s")]


def roots(df: DataFrame, by: Sequence[str], keys: Sequence[str], hash_col: str) -> DataFrame:
    """by, root: one digest for each group, partially aggregated, so that no group's rows come together."""
    return df.groupBy(*by).agg(*digest_columns(keys, hash_col)).select(*by, F.concat_ws("-", F.col("n").cast("string"), F.hex("x"), F.col("s").cast("string")).alias("root"))


def range_of(keys: Sequence[str], depth: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit("place"), *keys), 64 - FAN_BITS * depth) if depth else F.lit(0).cast("long")


def depth_for(n: int, range_keys: int = RANGE_KEYS) -> int:
    """Levels below the root; at most five, so that a version has at most a million ranges."""
    depth = 0
    while depth < 5 and n > range_keys << FAN_BITS * depth:
        depth += 1
    return depth


def write(df: DataFrame, path: str, keys: Sequence[str], hash_col: str = "content_hash", range_keys: int = RANGE_KEYS) -> None:
    """Write a version by ranges, with its tree beside it: <path>/rows/range=<r>, <path>/tree; <path>/columns tells its columns."""
    df.limit(0).write.parquet(f"{path}/columns")
    depth = depth_for(df.count(), range_keys)
    df.withColumn("range", range_of(keys, depth)).repartition("range").write.partitionBy("range").parquet(f"{path}/rows")
    level = df.groupBy(range_of(keys, depth).alias("node")).agg(*digest_columns(keys, hash_col)).withColumn("level", F.lit(depth))
    tree = level
    for up in range(depth - 1, -1, -1):
        level = level.groupBy(F.shiftrightunsigned("node", FAN_BITS).alias("node")).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s")).withColumn("level", F.lit(up))
        tree = tree.unionByName(level.select(*tree.columns))
    tree.select("level", "node", "n", "x", F.col("s").cast("string").alias("s")).write.partitionBy("level").parquet(f"{path}/tree")


class Version:
    """A version written by ``write``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.tree = spark.read.schema("node long, n long, x long, s string, level int").parquet(f"{path}/tree")

    def depth(self) -> int:
        return self.tree.agg(F.max("level")).first()[0] or 0

    def count(self) -> int:
        return self.tree.where("level = 0").agg(F.sum("n")).first()[0] or 0

    def rows(self, ranges: Sequence[int] | None = None) -> DataFrame:
        """Rows of some ranges; the folders of others aren't listed for reading."""
        schema = self.spark.read.parquet(f"{self.path}/columns").schema.add("range", "long")
        df = self.spark.read.schema(schema).parquet(f"{self.path}/rows")
        return (df if ranges is None else df.where(F.col("range").isin([int(r) for r in ranges]))).drop("range")


def changed_ranges(old: Version, new: Version) -> tuple[int, list[int]]:
    """(depth, ranges that differ at it), found from the root down; the depth is that of the shallower tree."""
    depth, nodes = min(old.depth(), new.depth()), None
    for level in range(depth + 1):
        side = lambda v: v.tree.where(F.col("level") == level).select("node", F.struct("n", "x", "s").alias("d"))  # noqa: B023, E731
        a, b = side(old), side(new).withColumnRenamed("d", "e")
        if nodes is not None:
            below = F.shiftrightunsigned("node", FAN_BITS).isin(nodes)
            a, b = a.where(below), b.where(below)
        nodes = [r["node"] for r in a.join(b, "node", "full_outer").where(~F.col("d").eqNullSafe(F.col("e"))).select("node").collect()]
        if not nodes:
            return depth, []
    return depth, nodes


def _under(v: Version, depth: int, ranges: Sequence[int]) -> list[int]:
    """The ranges of a version below those of a shallower depth."""
    own = v.depth()
    found = v.tree.where((F.col("level") == own) & F.shiftrightunsigned("node", FAN_BITS * (own - depth)).isin(list(ranges)))
    return [r["node"] for r in found.select("node").collect()]


def changes(old: Version, new: Version, keys: Sequence[str], hash_col: str = "content_hash", keep: Sequence[str] = ()) -> DataFrame:
    """The rows that differ (ADD, REMOVE, CHANGE), from the ranges that differ."""
    depth, ranges = changed_ranges(old, new)
    found = diff(old.rows(_under(old, depth, ranges)), new.rows(_under(new, depth, ranges)), keys, hash_col, keep)
    return found.where("change_type <> 'SAME'")


def preview(old: Version, new: Version, keys: Sequence[str], hash_col: str = "content_hash") -> DataFrame:
    """One row of counts as of a whole diff: added, removed, changed, unchanged, previous."""
    n = lambda kind: F.count_if(F.col("change_type") == kind)
    out = changes(old, new, keys, hash_col).agg(n("ADD").alias("added"), n("REMOVE").alias("removed"), n("CHANGE").alias("changed"))
    before = F.lit(old.count()).cast("long")
    return out.select("added", "removed", "changed", (before - F.col("removed") - F.col("changed")).alias("unchanged"), before.alias("previous"))
