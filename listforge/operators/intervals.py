"""Validity intervals met by many points at once, as an equi-join.

An interval [from, to) of length up to 2**k touches at most two blocks of 2**k, so it stands under one or two keys (k, block). A point
lies in one block of each size, so it is looked up under as many keys as there are sizes. What meets under a key is then held against the
interval itself. Each interval meets a point at most once, as a point lies in one block of the interval's own size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sizes of blocks, as powers of two; an interval without an end, or longer than the largest, stands under one key for all points.
SIZES = 40


def _level(start: Column, end: Column) -> Column:
    """The least k with 2**k >= length; SIZES for what has no end."""
    length = end - start
    k = F.length(F.bin(length - 1))  # of length 2 and more
    return F.when(end.isNull() | (k > SIZES - 1), SIZES).when(length <= 1, 0).otherwise(k).cast("int")


def indexed(intervals: DataFrame, start: str, end: str) -> DataFrame:
    """The intervals with their keys ``level`` and ``block``, one or two rows each; empty intervals have none."""
    a, b, k = F.col(start).cast("long"), F.col(end).cast("long"), F.col("level")
    held = intervals.where(b.isNull() | (a < b)).withColumn("level", _level(a, b))
    shift = lambda v: F.call_function("shiftright", v, k)
    blocks = F.when(k == SIZES, F.array(F.lit(0).cast("long"))).otherwise(F.array_distinct(F.array(shift(a), shift(b - 1))))
    return held.withColumn("block", F.explode(blocks))


def stab(intervals: DataFrame, points: DataFrame, on: Sequence[str], start: str, end: str, at: str) -> DataFrame:
    """Every point with every interval of the same ``on`` values that holds it: the columns of both, those of ``on`` once.

    Points and intervals may not share other column names, nor have ones named level and block.
    """
    k = F.col("level")
    keyed = points.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(SIZES))))
    keyed = keyed.withColumn("block", F.when(k == SIZES, F.lit(0).cast("long")).otherwise(F.call_function("shiftright", F.col(at).cast("long"), k)))
    met = indexed(intervals, start, end).join(keyed, [*on, "level", "block"])
    return met.where((F.col(start) <= F.col(at)) & (F.col(end).isNull() | (F.col(at) < F.col(end)))).drop("level", "block")


def as_of_many(versions: DataFrame, pins: DataFrame) -> DataFrame:
    """The versions that each of many snapshots pins. versions(source_id, ..., valid_from_seq, valid_to_seq), pins(snapshot_id, source_id, pin)."""
    return stab(versions, pins, ["source_id"], "valid_from_seq", "valid_to_seq", "pin")
