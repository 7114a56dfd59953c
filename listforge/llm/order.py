"""Running totals over a global order, without a task that sees all rows.

Rows are dealt by ranges of the order, totals of the ranges (a row a range) give each range its start, and a window inside each
range does the rest. The order must tell all rows apart, so that no group of ties has to stay in one range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import durable


def running(df: DataFrame, order: Sequence[Column], **totals: Column) -> DataFrame:
    """df plus, for each named value, its sum over all rows that come before in the order.

    The ranges come from a sample, so they are written before anything is counted: a task that is run again sees the same.
    df itself is read twice (for the sample and for the deal) and should be a written table.
    """
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    parts = durable(df.repartitionByRange(n, *order).withColumn("__range", F.spark_partition_id()), "ranges")
    sums = parts.groupBy("__range").agg(*[F.sum(c).alias(f"__t_{k}") for k, c in totals.items()])
    along = Window.orderBy("__range")  # a row a range
    starts = sums.select(F.col("__range").alias("__r"), *[(F.sum(f"__t_{k}").over(along) - F.col(f"__t_{k}")).alias(f"__s_{k}") for k in totals])
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = parts.join(F.broadcast(starts), F.col("__range") == F.col("__r"))
    return both.withColumns({k: (F.col(f"__s_{k}") + F.sum(c).over(inside) - c).cast("long") for k, c in totals.items()}).drop("__range", "__r", *[f"__s_{k}" for k in totals])
