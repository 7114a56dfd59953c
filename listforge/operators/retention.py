"""Evidence in monthly folders, of which whole months expire.

    <path>/month=2024-05   rows of a month
    <path>/held/month=2024-05   rows of an expired month that are still held

An expiry first writes what is held, then deletes the month. While the month is there readers take it and not its held rows, so an expiry that dies
in between changes nothing and can be repeated. Rows that are let go leave with the next expiry.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, durable

MONTH = "month"


def month_of(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM")


class Evidence:
    """Rows in monthly folders. schema: DDL of the rows; at: the column that tells their time."""

    def __init__(self, spark: SparkSession, path: str, schema: str, at: str):
        self.spark, self.path, self.at = spark, path.rstrip("/"), at
        self.schema = f"{schema}, {MONTH} string"

    def append(self, df: DataFrame) -> None:
        df.withColumn(MONTH, month_of(F.col(self.at))).repartition(MONTH).write.mode("append").partitionBy(MONTH).parquet(self.path)

    def months(self, area: str = "") -> list[str]:
        """Months that have a folder."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path + area)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(n.partition("=")[2] for n in names if n.startswith(f"{MONTH}="))

    def _folders(self, months: list[str], area: str = "") -> DataFrame:
        paths = [f"{self.path}{area}/{MONTH}={m}" for m in months]
        read = self.spark.read.schema(self.schema).option("basePath", self.path + area)
        return read.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """Rows of some days (all, if not given); folders of other months aren't opened."""
        inside = lambda m: (first is None or m >= f"{first:%Y-%m}") and (last is None or m <= f"{last:%Y-%m}")
        main = self.months()
        out = self._folders([m for m in main if inside(m)]).unionByName(self._folders([m for m in self.months("/held") if inside(m) and m not in main], "/held"))
        day = F.to_date(self.at)
        if first is not None:
            out = out.where(day >= F.lit(first))
        if last is not None:
            out = out.where(day <= F.lit(last))
        return out.drop(MONTH)

    def expire(self, as_of: dt.date, days: int, held: Column) -> list[str]:
        """Delete the months that lie wholly before ``days`` days ago, but for rows for which ``held`` holds; the months that were deleted."""
        limit = as_of - dt.timedelta(days=days)
        over = lambda m: (dt.date.fromisoformat(f"{m}-01") + dt.timedelta(days=32)).replace(day=1) <= limit
        gone = [m for m in self.months() if over(m)]
        kept = [m for m in self.months("/held") if m not in self.months()]
        stay = durable(self._folders(gone).unionByName(self._folders(kept, "/held")).where(held), "held")
        stay.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(f"{self.path}/held")
        still = {r[MONTH] for r in stay.select(MONTH).distinct().collect()}  # a row a month
        for m in gone:
            drop_path(self.spark, f"{self.path}/{MONTH}={m}")
        for m in self.months("/held"):
            if m not in still:
                drop_path(self.spark, f"{self.path}/held/{MONTH}={m}")
        return gone
