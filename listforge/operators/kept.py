"""Marts that are kept up with each publish instead of being computed anew.

A batch adds signed partial aggregates: what comes counts plus one, what goes or is corrected counts minus one. A batch stands in a folder of
its own, so applying it again replaces it and changes nothing. Reading sums the batches; compaction folds them into one, under a name that
says which batches it holds, so that readers take either it or them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import drop_path, new_path


class KeptMart:
    """Sums by some dimensions. schema: DDL of the dimensions; sums are one long column ``n``."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.dims = [f.name for f in spark.createDataFrame([], schema).schema]

    def _folders(self) -> list[tuple[int, int, str]]:
        """(first batch, last batch, folder) of what readers take: a folder that others cover is left out."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        done = [n for n in names if "-" in n and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, f"{n}/_SUCCESS"))]
        all_ = [(int(a), int(b), n) for n in done for a, b in [n.split("-")]]
        return sorted(x for x in all_ if not any(y != x and y[0] <= x[0] and x[1] <= y[1] for y in all_))

    def apply(self, batch: int, signed: DataFrame) -> None:
        """Add a batch of rows with a sign column ``n``; a number that was applied before is replaced, unless it is compacted already."""
        if any(a <= batch <= b and a < b for a, b, _ in self._folders()):
            return
        part = signed.groupBy(*self.dims).agg(F.sum("n").cast("long").alias("n")).where("n <> 0")
        part.write.mode("overwrite").parquet(f"{self.path}/{batch}-{batch}")

    def read(self) -> DataFrame:
        paths = [f"{self.path}/{n}" for _, _, n in self._folders()]
        kind = f"{self.schema}, n long"
        rows = self.spark.read.schema(kind).parquet(*paths) if paths else self.spark.createDataFrame([], kind)
        return rows.groupBy(*self.dims).agg(F.sum("n").alias("n")).where("n <> 0")

    def compact(self) -> None:
        """Fold all batches into one folder; the old ones go once it is complete."""
        old = self._folders()
        if len(old) < 2:
            return
        made = new_path(self.spark, "compacted")
        self.read().write.parquet(made)
        self.spark.read.schema(f"{self.schema}, n long").parquet(made).write.parquet(f"{self.path}/{old[0][0]}-{old[-1][1]}")
        for _, _, n in old:
            drop_path(self.spark, f"{self.path}/{n}")
        drop_path(self.spark, made)


def change_rows(changes: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Change volume (K8): each change counts once."""
    return changes.select(*dims, F.lit(1).alias("n"))


def count_rows(changes: DataFrame, dims: Sequence[str], old: str, new: str) -> DataFrame:
    """Counts by type (K5): a record leaves its old type and enters its new one; ``old`` and ``new`` are null where there is none."""
    goes = changes.where(F.col(old).isNotNull()).select(*dims, F.col(old).alias("entity_type"), F.lit(-1).alias("n"))
    comes = changes.where(F.col(new).isNotNull()).select(*dims, F.col(new).alias("entity_type"), F.lit(1).alias("n"))
    return goes.union(comes)


def released(rows: DataFrame, held: Column, published: Column, status: str = "status") -> DataFrame:
    """Signed rows that move what was counted as held to published."""
    return rows.withColumns({status: held, "n": -F.col("n")}).unionByName(rows.withColumn(status, published))


def running_counts(deltas: DataFrame, by: Sequence[str], seq: str) -> DataFrame:
    """Counts at each sequence from deltas at each sequence, for all sequences of the source (``by[0]``), zero ones left out."""
    source = by[0]
    steps = deltas.select(source, seq).distinct()
    groups = deltas.select(*by).distinct()
    grid = groups.join(steps, source).join(deltas, [*by, seq], "left")
    total = F.sum(F.coalesce("n", F.lit(0))).over(Window.partitionBy(*by).orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return grid.withColumn("n", total).where("n <> 0")
