"""Landed files: hashes, unchanged inputs, malformed inputs, staging writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, size) of landed files."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def unchanged(inputs: DataFrame, known: DataFrame, force: bool = False) -> DataFrame:
    """What to do with each input(source_id, sha256): NO_CHANGE if the published version has the same content, the status
    of a held or quarantined version with that content, else PARSE. known(source_id, sha256, status)."""
    hit = known.groupBy("source_id", "sha256").agg(F.max(F.struct((F.col("status") == "PUBLISHED").alias("p"), "status")).alias("k"))
    step = F.lit("PARSE") if force else F.when(F.col("k.status") == "PUBLISHED", "NO_CHANGE").when(F.col("k.status").isin("HELD", "QUARANTINED"), F.col("k.status")).otherwise("PARSE")
    return inputs.join(hit, ["source_id", "sha256"], "left").withColumn("step", step).drop("k")


def malformed_share(rows: DataFrame, required: Sequence[str], position: str, first: int = 500) -> DataFrame:
    """Share of the first rows, by position, that lack a required field, and whether the file fails (over a tenth)."""
    lacks = F.lit(False)
    for c in required:
        lacks = lacks | (F.coalesce(F.col(c), F.lit("")) == "")
    head = rows.orderBy(position).limit(first)
    share = F.avg(lacks.cast("int"))
    return head.agg(F.round(share, 4).alias("share"), (F.coalesce(share, F.lit(0.0)) > 0.1).alias("fails"))


def stage(df: DataFrame, path: str, *partitions: str) -> None:
    """Write a candidate's rows under their partitions; a rerun replaces these partitions and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
