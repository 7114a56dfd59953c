"""From raw documents to packed training sequences, in five stages.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listforge.llm import decontaminate, line_dedup, near_copies, packing, quality_rules
from listforge.llm.common import table
from listforge.session import durable

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and the boilerplate lines of the others; n_chars is that of the text that is left."""
    out = quality_rules.clean(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go; n_chars is that of the text that is left."""
    out = line_dedup.dedup_lines(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest doc_id."""
    return near_copies.keep_one(docs).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left becomes pieces of sequences."""
    return packing.pack(docs.select("doc_id", "text"))


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: SimHash components and token ids can't be written in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
