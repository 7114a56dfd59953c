"""Connected components of an edge table, by alternating large-star and small-star rounds.

Every round is two shuffled aggregations and joins over the edges; the table is written to the shared folder after each
round, so nothing of it reaches the driver but a count and a checksum. The edges of a hub are joined with its smallest
neighbour by plain exchanges, whose tasks adaptive execution can split, and are never gathered into one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, new_path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """large: each node links its larger neighbours to its smallest; small: its smaller ones and itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where(F.col("v") < F.col("u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    # under another expression than the grouping's key: both sides of the join get a plain exchange, which can be split at a hub
    apart = lambda df: df.select(F.col("u").bitwiseXOR(F.lit(0)).alias("__u"), "m")
    if large:
        least = least.select("u", F.least("u", "m").alias("m"))
        out = both.join(apart(least), F.col("u") == F.col("__u")).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = both.join(apart(least), F.col("u") == F.col("__u")).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges(u, v) of longs -> (node, component): every node of an edge with the smallest node that it reaches."""
    spark = edges.sparkSession
    schema = "u long, v long"

    def put(df: DataFrame) -> str:
        path = new_path(spark, "edges")
        df.write.parquet(path)
        return path

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    at = put(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    now = spark.read.schema(schema).parquet(at)
    seen = mark(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        nxt = put(_star(_star(now, True), False))
        drop_path(spark, at)
        at, now = nxt, spark.read.schema(schema).parquet(nxt)
        then, seen = seen, mark(now)
        if then == seen:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
