"""Streaming forms of the feed and freshness operators. Event times are TIMESTAMP columns under UTC."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import notices as G
from ..operators.monitor import THRESHOLD


def landed(spark: SparkSession, path: str, schema, per_trigger: int | None = None) -> DataFrame:
    """Stream of Parquet files that land in a folder."""
    r = spark.readStream.schema(schema)
    return (r.option("maxFilesPerTrigger", per_trigger) if per_trigger else r).parquet(path)


def fetch_health(fetches: DataFrame, late: str = "1 hour") -> DataFrame:
    """Hourly attempts by source, for hours that the watermark has closed."""
    hour = F.window("fetched_at", "1 hour")
    return fetches.withWatermark("fetched_at", late).groupBy("source_id", hour).agg(
        F.count("*").alias("attempts"), F.count("error_class").alias("failed"), F.round(F.avg("duration_ms")).alias("avg_ms"), F.max("size_bytes").alias("max_bytes")
    ).select("source_id", F.col("window.start").alias("hour"), "attempts", "failed", "avg_ms", "max_bytes")


def store_notices(stream: DataFrame, table: str, checkpoint: str):
    """Append what isn't stored yet: each micro-batch is anti-joined with the table, so no key lives in stream state.

    A batch that is replayed after a failure finds its own rows stored and adds none.
    """

    def put(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        try:
            known = spark.read.parquet(table)
        except Exception as e:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            known = batch.limit(0).select("provider", "external_id")
        G.new_notices(batch, known).write.mode("append").parquet(table)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def signals(notices: DataFrame, late: str = "2 days") -> DataFrame:
    """One signal for each notice and target, told once while its time is inside the watermark."""
    out = notices.withWatermark("observed_at", late).select("external_id", "observed_at", F.explode("signal_for").alias("target_source_id"))
    return out.withColumn("signal_id", F.concat("external_id", F.lit("->"), "target_source_id")).dropDuplicatesWithinWatermark(["signal_id"])


def unanswered(sigs: DataFrame, publishes: DataFrame, hours: int = 6) -> DataFrame:
    """Signals with the publish that answered them within the hours, or none once that time is over."""
    s = sigs.withWatermark("observed_at", "1 hour")
    p = publishes.select(F.col("source_id").alias("p_source"), "published_at").withWatermark("published_at", "1 hour")
    on = (F.col("target_source_id") == F.col("p_source")) & (F.col("published_at") >= F.col("observed_at")) & (F.col("published_at") <= F.col("observed_at") + F.expr(f"INTERVAL {hours} HOURS"))
    return s.join(p, on, "left_outer")


def circuits(attempts: DataFrame) -> DataFrame:
    """Attempts(source_id, seq, ok) -> source_id, seq, streak, breaker_state, with the streak kept as state of each source."""

    def step(key: tuple[Any, ...], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (streak,) = state.get if state.exists else (0,)
        rows = pd.concat(list(frames)).sort_values("seq")
        streaks = []
        for ok in rows["ok"]:
            streak = 0 if ok else streak + 1
            streaks.append(streak)
        state.update((streak,))
        yield pd.DataFrame({"source_id": key[0], "seq": rows["seq"], "streak": streaks, "breaker_state": ["OPEN" if n >= THRESHOLD else "CLOSED" for n in streaks]})

    return attempts.groupBy("source_id").applyInPandasWithState(step, "source_id string, seq long, streak long, breaker_state string", "streak long", "append", GroupStateTimeout.NoTimeout)
