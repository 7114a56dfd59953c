"""Aggregate marts. No mart carries a record-level column; the time of a report is always a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.versioning import latest

ACTIVE, GOOD, ATTENTION, BAD = ("QUEUED", "RUNNING"), ("SUCCEEDED", "NO_CHANGE", "DRY_RUN_OK"), ("HELD", "QUARANTINED"), ("FAILED", "ABANDONED")
HEALTH_LABELS = {"stale": "stale", "warn": "stale_warning"}


def seconds(a: Column, b: Column) -> Column:
    return F.unix_micros(b.cast("timestamp")) / 1e6 - F.unix_micros(a.cast("timestamp")) / 1e6


def health(as_of: Column, labels: dict[str, str] | None = None) -> Column:
    """State of a source in order of urgency; ``labels`` renames the two stale states."""
    names = {**HEALTH_LABELS, **(labels or {})}
    age = seconds(F.col("last_success_at"), as_of) / 3600
    return (
        F.when(F.col("status") != "ACTIVE", F.lower("status"))
        .when(F.col("last_success_at").isNull(), "never_succeeded")
        .when(age > F.col("hard_hours"), names["stale"])
        .when(age > F.col("warn_hours"), names["warn"])
        .when((F.col("breaker_state") != "CLOSED") | (F.col("consecutive_failures") > 0), "degraded")
        .otherwise("healthy")
    )


def source_status(sources: DataFrame, versions: DataFrame, as_of: Column) -> DataFrame:
    """K1: freshness and health of every source with its current version."""
    hours = lambda c: F.round(seconds(F.col(c), as_of) / 3600, 2)
    current = versions.where("status = 'PUBLISHED'").groupBy("source_id").agg(F.max(F.struct("seq", "record_count")).alias("v"))
    return sources.join(current, "source_id", "left").select("source_id", "status", hours("last_success_at").alias("hours_since_success"), health(as_of).alias("health"), F.col("v.seq").alias("current_version_seq"), F.col("v.record_count").alias("record_count"))


def run_summary(runs: DataFrame, as_of: Column) -> DataFrame:
    """K2: duration (open runs up to as_of) and the change counts of the JSON summary."""
    count = lambda k: F.get_json_object("summary", f"$.{k}").cast("int").alias(k)
    return runs.select("run_id", "source_id", "status", F.round(seconds(F.col("started_at"), F.coalesce("finished_at", as_of)), 1).alias("duration_seconds"), F.left("error_detail", F.lit(300)).alias("error_detail"), *map(count, ("added", "changed", "removed")))


def run_progress(runs: DataFrame) -> DataFrame:
    """K3: active runs with typed progress fields."""
    field = lambda k, t: F.get_json_object("progress", f"$.{k}").cast(t).alias(k)
    return runs.where(F.col("status").isin(*ACTIVE)).select("run_id", "source_id", "status", field("pct", "double"), field("records_done", "int"))


def latest_attempts(runs: DataFrame) -> DataFrame:
    return latest(runs, ["batch_id", "source_id"], F.col("queued_at").desc(), F.col("attempt").desc(), F.col("run_id").desc())


def run_batches(runs: DataFrame, batches: DataFrame) -> DataFrame:
    """K4: a row a batch from the latest attempt of each source."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    agg = latest_attempts(runs).groupBy("batch_id").agg(
        F.count("*").alias("sources_run"), n(*ACTIVE).alias("active"), n(*GOOD).alias("ok"), n(*ATTENTION).alias("attention"), n(*BAD).alias("failed"), n("CANCELLED").alias("cancelled"),
        F.sum("added").alias("added"), F.sum("changed").alias("changed"), F.sum("removed").alias("removed"),
    )
    tries = runs.groupBy("batch_id").agg(F.count("*").alias("attempts"))
    out = batches.join(agg, "batch_id", "left").join(tries, "batch_id", "left").fillna(0, ["sources_run", "active", "ok", "attention", "failed", "cancelled", "attempts"])
    state = (
        F.when(F.col("sources_run") == 0, "REFUSED").when(F.col("active") > 0, "RUNNING").when(F.col("failed") > 0, "FAILED")
        .when(F.col("attention") > 0, "NEEDS_REVIEW").when(F.col("cancelled") == F.col("sources_run"), "CANCELLED").otherwise("COMPLETED")
    )
    return out.withColumn("retried_attempts", F.col("attempts") - F.col("sources_run")).withColumn("status", state).drop("attempts")


def grouped(df: DataFrame, keys: Sequence[str], n: str = "n", **aggs: Column) -> DataFrame:
    """Counts by keys with further aggregates."""
    return df.groupBy(*keys).agg(F.count("*").alias(n), *[c.alias(k) for k, c in aggs.items()])


def coverage(subjects: DataFrame, results: DataFrame) -> DataFrame:
    """Enrichment results as shares of the current records of their source and type."""
    s = subjects.groupBy("source_id", "entity_type").agg(F.count("*").alias("current_records"))
    r = results.groupBy("provider", "source_id", "entity_type", "status").agg(F.count("*").alias("n"))
    return r.join(s, ["source_id", "entity_type"], "left").withColumn("share_of_records", F.round(F.col("n") / F.nullif(F.col("current_records"), F.lit(0)), 4))


def notice_coverage(events: DataFrame, links: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """Recent change events and how many have a legal notice."""
    known = links.where("status IN ('AUTO', 'APPROVED')").select("source_id", "source_key").distinct().withColumn("__l", F.lit(1))
    recent = events.where(F.col("created_at") > F.date_sub(F.to_date(as_of), days))
    return recent.join(known, ["source_id", "source_key"], "left").groupBy("source_id", "change_type").agg(F.count("*").alias("change_events"), F.count("__l").alias("with_legal_evidence"))


def with_counts(parents: DataFrame, children: DataFrame, key: str, **counts: Column) -> DataFrame:
    """Parents with counts of their children, zero where there are none."""
    agg = children.groupBy(key).agg(*[c.alias(k) for k, c in counts.items()])
    return parents.join(agg, key, "left").fillna(0, list(counts))


def field_catalog(fields: DataFrame, floors: DataFrame, types: Sequence[str]) -> DataFrame:
    """Declared fields with floors; ``*`` stands for every type."""
    kinds = F.when(F.col("entity_type") == "*", F.array(*[F.lit(t) for t in types])).otherwise(F.array("entity_type"))
    return fields.withColumn("entity_type", F.explode(kinds)).join(floors, ["source_id", "field", "entity_type"], "left")


def fetch_health(fetches: DataFrame) -> DataFrame:
    """Attempts by source and hour."""
    return fetches.groupBy("source_id", F.date_trunc("hour", "fetched_at").alias("hour")).agg(
        F.count("*").alias("attempts"), F.count_if(F.col("error_class").isNull()).alias("ok"), F.count("error_class").alias("failed"),
        F.array_sort(F.collect_set("error_class")).alias("error_classes"), F.round(F.avg("duration_ms")).alias("avg_ms"), F.max("size_bytes").alias("max_bytes"),
    )


def latest_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics of the newest measured version of each source, whatever its status."""
    top = metrics.groupBy("source_id").agg(F.max("seq").alias("seq"))
    return metrics.join(top, ["source_id", "seq"], "left_semi")


def counts_from_json(versions: DataFrame, col: str) -> DataFrame:
    """Counts by type out of a JSON map."""
    return versions.select("version_id", F.explode(F.from_json(col, "map<string,bigint>")).alias("entity_type", "n"))


def page(df: DataFrame, order: str, key: str, n: int, before=None) -> DataFrame:
    """The newest n rows, or those before a cursor."""
    if before is not None:
        df = df.where(F.col(order) < F.lit(before))
    return df.orderBy(F.col(order).desc(), F.col(key).desc()).limit(n)


def error_history(fetches: DataFrame, samples: int = 5) -> DataFrame:
    """Error classes of each source with first and last time, and the ids of the latest samples."""
    bad = fetches.where("error_class IS NOT NULL")
    agg = bad.groupBy("source_id", "error_class").agg(F.count("*").alias("n"), F.min("fetched_at").alias("first_at"), F.max("fetched_at").alias("last_at"))
    from pyspark.sql.window import Window

    w = Window.partitionBy("source_id", "error_class").orderBy(F.col("fetched_at").desc(), F.col("event_id").desc())
    last = bad.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= samples).groupBy("source_id", "error_class").agg(F.array_sort(F.collect_list("event_id")).alias("sample_ids"))
    return agg.join(last, ["source_id", "error_class"])


def daily(df: DataFrame, at: str, as_of: Column, days: int, **aggs: Column) -> DataFrame:
    """Aggregates by day over the last days."""
    return df.where((F.to_date(at) > F.date_sub(F.to_date(as_of), days)) & (F.to_date(at) <= F.to_date(as_of))).groupBy(F.to_date(at).alias("day")).agg(*[c.alias(k) for k, c in aggs.items()])


def gauges(parts: dict[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Small aggregates in long form (metric, labels, value); labels as k=v text in fixed order."""
    out = None
    for metric, (df, value, labels) in parts.items():
        text = F.concat_ws(",", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in labels]) if labels else F.lit("")
        one = df.select(F.lit(metric).alias("metric"), text.alias("labels"), F.col(value).cast("double").alias("value"))
        out = one if out is None else out.unionByName(one)
    return out


def model_cost(usage: DataFrame, prices: tuple[float, float, float]) -> DataFrame:
    """Cost of a cycle from plain, cached and output tokens, prices per million."""
    plain, cached, output = prices
    cost = ((F.col("input_tokens") - F.col("cached_tokens")) * plain + F.col("cached_tokens") * cached + F.col("output_tokens") * output) / 1e6
    return usage.withColumn("cost_usd", F.round(cost, 6))


def register(frames: dict[str, DataFrame]) -> None:
    """Temporary views ``v_<name>``, so that reports can be asked for in SQL."""
    for name, df in frames.items():
        df.createOrReplaceTempView(f"v_{name}")
