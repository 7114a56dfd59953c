"""Freshness, failures and incidents as data; the time of judgement is a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import durable
from .notices import consumed

# Severities from least to greatest; a circuit opens at so many failures in a row; minutes of back-off and retry double up to their limits.
SEVERITIES = ("INFO", "WARN", "PAGE")
THRESHOLD, OPEN_MINUTES, OPEN_MAX, RETRY_MINUTES, RETRY_MAX = 3, 30, 360, 10, 120


def staleness(sources: DataFrame, as_of: Column) -> DataFrame:
    """PAGE for core sources past the hard limit, WARN for others, for the soft limit and where there never was a success, RESOLVE below.

    sources(source_id, is_core, last_success_at, warn_hours, hard_hours)."""
    age = (F.unix_timestamp(as_of) - F.unix_timestamp(F.col("last_success_at").cast("timestamp"))) / 3600
    level = F.when(age.isNull(), "WARN").when(age > F.col("hard_hours"), F.when(F.col("is_core"), "PAGE").otherwise("WARN")).when(age > F.col("warn_hours"), "WARN").otherwise("RESOLVE")
    return sources.select("source_id", level.alias("level"))


def unchanged_for(sources: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Sources without a change for longer than the given days."""
    idle = F.datediff(F.to_date(as_of), F.to_date("last_change_at"))
    return sources.where(idle > days).select("source_id", idle.alias("idle_days"))


def unanswered(sigs: DataFrame, publishes: DataFrame, as_of: Column, hours: int = 6) -> DataFrame:
    """Signals that no publish of their target followed within the hours, once these are over."""
    until = F.col("observed_at") + F.expr(f"INTERVAL {hours} HOURS")
    first = consumed(sigs.where(until <= as_of), publishes)
    return first.where(F.col("consumed_at").isNull() | (F.col("consumed_at") > until)).drop("consumed_at")


def circuit_states(log: DataFrame) -> DataFrame:
    """Attempt log(source_id, at, seq, ok) -> the streak, circuit state and waiting minutes after each attempt.

    Streaks are islands between successes. The circuit opens at THRESHOLD failures in a row and waits 30 minutes doubled
    for each further one; below it the retry waits 10 minutes doubled for each.
    """
    w = Window.partitionBy("source_id").orderBy("seq")
    island = log.withColumn("island", F.sum(F.col("ok").cast("int")).over(w))
    streak = F.sum((~F.col("ok")).cast("int")).over(Window.partitionBy("source_id", "island").orderBy("seq"))
    out = island.withColumn("streak", streak)
    k = F.col("streak")
    wait = F.when(k == 0, 0).when(k >= THRESHOLD, F.least(F.lit(OPEN_MAX), OPEN_MINUTES * F.pow(F.lit(2), k - THRESHOLD))).otherwise(F.least(F.lit(RETRY_MAX), RETRY_MINUTES * F.pow(F.lit(2), k - 1)))
    return out.withColumn("breaker_state", F.when(k >= THRESHOLD, "OPEN").otherwise("CLOSED")).withColumn("wait_minutes", wait.cast("int")).drop("island")


def bookkeeping(runs: DataFrame) -> DataFrame:
    """Last times of each source from its runs: contact counts as attempt and fetch, new data as success, other data as change.

    runs(source_id, at, status, contacted)."""
    when = lambda c: F.max(F.when(c, F.col("at")))
    good = F.col("status").isin("SUCCEEDED", "NO_CHANGE")
    return runs.groupBy("source_id").agg(
        when(F.col("contacted")).alias("last_attempt_at"), when(F.col("contacted") & (F.col("status") != "FAILED")).alias("last_fetch_at"),
        when(good & F.col("contacted")).alias("last_success_at"), when(F.col("status") == "SUCCEEDED").alias("last_change_at"),
    )


def incidents(log: DataFrame) -> DataFrame:
    """Event log(dedupe_key, seq, at, kind, severity) -> incidents: events between two RESOLVED marks are one incident of their greatest severity."""
    w = Window.partitionBy("dedupe_key").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum((F.col("kind") == "RESOLVED").cast("int")).over(w), F.lit(0))
    marked = log.withColumn("island", before)
    out = marked.groupBy("dedupe_key", "island").agg(
        F.count_if(F.col("kind") != "RESOLVED").alias("occurrences"), F.min("at").alias("opened_at"), F.max(F.when(F.col("kind") != "RESOLVED", F.col("at"))).alias("last_seen_at"),
        F.max_by("severity", F.array_position(F.array(*[F.lit(x) for x in SEVERITIES]), F.col("severity"))).alias("severity"), F.max((F.col("kind") == "RESOLVED").cast("int")).alias("r"),
    )
    return out.where("occurrences > 0").withColumn("status", F.when(F.col("r") == 1, "RESOLVED").otherwise("OPEN")).drop("r")


def alerts(inc: DataFrame, as_of: Column, again_minutes: int = 60) -> DataFrame:
    """Open incidents to tell of now: those never told, and pages last told longer ago than the limit."""
    silent = F.col("alerted_at").isNull()
    old = (F.col("severity") == "PAGE") & ((F.unix_timestamp(as_of) - F.unix_timestamp(F.col("alerted_at").cast("timestamp"))) / 60 >= again_minutes)
    return inc.where((F.col("status") == "OPEN") & (silent | old))


def chain_lengths(runs: DataFrame) -> DataFrame:
    """runs(run_id, resumed_from) -> run_id, chain: how many runs it goes back, null if that leads into a circle.

    The reach of the links doubles each round until every chain has come to its end, however long it is. What still goes on after more
    steps than there are runs goes in a circle. Links to runs that aren't there end a chain.
    """
    there = runs.select(F.col("run_id").alias("__run"))
    linked = runs.join(there, F.col("resumed_from") == F.col("__run"), "left")
    step = durable(linked.select("run_id", F.col("__run").alias("to"), F.col("__run").isNotNull().cast("long").alias("chain")), "chains")
    n, reach = step.count(), 1
    while reach <= n and not step.where("to IS NOT NULL").isEmpty():
        far = step.select(F.col("run_id").alias("to"), F.col("to").alias("next"), F.col("chain").alias("more"))
        on = step.where("to IS NOT NULL").join(far, "to").select("run_id", F.col("next").alias("to"), (F.col("chain") + F.col("more")).alias("chain"))
        step, reach = durable(step.where("to IS NULL").union(on), "chains"), reach * 2
    return step.select("run_id", F.when(F.col("to").isNull(), F.col("chain")).alias("chain"))


def expired(staging: DataFrame, as_of: Column, days: int) -> DataFrame:
    """Staged runs past retention that aren't held."""
    return staging.where((F.to_date("created_at") < F.date_sub(F.to_date(as_of), days)) & (F.col("status") != "HELD"))
