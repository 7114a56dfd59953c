"""Streaming forms give what the batch forms give."""

from pyspark.sql import functions as F

from listforge.operators import monitor as MO
from listforge.plans.derive import FETCHES, derived
from listforge.streaming import jobs as J

SF = "/root/testdata/sf0.001"


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_fetch_health_of_closed_hours(spark, tmp_path):
    log = derived(spark, SF, FETCHES).withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    log.repartition(1).write.parquet(str(tmp_path / "in"))
    got = drain(J.fetch_health(J.landed(spark, str(tmp_path / "in"), log.schema)), "health")
    batch = log.groupBy("source_id", F.date_trunc("hour", "fetched_at").alias("hour")).agg(F.count("*").alias("attempts"), F.count("error_class").alias("failed"))
    closed = log.agg(F.max("fetched_at")).first()[0]
    want = batch.where(F.col("hour") + F.expr("INTERVAL 2 HOURS") <= F.lit(closed))
    assert want.count() > 0 and want.exceptAll(got.select("source_id", "hour", "attempts", "failed")).count() == 0


def test_circuits_match_the_window_query(spark, tmp_path):
    log = derived(spark, SF, FETCHES).select("source_id", F.col("event_id").alias("seq"), (F.col("error_class").isNull() & (F.col("event_id") % 3 == 0)).alias("ok"))
    for k in range(3):  # ascending files, one a trigger
        log.where(F.floor(F.col("seq") / 400) == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = J.circuits(J.landed(spark, str(tmp_path / "in"), log.schema, 1))
    got = {(r.source_id, r.seq): (r.streak, r.breaker_state) for r in drain(q, "circuits").collect()}
    want = {(r.source_id, r.seq): (r.streak, r.breaker_state) for r in MO.circuit_states(log.where("seq < 1200")).collect()}
    assert got == want and want


def test_notices_are_stored_once(spark, tmp_path):
    rows = spark.createDataFrame([("p", f"x{k % 5}", k, "t", "b") for k in range(12)], "provider string, external_id string, position long, title string, text string")
    rows.repartition(4).write.parquet(str(tmp_path / "in"))
    J.store_notices(J.landed(spark, str(tmp_path / "in"), rows.schema, 1), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    rows.write.mode("append").parquet(str(tmp_path / "in"))
    J.store_notices(J.landed(spark, str(tmp_path / "in"), rows.schema, 1), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination()
    assert sorted(r.external_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [f"x{k}" for k in range(5)]


def test_signals_and_answers(spark, tmp_path):
    t = lambda h: F.to_timestamp(F.lit("2024-01-01")) + F.make_interval(hours=F.lit(h))
    n = spark.range(1).select(F.lit("e").alias("external_id"), t(0).alias("observed_at"), F.array(F.lit("A"), F.lit("B")).alias("signal_for"))
    n.union(n).coalesce(1).write.parquet(str(tmp_path / "n"))
    assert sorted(r.signal_id for r in drain(J.signals(J.landed(spark, str(tmp_path / "n"), n.schema)), "sig").collect()) == ["e->A", "e->B"]
    s = spark.createDataFrame([(1, "A", 0), (2, "B", 0), (3, "Z", 60)], "signal_id long, target_source_id string, h int").select("signal_id", "target_source_id", (F.to_timestamp(F.lit("2024-01-01")) + F.make_interval(hours=F.col("h"))).alias("observed_at"))
    p = spark.createDataFrame([("A", 3), ("B", 9), ("Y", 60)], "source_id string, h int").select("source_id", (F.to_timestamp(F.lit("2024-01-01")) + F.make_interval(hours=F.col("h"))).alias("published_at"))
    s.coalesce(1).write.parquet(str(tmp_path / "s"))
    p.coalesce(1).write.parquet(str(tmp_path / "p"))
    out = drain(J.unanswered(J.landed(spark, str(tmp_path / "s"), s.schema), J.landed(spark, str(tmp_path / "p"), p.schema)), "ans").collect()
    got = {r.signal_id: r.published_at is not None for r in out}
    assert got[1] is True and got.get(2) in (False, None)
