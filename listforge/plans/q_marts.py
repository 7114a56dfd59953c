"""Registered queries: aggregate marts (section K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import marts as M
from .derive import FETCHES, RUNS, derived
from .q_quality import METRICS
from .q_versioning import CANDS, LINKS, PROPS, VERS
from .registry import query

NOW = "2001-06-30 00:00:00"
SOURCES = """SELECT 'S' || CAST(o_custkey % 40 AS VARCHAR(9)) AS source_id, CASE WHEN o_custkey % 40 = 7 THEN 'PAUSED' ELSE 'ACTIVE' END AS status,
 max(CASE WHEN o_orderstatus = 'O' AND o_custkey % 40 <> 9 THEN o_orderdate END) AS last_success_at, o_custkey % 40 * 24 * 4 AS warn_hours, o_custkey % 40 * 24 * 20 AS hard_hours,
 CASE WHEN o_custkey % 40 = 11 THEN 'OPEN' ELSE 'CLOSED' END AS breaker_state, o_custkey % 40 % 5 AS consecutive_failures FROM orders GROUP BY o_custkey % 40"""
_now = lambda: F.to_timestamp(F.lit(NOW))
_hours = f"(epoch(TIMESTAMP '{NOW}') - epoch(last_success_at)) / 3600"
_HEALTH = f"CASE WHEN status <> 'ACTIVE' THEN lower(status) WHEN last_success_at IS NULL THEN 'never_succeeded' WHEN {_hours} > hard_hours THEN 'stale' WHEN {_hours} > warn_hours THEN 'stale_warning' WHEN breaker_state <> 'CLOSED' OR consecutive_failures > 0 THEN 'degraded' ELSE 'healthy' END"


@query("k01_source_status", f"WITH s AS ({SOURCES}), v AS (SELECT source_id, max(seq) AS seq, arg_max(record_count, (seq, record_count)) AS record_count FROM ({VERS}) WHERE status = 'PUBLISHED' GROUP BY 1) SELECT source_id, status, round({_hours}, 2) AS hours_since_success, {_HEALTH} AS health, seq AS current_version_seq, record_count FROM s LEFT JOIN v USING (source_id)")
def k01(spark, sf_dir):
    return M.source_status(derived(spark, sf_dir, SOURCES), derived(spark, sf_dir, VERS), _now())


JRUNS = """SELECT o_orderkey AS run_id, 'S' || CAST(o_custkey % 40 AS VARCHAR(9)) AS source_id, CASE o_orderstatus WHEN 'P' THEN 'RUNNING' WHEN 'F' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status, o_orderdate AS started_at,
 CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 90 SECOND END AS finished_at, o_orderpriority || ' failed' AS error_detail,
 '{"added": ' || CAST(o_orderkey % 9 AS VARCHAR(9)) || ', "removed": ' || CAST(o_orderkey % 4 AS VARCHAR(9)) || '}' AS summary, '{"pct": ' || CAST(o_orderkey % 100 AS VARCHAR(9)) || '.5, "records_done": ' || CAST(o_custkey AS VARCHAR(9)) || '}' AS progress FROM orders"""


@query("k02_run_summary", f"SELECT run_id, source_id, status, round(epoch(coalesce(finished_at, TIMESTAMP '{NOW}')) - epoch(started_at), 1) AS duration_seconds, left(error_detail, 300) AS error_detail, (summary->>'$.added')::INT AS added, (summary->>'$.changed')::INT AS changed, (summary->>'$.removed')::INT AS removed FROM ({JRUNS})")
def k02(spark, sf_dir):
    return M.run_summary(derived(spark, sf_dir, JRUNS), _now())


@query("k03_run_progress", f"SELECT run_id, source_id, status, (progress->>'$.pct')::DOUBLE AS pct, (progress->>'$.records_done')::INT AS records_done FROM ({JRUNS}) WHERE status IN ('QUEUED','RUNNING')")
def k03(spark, sf_dir):
    return M.run_progress(derived(spark, sf_dir, JRUNS))


_LATEST = f"r AS ({RUNS}), latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, source_id ORDER BY queued_at DESC, attempt DESC, run_id DESC) AS rn FROM r) WHERE rn = 1)"


@query(
    "k04_run_batches",
    f"""WITH {_LATEST}, a AS (SELECT batch_id, count(*) AS sources_run, count(*) FILTER (status IN ('QUEUED','RUNNING')) AS active, count(*) FILTER (status IN ('SUCCEEDED','NO_CHANGE','DRY_RUN_OK')) AS ok, count(*) FILTER (status IN ('HELD','QUARANTINED')) AS attention,
    count(*) FILTER (status IN ('FAILED','ABANDONED')) AS failed, count(*) FILTER (status = 'CANCELLED') AS cancelled, sum(added)::BIGINT AS added, sum(changed)::BIGINT AS changed, sum(removed)::BIGINT AS removed FROM latest GROUP BY 1), t AS (SELECT batch_id, count(*) AS n FROM r GROUP BY 1), b AS (SELECT range AS batch_id FROM range(110))
    SELECT batch_id, coalesce(sources_run,0) AS sources_run, coalesce(active,0) AS active, coalesce(ok,0) AS ok, coalesce(attention,0) AS attention, coalesce(failed,0) AS failed, coalesce(cancelled,0) AS cancelled, added, changed, removed, coalesce(n,0) - coalesce(sources_run,0) AS retried_attempts,
    CASE WHEN coalesce(sources_run,0) = 0 THEN 'REFUSED' WHEN active > 0 THEN 'RUNNING' WHEN failed > 0 THEN 'FAILED' WHEN attention > 0 THEN 'NEEDS_REVIEW' WHEN cancelled = sources_run THEN 'CANCELLED' ELSE 'COMPLETED' END AS status FROM b LEFT JOIN a USING (batch_id) LEFT JOIN t USING (batch_id)""",
)
def k04(spark, sf_dir):
    return M.run_batches(derived(spark, sf_dir, RUNS), spark.range(110).withColumnRenamed("id", "batch_id"))


JVERS = """SELECT o_orderkey AS version_id, '{"PERSON": ' || CAST(o_orderkey % 90 AS VARCHAR(9)) || ', "VESSEL": ' || CAST(o_custkey AS VARCHAR(9)) || '}' AS counts FROM orders"""


@query("k05_k23_counts_by_type", "SELECT o_orderkey AS version_id, unnest(['PERSON', 'VESSEL']) AS entity_type, unnest([o_orderkey % 90, o_custkey]) AS n FROM orders")
def k05(spark, sf_dir):
    return M.counts_from_json(derived(spark, sf_dir, JVERS), "counts")


@query("k06_fill_rates", f"WITH m AS ({METRICS}) SELECT source_id, seq, field, value AS fill_rate, 0.4::DOUBLE AS floor, value < 0.4 AS below FROM m WHERE field LIKE '%F'")
def k06(spark, sf_dir):
    m = derived(spark, sf_dir, METRICS).where("field LIKE '%F'")
    floors = m.select("field").distinct().withColumn("floor", F.lit(0.4))
    return m.join(F.broadcast(floors), "field").select("source_id", "seq", "field", F.col("value").alias("fill_rate"), "floor", (F.col("value") < F.col("floor")).alias("below"))


@query("k07_quality_metrics", f"WITH m AS ({METRICS}), v AS (SELECT source_id, max(seq) AS top FROM m GROUP BY 1) SELECT source_id, seq, field, value, CASE WHEN seq = top THEN 'PUBLISHED' ELSE 'SUPERSEDED' END AS version_status FROM m JOIN v USING (source_id)")
def k07(spark, sf_dir):
    m = derived(spark, sf_dir, METRICS)
    v = m.groupBy("source_id").agg(F.max("seq").alias("top"))
    return m.join(v, "source_id").select("source_id", "seq", "field", "value", F.when(F.col("seq") == F.col("top"), "PUBLISHED").otherwise("SUPERSEDED").alias("version_status"))


EVENTS = "SELECT l_orderkey * 10 + l_linenumber AS event_id, 'L' || CAST(l_suppkey % 3 AS VARCHAR(9)) AS source_id, l_partkey AS source_key, CASE l_returnflag WHEN 'R' THEN 'REMOVE' WHEN 'A' THEN 'ADD' ELSE 'CHANGE' END AS change_type, CASE WHEN l_linenumber > 5 THEN NULL ELSE 'T' || CAST(l_linenumber AS VARCHAR(9)) END AS entity_type, l_shipdate AS created_at FROM lineitem"


@query("k08_change_volume", f"SELECT source_id, CAST(created_at AS DATE) AS day, change_type, coalesce(entity_type, 'UNKNOWN') AS entity_type, count(*) AS n FROM ({EVENTS}) GROUP BY ALL")
def k08(spark, sf_dir):
    e = derived(spark, sf_dir, EVENTS).select("source_id", F.to_date("created_at").alias("day"), "change_type", F.coalesce("entity_type", F.lit("UNKNOWN")).alias("entity_type"))
    return M.grouped(e, ["source_id", "day", "change_type", "entity_type"])


@query("k09_issues", "SELECT event_id AS issue_id, event_type AS category, props->>'$.k' AS message, ts::DATE AS first_seen FROM events WHERE event_type = 'error'")
def k09(spark, sf_dir):
    e = derived(spark, sf_dir, "SELECT * FROM events WHERE event_type = 'error'")
    return e.select(F.col("event_id").alias("issue_id"), F.col("event_type").alias("category"), F.get_json_object("props", "$.k").alias("message"), F.to_date("ts").alias("first_seen"))


SUBJ = "SELECT 'L' || CAST(c_custkey % 3 AS VARCHAR(9)) AS source_id, c_mktsegment AS entity_type FROM customer"
ENR = "SELECT 'P' || CAST(o_orderkey % 4 AS VARCHAR(9)) AS provider, 'L' || CAST(o_custkey % 4 AS VARCHAR(9)) AS source_id, c_mktsegment AS entity_type, o_orderstatus AS status FROM orders JOIN customer ON o_custkey = c_custkey"


@query("k10_enrichment_coverage", f"WITH s AS (SELECT source_id, entity_type, count(*) AS current_records FROM ({SUBJ}) GROUP BY ALL), e AS (SELECT provider, source_id, entity_type, status, count(*) AS n FROM ({ENR}) GROUP BY ALL) SELECT provider, source_id, entity_type, status, n, current_records, round(n / nullif(current_records, 0), 4) AS share_of_records FROM e LEFT JOIN s USING (source_id, entity_type)")
def k10(spark, sf_dir):
    return M.coverage(derived(spark, sf_dir, SUBJ), derived(spark, sf_dir, ENR))


@query("k11_notice_coverage", f"WITH e AS ({EVENTS}), l AS (SELECT DISTINCT source_id, source_key FROM ({LINKS}) WHERE status IN ('AUTO','APPROVED')) SELECT e.source_id, change_type, count(*) AS change_events, count(l.source_key) AS with_legal_evidence FROM e LEFT JOIN l ON l.source_id = e.source_id AND l.source_key = e.source_key WHERE created_at > DATE '2001-06-30' - 90 GROUP BY 1, 2")
def k11(spark, sf_dir):
    return M.notice_coverage(derived(spark, sf_dir, EVENTS), derived(spark, sf_dir, LINKS), _now())


@query("k12_notices", "SELECT page_id AS notice_id, url, count(d.doc_id) AS links FROM pages LEFT JOIN documents d ON d.doc_id % 400 = page_id GROUP BY 1, 2")
def k12(spark, sf_dir):
    links = derived(spark, sf_dir, "SELECT doc_id % 400 AS notice_id FROM documents")
    return M.with_counts(derived(spark, sf_dir, "SELECT page_id AS notice_id, url FROM pages"), links, "notice_id", links=F.count("*"))


@query("k13_removal_holds", f"SELECT source_id, status, count(*) AS n, min(created_at)::DATE AS oldest FROM ({CANDS}) GROUP BY 1, 2")
def k13(spark, sf_dir):
    return M.grouped(derived(spark, sf_dir, CANDS), ["source_id", "status"], oldest=F.to_date(F.min("created_at")))


@query("k14_proposals", f"SELECT kind, status, maker, count(*) AS n, min(change_id) AS oldest, max(change_id) AS newest FROM ({PROPS}) GROUP BY 1, 2, 3")
def k14(spark, sf_dir):
    return M.grouped(derived(spark, sf_dir, PROPS), ["kind", "status", "maker"], oldest=F.min("change_id"), newest=F.max("change_id"))


@query("k15_incidents", "SELECT doc_id AS incident_id, left(text, 500) AS summary, left(text, 1000) AS diagnosis FROM documents")
def k15(spark, sf_dir):
    d = derived(spark, sf_dir, "SELECT doc_id, text FROM documents")
    return d.select(F.col("doc_id").alias("incident_id"), F.left("text", F.lit(500)).alias("summary"), F.left("text", F.lit(1000)).alias("diagnosis"))


@query("k16_cycle_activity", "SELECT conv_id AS cycle_id, count(*) FILTER (role = 'assistant') AS tool_calls, count(*) FILTER (role = 'assistant' AND turn % 4 = 1) AS denied_calls FROM conversations GROUP BY 1")
def k16(spark, sf_dir):
    c = derived(spark, sf_dir, "SELECT conv_id AS cycle_id, turn, role FROM conversations")
    denied = F.count_if(F.col("turn") % 4 == 1)
    return M.with_counts(c.select("cycle_id").distinct(), c.where("role = 'assistant'"), "cycle_id", tool_calls=F.count("*"), denied_calls=denied)


@query("k17_tool_usage", "SELECT role AS tool, turn % 2 = 0 AS allowed, count(*) AS n, round(avg(length(text))) AS avg_ms FROM conversations GROUP BY 1, 2")
def k17(spark, sf_dir):
    c = derived(spark, sf_dir, "SELECT role AS tool, turn % 2 = 0 AS allowed, text FROM conversations")
    return M.grouped(c, ["tool", "allowed"], avg_ms=F.round(F.avg(F.length("text"))))


@query("k18_signals", "SELECT event_type AS provider, 'T' || (user_id % 10) AS target_source_id, count(*) AS n, count(*) FILTER (event_id % 3 = 0) AS unconsumed, min(ts) FILTER (event_id % 3 = 0)::DATE AS oldest_unconsumed FROM events GROUP BY 1, 2")
def k18(spark, sf_dir):
    e = derived(spark, sf_dir, "SELECT event_type AS provider, 'T' || (user_id % 10) AS target_source_id, CASE WHEN event_id % 3 <> 0 THEN ts END AS consumed_at, ts FROM events")
    free = F.col("consumed_at").isNull()
    return M.grouped(e, ["provider", "target_source_id"], unconsumed=F.count_if(free), oldest_unconsumed=F.to_date(F.min(F.when(free, F.col("ts")))))


@query("k19_snapshots", "SELECT o_custkey AS snapshot_id, count(*) FILTER (o_orderstatus = 'F') AS held_removals, count(DISTINCT o_orderpriority) AS sources_pinned FROM orders GROUP BY 1")
def k19(spark, sf_dir):
    o = derived(spark, sf_dir, "SELECT o_custkey AS snapshot_id, o_orderkey, o_orderstatus, o_orderpriority FROM orders")
    parents = o.groupBy("snapshot_id").agg(F.collect_list(F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey"))).alias("held")).select("snapshot_id", F.size("held").cast("long").alias("held_removals"))
    return M.with_counts(parents, o.select("snapshot_id", "o_orderpriority").distinct(), "snapshot_id", sources_pinned=F.count("*"))


@query("k20_field_catalog", "WITH f AS (SELECT DISTINCT p_brand AS source_id, p_type AS field, CASE WHEN p_type = 'ECONOMY' THEN '*' ELSE p_type END AS entity_type FROM part), x AS (SELECT source_id, field, unnest(CASE WHEN entity_type = '*' THEN ['PERSON','VESSEL'] ELSE [entity_type] END) AS entity_type FROM f) SELECT source_id, field, entity_type, CASE WHEN source_id = 'Brand#1' AND entity_type = 'PERSON' THEN 0.7::DOUBLE END AS floor FROM x")
def k20(spark, sf_dir):
    f = derived(spark, sf_dir, "SELECT DISTINCT p_brand AS source_id, p_type AS field, CASE WHEN p_type = 'ECONOMY' THEN '*' ELSE p_type END AS entity_type FROM part")
    floors = spark.createDataFrame([("Brand#1", "ECONOMY", "PERSON", 0.7)], "source_id string, field string, entity_type string, floor double")
    return M.field_catalog(f, floors, ["PERSON", "VESSEL"])


@query("k21_fetch_health", f"SELECT source_id, strftime(date_trunc('hour', fetched_at), '%Y-%m-%d %H') AS hour, count(*) AS attempts, count(*) FILTER (error_class IS NULL) AS ok, count(error_class) AS failed, coalesce(array_to_string(list_sort(list(DISTINCT error_class) FILTER (error_class IS NOT NULL)), ','), '') AS error_classes, round(avg(duration_ms)) AS avg_ms, max(size_bytes) AS max_bytes FROM ({FETCHES}) GROUP BY 1, date_trunc('hour', fetched_at)")
def k21(spark, sf_dir):
    h = M.fetch_health(derived(spark, sf_dir, FETCHES))
    return h.withColumns({"hour": F.date_format("hour", "yyyy-MM-dd HH"), "error_classes": F.array_join("error_classes", ",")})


@query("k22_latest_metrics", f"WITH m AS ({METRICS}) SELECT * FROM m WHERE seq = (SELECT max(seq) FROM m x WHERE x.source_id = m.source_id)")
def k22(spark, sf_dir):
    return M.latest_metrics(derived(spark, sf_dir, METRICS))


@query("k24_count_trend", f"SELECT CAST(created_at AS DATE) AS day, count(*) AS n, count(*) FILTER (change_type = 'ADD') AS added FROM ({EVENTS}) WHERE CAST(created_at AS DATE) > DATE '2001-06-30' - 60 AND CAST(created_at AS DATE) <= DATE '2001-06-30' GROUP BY 1")
def k24(spark, sf_dir):
    return M.daily(derived(spark, sf_dir, EVENTS), "created_at", _now(), 60, n=F.count("*"), added=F.count_if(F.col("change_type") == "ADD"))


@query("k25_batch_page", f"WITH {_LATEST} SELECT run_id, batch_id, source_id FROM latest WHERE queued_at < TIMESTAMP '2001-06-01' ORDER BY queued_at DESC, run_id DESC LIMIT 50")
def k25(spark, sf_dir):
    return M.page(M.latest_attempts(derived(spark, sf_dir, RUNS)).where("queued_at < TIMESTAMP_NTZ '2001-06-01'"), "queued_at", "run_id", 50).select("run_id", "batch_id", "source_id")


@query("k26_error_history", f"WITH f AS ({FETCHES}), b AS (SELECT *, row_number() OVER (PARTITION BY source_id, error_class ORDER BY fetched_at DESC, event_id DESC) AS r FROM f WHERE error_class IS NOT NULL) SELECT source_id, error_class, count(*) AS n, min(fetched_at)::DATE AS first_day, max(fetched_at)::DATE AS last_day, array_to_string(list_sort(list(event_id) FILTER (r <= 5)), ',') AS samples FROM b GROUP BY 1, 2")
def k26(spark, sf_dir):
    h = M.error_history(derived(spark, sf_dir, FETCHES))
    return h.select("source_id", "error_class", "n", F.to_date("first_at").alias("first_day"), F.to_date("last_at").alias("last_day"), F.array_join(F.col("sample_ids").cast("array<string>"), ",").alias("samples"))


@query("k27_daily_usage", "SELECT ts::DATE AS day, round(sum(value), 2) AS spend, count(*) FILTER (event_type = 'error') AS errors FROM events WHERE ts::DATE > DATE '2024-01-31' - 30 AND ts::DATE <= DATE '2024-01-31' GROUP BY 1")
def k27(spark, sf_dir):
    return M.daily(derived(spark, sf_dir, "SELECT * FROM events"), "ts", F.to_timestamp(F.lit("2024-01-31")), 30, spend=F.round(F.sum("value"), 2), errors=F.count_if(F.col("event_type") == "error"))


@query("k28_archived_inputs", f"WITH v AS (SELECT *, version_id % 500 AS sha FROM ({VERS})) SELECT source_id, sha, max(seq) AS seq FROM v GROUP BY 1, 2")
def k28(spark, sf_dir):
    v = derived(spark, sf_dir, VERS).withColumn("sha", F.col("version_id") % 500)
    return M.latest(v, ["source_id", "sha"], F.col("seq").desc()).select("source_id", "sha", "seq")


@query("k29_gauges", f"WITH r AS ({RUNS}), c AS ({CANDS}) SELECT 'runs' AS metric, 'status=' || status AS labels, count(*)::DOUBLE AS value FROM r GROUP BY status UNION ALL SELECT 'held', '', count(*)::DOUBLE FROM c WHERE status = 'PENDING' UNION ALL SELECT 'records', 'source_id=' || source_id, max(added)::DOUBLE FROM r GROUP BY source_id")
def k29(spark, sf_dir):
    r, c = derived(spark, sf_dir, RUNS), derived(spark, sf_dir, CANDS)
    return M.gauges({
        "runs": (r.groupBy("status").agg(F.count("*").alias("v")), "v", ["status"]),
        "held": (c.where("status = 'PENDING'").agg(F.count("*").alias("v")), "v", []),
        "records": (r.groupBy("source_id").agg(F.max("added").alias("v")), "v", ["source_id"]),
    })


@query("k30_state_summary", f"WITH s AS ({SOURCES}), r AS (SELECT source_id, max(run_id) AS active_run FROM ({RUNS}) WHERE status = 'RUNNING' GROUP BY 1) SELECT source_id, replace(replace({_HEALTH}, 'stale_warning', 'stale_warn'), 'stale', 'stale') AS health, active_run FROM s LEFT JOIN r USING (source_id)")
def k30(spark, sf_dir):
    active = M.latest(derived(spark, sf_dir, RUNS).where("status = 'RUNNING'"), ["source_id"], F.col("run_id").desc()).select("source_id", F.col("run_id").alias("active_run"))
    s = derived(spark, sf_dir, SOURCES)
    return s.join(active, "source_id", "left").select("source_id", M.health(_now(), {"warn": "stale_warn"}).alias("health"), "active_run")


@query("k31_model_cost", "SELECT conv_id, round(((sum(length(text)) - sum(turn)) * 3.0 + sum(turn) * 1.0 + count(*) * 15.0) / 1e6, 6) AS cost_usd FROM conversations GROUP BY 1")
def k31(spark, sf_dir):
    u = derived(spark, sf_dir, "SELECT conv_id, sum(length(text)) AS input_tokens, sum(turn) AS cached_tokens, count(*) AS output_tokens FROM conversations GROUP BY 1")
    return M.model_cost(u, (3.0, 1.0, 15.0)).select("conv_id", "cost_usd")
