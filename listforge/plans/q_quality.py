"""Registered queries: quality measures and gates (section D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merkle as M
from ..operators import quality as Q
from ..operators import removals as R
from ..session import new_path
from ..sources import splitxml as X
from .derive import IDENTIFIERS, PARTY1, PARTY2, derived
from .registry import query

NAMES = "SELECT c_custkey, 1 AS i, 'PRIMARY' AS name_type, c_name AS full_name, 'STRONG' AS quality FROM customer UNION ALL SELECT c_custkey, 2, 'ALIAS', c_mktsegment, CASE WHEN c_custkey % 4 = 0 THEN 'WEAK' WHEN c_custkey % 4 = 1 THEN 'UNKNOWN' ELSE 'STRONG' END FROM customer WHERE c_custkey % 3 <> 0"
TYPE = "CASE c_mktsegment WHEN 'MACHINERY' THEN 'VESSEL' WHEN 'BUILDING' THEN 'ORGANIZATION' WHEN 'AUTOMOBILE' THEN 'AIRCRAFT' ELSE 'PERSON' END"


def documents(spark, sf_dir):
    """Nested party documents from customers, orders and nations."""
    names = derived(spark, sf_dir, NAMES).groupBy("c_custkey").agg(F.array_sort(F.collect_list(F.struct("i", "name_type", "full_name", "quality"))).alias("names"))
    ids = R.identifier_rows(derived(spark, sf_dir, IDENTIFIERS).where("trim(value) <> ''"), "label", "value")
    ids = ids.groupBy(F.col("source_key").alias("c_custkey")).agg(F.array_sort(F.collect_list(F.struct("rid", "id_type", "value_norm", "checksum_valid"))).alias("identifiers"))
    base = derived(spark, sf_dir, f"SELECT c_custkey, {TYPE} AS entity_type, c_nationkey, c_acctbal FROM customer")
    text = lambda cond, v: F.when(cond, F.lit(v) if isinstance(v, str) else v)
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    return base.join(names, "c_custkey").join(ids, "c_custkey", "left").select(
        k, "entity_type", "names", "identifiers",
        F.when(k % 4 != 1, F.array(F.struct(text(k % 2 == 0, "Main St").alias("street"), text(k % 5 != 0, F.col("c_nationkey").cast("string")).alias("country_iso2"), F.lit("X").alias("country_raw")))).alias("addresses"),
        F.array(F.struct(F.when(k % 3 == 0, F.to_date(F.lit("2020-01-01"))).alias("listed_on"), text(k % 6 == 0, "P1").alias("program_code"), F.when(k % 7 == 0, F.array(F.lit("ASSET_FREEZE"))).otherwise(F.array().cast("array<string>")).alias("measures"), none.alias("reason"), none.alias("evidence_url"), text(k % 8 == 0, "Reg").alias("legal_basis"))).alias("listings"),
        F.array(F.struct(F.when(k % 3 == 0, "DAY").when(k % 3 == 1, "YEAR").otherwise("UNKNOWN").alias("precision"))).alias("birth_dates"),
        F.array().cast("array<string>").alias("birth_places"),
        F.array(F.struct(F.when(k % 2 == 0, "NATIONALITY").otherwise("RESIDENCE").alias("kind"), none.alias("country_iso2"), text(k % 9 == 0, "Y").alias("country_raw"))).alias("countries"),
        F.when(k % 10 == 0, F.array(F.lit("owner"))).alias("relationships"),
        F.struct(text(k % 3 == 0, "PA").alias("flag_iso2"), none.alias("flag_raw"), F.array().cast("array<string>").alias("former_flags"), F.lit("tanker").alias("vessel_type"), F.when(k % 5 == 0, 1999).alias("build_year"), none.alias("owner_operator_raw")).alias("vessel"),
        F.struct(text(k % 2 == 1, "A1").alias("model"), none.alias("operator_raw")).alias("aircraft"),
        text(k % 2 == 0, "M").alias("gender"),
    )


_share = lambda c: f"round(avg(CASE WHEN {c} THEN 1 ELSE 0 END), 4)"
_k = "c_custkey"
_has = lambda *ls: "len(list_intersect(ls, [" + ",".join(f"'{x}'" for x in ls) + "])) > 0"
_FIELDS = {
    "*": {"alias": f"{_k} % 3 <> 0", "address": f"{_k} % 4 <> 1", "address_country": f"{_k} % 4 <> 1 AND {_k} % 5 <> 0", "street": f"{_k} % 4 <> 1 AND {_k} % 2 = 0", "listed_on": f"{_k} % 3 = 0",
          "program": f"{_k} % 6 = 0", "measures": f"{_k} % 7 = 0", "reason": "false", "legal_evidence": f"{_k} % 8 = 0"},
    "PERSON": {"dob": f"{_k} % 3 <> 2", "dob_full": f"{_k} % 3 = 0", "birth_place": "false", "nationality": f"{_k} % 2 = 0", "passport": _has("Passport"), "national_id": "false", "gender": f"{_k} % 2 = 0"},
    "ORGANIZATION": {"country": f"{_k} % 9 = 0 OR {_k} % 4 <> 1", "registration_id": "false", "lei": "false", "ownership_link": f"{_k} % 10 = 0"},
    "VESSEL": {"imo": _has("IMO number"), "imo_valid": "ok", "mmsi": _has("MMSI"), "call_sign": "false", "flag": f"{_k} % 3 = 0", "former_flag": "false", "vessel_type": "true", "build_year": f"{_k} % 5 = 0", "owner_link": f"{_k} % 10 = 0"},
    "AIRCRAFT": {"msn": "false", "tail": "false", "model": f"{_k} % 2 = 1", "operator": "false"},
}
_imo = "(7*substr(n,1,1)::INT+6*substr(n,2,1)::INT+5*substr(n,3,1)::INT+4*substr(n,4,1)::INT+3*substr(n,5,1)::INT+2*substr(n,6,1)::INT)%10 = substr(n,7,1)::INT"
_BASE = f"""WITH i AS (SELECT source_key, list(label) AS ls, bool_or(label = 'IMO number' AND {_imo}) AS ok FROM (SELECT *, lpad(CASE WHEN label = 'IMO number' THEN regexp_extract(value, '(\\d{{7}})', 1) ELSE '' END, 7, '0') AS n FROM ({IDENTIFIERS}) WHERE trim(value) <> '') GROUP BY 1),
b AS (SELECT c_custkey, {TYPE} AS entity_type, coalesce(ls, []) AS ls, coalesce(ok, false) AS ok FROM customer LEFT JOIN i ON source_key = c_custkey)"""


@query("d04_fill_rates", _BASE + " " + " UNION ALL ".join(f"SELECT entity_type, '{f}' AS field, {_share(c)}::DOUBLE AS value FROM b {'' if t == '*' else f'WHERE entity_type = {chr(39)}{t}{chr(39)}'} GROUP BY entity_type" for t, g in _FIELDS.items() for f, c in g.items()))
def d04(spark, sf_dir):
    return Q.fill_rates(documents(spark, sf_dir), Q.fill_predicates())


@query("d03_type_counts", f"SELECT coalesce({TYPE}, 'UNKNOWN') AS entity_type, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT '*', count(*) FROM customer")
def d03(spark, sf_dir):
    return Q.counts_by_type(derived(spark, sf_dir, f"SELECT {TYPE} AS entity_type FROM customer"))


@query("d05_alias_quality", f"SELECT round(avg((quality = 'WEAK')::INT), 4) AS weak_alias_share, round(avg((quality = 'UNKNOWN')::INT), 4) AS alias_quality_unknown_share FROM ({NAMES}) WHERE name_type <> 'PRIMARY'")
def d05(spark, sf_dir):
    return Q.alias_shares(documents(spark, sf_dir))


@query("d06_checksum_rates", f"SELECT 'IMO' AS id_type, round(avg(({_imo})::INT), 4) AS pass_rate FROM (SELECT regexp_extract(value, '(\\d{{7}})', 1) AS n FROM ({IDENTIFIERS}) WHERE label = 'IMO number')")
def d06(spark, sf_dir):
    ids = R.identifier_rows(derived(spark, sf_dir, IDENTIFIERS).where("trim(value) <> ''"), "label", "value")
    return Q.checksum_rates(ids)


RAWC = "SELECT CASE WHEN o_custkey % 50 = 0 THEN 'unknown ' WHEN o_custkey % 50 = 1 THEN '' ELSE o_orderpriority || '/' || o_orderstatus END AS country_raw, CASE WHEN o_orderkey % 3 = 0 THEN 'DE' END AS country_iso2 FROM orders"


@query("d07_unmapped_countries", f"SELECT left(country_raw, 80) AS value, count(*) AS n FROM ({RAWC}) WHERE country_iso2 IS NULL AND country_raw <> '' AND upper(trim(country_raw)) NOT IN ('UNKNOWN', '00') GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def d07(spark, sf_dir):
    return Q.unmapped(derived(spark, sf_dir, RAWC), top=10)


PREC = "SELECT o_custkey, list(DISTINCT CASE o_orderpriority WHEN '1-URGENT' THEN 'DAY' WHEN '2-HIGH' THEN 'MONTH' WHEN '3-MEDIUM' THEN 'YEAR' WHEN '5-LOW' THEN 'UNKNOWN' ELSE 'OTHER' END) AS ps FROM orders GROUP BY 1"


@query("d08_precision_mix", f"WITH p AS (SELECT CASE WHEN list_contains(ps, 'DAY') THEN 'DAY' WHEN list_contains(ps, 'MONTH') THEN 'MONTH' WHEN list_contains(ps, 'YEAR') THEN 'YEAR' WHEN list_contains(ps, 'UNKNOWN') THEN 'UNKNOWN' ELSE 'NONE' END AS precision FROM ({PREC})) SELECT precision, round(count(*) / (SELECT count(*) FROM p), 4) AS share FROM p GROUP BY 1")
def d08(spark, sf_dir):
    return Q.precision_mix(derived(spark, sf_dir, PREC.replace("list(DISTINCT", "collect_set(")), "ps")


METRICS = "SELECT 'S' || CAST(l_suppkey % 20 AS VARCHAR(9)) AS source_id, CAST(l_partkey % 8 AS INT) AS seq, l_shipmode_f AS field, round(CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS DOUBLE) / (10 * count(*)), 4) AS value FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode_f FROM lineitem) x GROUP BY ALL"
_M = METRICS


@query(
    "d09_metric_status",
    f"WITH m AS ({_M}), cur AS (SELECT * FROM m WHERE seq = 7), prev AS (SELECT * FROM m WHERE seq = 6) SELECT c.source_id, c.field, c.value, 0.5::DOUBLE AS floor, p.value AS prev_value, CASE WHEN c.value < 0.5 THEN 'FAIL' WHEN c.value < 0.5 + 0.05 THEN 'WARN' ELSE 'OK' END AS status FROM cur c LEFT JOIN prev p USING (source_id, field)",
)
def d09(spark, sf_dir):
    m = derived(spark, sf_dir, METRICS)
    floors = m.select("source_id", "field").distinct().withColumn("floor", F.lit(0.5))
    return Q.with_floors(m.where("seq = 7").drop("seq"), floors, m.where("seq = 6"), ["source_id", "field"])


VERSION = """SELECT o_custkey AS version_id, count(*) AS records, sum(CASE WHEN o_orderkey % 41 = 0 THEN 1 ELSE 0 END) AS skipped, sum(CASE WHEN o_orderkey % 53 = 0 THEN 1 ELSE 0 END) AS duplicates,
 sum(CASE WHEN o_orderkey % 59 = 0 THEN 1 ELSE 0 END) AS drift, 0 AS bad_countries, sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS bad_dates, sum(CASE WHEN o_orderkey % 43 = 0 THEN 1 ELSE 0 END) AS bad_imo, sum(CASE WHEN o_orderkey % 47 = 0 THEN 1 ELSE 0 END) AS bad_lei,
 CAST(min(o_orderkey) % 4000 AS BIGINT) AS added, CAST(max(o_orderkey) % 120 AS BIGINT) AS removed, CAST(o_custkey % 3 * 1000 AS BIGINT) AS previous FROM orders GROUP BY o_custkey"""
#: Fill rates of a version's types, and parser warnings by category.
RATES = "SELECT o_custkey AS version_id, CASE WHEN o_orderstatus = 'F' THEN 'PERSON' WHEN o_orderstatus = 'O' THEN 'VESSEL' ELSE 'AIRCRAFT' END AS entity_type, 'dob' AS field, CAST(sum(CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END) AS DOUBLE) / count(*) AS value FROM orders GROUP BY 1, 2"
WARNED = "SELECT o_custkey AS version_id, CASE WHEN o_orderkey % 5 = 0 THEN 'PARSE_WARNING' WHEN o_orderkey % 5 = 1 THEN 'DATE' WHEN o_orderkey % 5 = 2 THEN 'odd' ELSE 'COUNTRY' END AS category, CAST(sum(o_orderkey % 2) AS BIGINT) AS n FROM orders GROUP BY 1, 2"
FLOORS = {"PERSON": 0.9, "VESSEL": 2 / 3, "ORGANIZATION": 0.99}
_SP = f"""WITH m AS ({VERSION}), whole AS (SELECT version_id, NULL::VARCHAR AS field, unnest([
 {{'ord': 0, 'gate': 'MIN_RECORDS', 'status': CASE WHEN records < 8 THEN 'FAIL' END}}, {{'ord': 1, 'gate': 'SKIPPED', 'status': CASE WHEN skipped / greatest(records + skipped, 1) > 0.01 THEN 'FAIL' WHEN skipped > 0 THEN 'WARN' END}},
 {{'ord': 2, 'gate': 'DUPLICATES', 'status': CASE WHEN duplicates > 0 THEN 'WARN' END}}, {{'ord': 4, 'gate': 'SCHEMA_DRIFT', 'status': CASE WHEN drift > 0 THEN 'WARN' END}},
 {{'ord': 6, 'gate': 'CHECKSUM_IMO', 'status': CASE WHEN bad_imo > 0 THEN 'WARN' END}}, {{'ord': 7, 'gate': 'CHECKSUM_LEI', 'status': CASE WHEN bad_lei > 0 THEN 'WARN' END}},
 {{'ord': 8, 'gate': 'UNMAPPED_COUNTRY', 'status': CASE WHEN bad_countries > 0 THEN 'WARN' END}}, {{'ord': 9, 'gate': 'UNPARSEABLE_DATE', 'status': CASE WHEN bad_dates > 0 THEN 'WARN' END}},
 {{'ord': 10, 'gate': 'LARGE_REMOVAL', 'status': CASE WHEN previous > 0 AND (removed > 50 OR removed > 0.05 * previous) THEN 'HOLD' END}}, {{'ord': 11, 'gate': 'LARGE_ADDITION', 'status': CASE WHEN previous > 0 AND added > 1500 AND added > 0.3 * previous THEN 'HOLD' END}}], recursive := true) FROM m),
fl AS (SELECT * FROM (VALUES {", ".join(f"('{t}', {v!r}::DOUBLE)" for t, v in FLOORS.items())}) f(entity_type, floor)),
g AS (SELECT * FROM whole UNION ALL SELECT version_id, entity_type || '.dob', 5, 'FILL_FLOOR', CASE WHEN value < floor THEN 'FAIL' WHEN value < floor + 0.05 THEN 'WARN' END FROM ({RATES}) JOIN fl USING (entity_type)
 UNION ALL SELECT version_id, CASE WHEN category IN ('DATE', 'COUNTRY') THEN category ELSE 'PARSE_WARNING' END, 3, 'PARSER_WARNING', 'WARN' FROM ({WARNED}) WHERE category <> 'PARSE_WARNING' AND n > 0)"""


def _gates(spark, sf_dir):
    floors = spark.createDataFrame([(t, "dob", v) for t, v in FLOORS.items()], "entity_type string, field string, floor double")
    m = derived(spark, sf_dir, VERSION)
    return m, Q.all_gates(m, derived(spark, sf_dir, RATES), floors, derived(spark, sf_dir, WARNED), ["version_id"], known=("DATE", "COUNTRY"), min_records=8)


@query("d10_d16_gates", _SP + " SELECT version_id, field, gate, status FROM g WHERE status IS NOT NULL")
def d10(spark, sf_dir):
    return _gates(spark, sf_dir)[1].select("version_id", "field", "gate", "status")


@query("d17_outcomes", _SP + ", b AS (SELECT version_id, max(CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END) AS fail, arg_min(gate, CASE WHEN status = 'FAIL' THEN 0 ELSE 100 END + ord) AS primary_error FROM g WHERE status IN ('FAIL','HOLD') GROUP BY 1) SELECT version_id, CASE fail WHEN 1 THEN 'QUARANTINE' WHEN 0 THEN 'HOLD' ELSE 'PASS' END AS outcome, primary_error FROM m LEFT JOIN b USING (version_id)")
def d17(spark, sf_dir):
    return Q.outcome(*_gates(spark, sf_dir), "version_id")


@query("f13_dry_run", _SP + ", b AS (SELECT version_id, max(CASE WHEN status = 'FAIL' THEN 1 ELSE 0 END) AS fail FROM g WHERE status IN ('FAIL','HOLD') GROUP BY 1) SELECT 'DRY_RUN_' || CASE fail WHEN 1 THEN 'QUARANTINE' WHEN 0 THEN 'HOLD' ELSE 'PASS' END AS result, count(*) AS n, 0::BIGINT AS published FROM m LEFT JOIN b USING (version_id) GROUP BY 1")
def f13(spark, sf_dir):
    out = Q.outcome(*_gates(spark, sf_dir), "version_id")
    return out.groupBy(F.concat(F.lit("DRY_RUN_"), "outcome").alias("result")).agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("published"))


MARK = "SELECT o_orderkey AS version_id, 'S' || CAST(o_custkey % 40 AS VARCHAR(9)) AS source_id, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS published_at, o_orderstatus AS st FROM orders"


@query("d18_marker_regression", f"WITH m AS ({MARK}), l AS (SELECT source_id, max(published_at) AS last_at FROM m WHERE st = 'F' AND version_id % 5 = 1 GROUP BY 1) SELECT version_id, CASE WHEN published_at IS NULL THEN 'MISSING_MARKER' WHEN published_at < last_at THEN 'REGRESSION' ELSE 'OK' END AS marker FROM m LEFT JOIN l USING (source_id) WHERE st = 'O'")
def d18(spark, sf_dir):
    m = derived(spark, sf_dir, MARK)
    return Q.marker_regression(m.where("st = 'O'"), m.where("st = 'F' AND version_id % 5 = 1")).select("version_id", "marker")


@query("d01_path_census", "SELECT path, count(*) AS n FROM (SELECT unnest(['/event/' || event_type || '/' || k, '/event']) AS path FROM (SELECT event_type, unnest(json_keys(props)) AS k FROM events)) GROUP BY 1")
def d01(spark, sf_dir):
    ev = derived(spark, sf_dir, "SELECT event_type, props FROM events")
    keys = ev.select("event_type", F.explode(F.json_object_keys("props")).alias("k"))
    paths = keys.select(F.explode(F.array(F.concat(F.lit("/event/"), "event_type", F.lit("/"), "k"), F.lit("/event"))).alias("path"))
    return paths.groupBy("path").agg(F.count("*").alias("n"))


@query("d01_xml_census", "WITH e AS (SELECT '/events/event' AS p, event_id // 10000 AS part, event_type, json_keys(props) AS ks FROM events), r AS (SELECT DISTINCT part FROM e) SELECT path, count(*) AS n FROM (SELECT p AS path FROM e UNION ALL SELECT p || '/@type' FROM e UNION ALL SELECT p || '/' || event_type FROM e UNION ALL SELECT p || '/props/' || unnest(ks) FROM e UNION ALL SELECT p || '/props' FROM e UNION ALL SELECT '/events' FROM r UNION ALL SELECT '/events/@v' FROM r) GROUP BY 1")
def d01_xml(spark, sf_dir):
    """Events as XML files of ten thousand each, counted by ranges of the files."""
    keys = F.array_join(F.transform(F.json_object_keys("props"), lambda k: F.concat(F.lit("<"), k, F.lit(">x</"), k, F.lit(">"))), "")
    el = F.concat(F.lit('<event type="a > b"><'), "event_type", F.lit("/><props>"), keys, F.lit("</props></event>"))
    ev = derived(spark, sf_dir, "SELECT event_id, event_id DIV 10000 AS part, event_type, props FROM events").select("part", F.col("event_id").alias("at"), el.alias("value"))
    edge = lambda at, text: ev.select("part", F.lit(at).alias("at"), F.lit(text).alias("value")).distinct()
    rows = ev.union(edge(-1, '<?xml version="1.0"?><events v="1">')).union(edge(2**62, "<!-- <end> --></events>"))
    path = new_path(spark, "events-xml")
    rows.repartition("part").sortWithinPartitions("part", "at").drop("at").write.partitionBy("part").text(path)
    return X.path_census(spark, path)


@query("d02_schema_drift", "SELECT path, count(*) AS n FROM (SELECT '/event/' || event_type AS path FROM events) WHERE path NOT IN ('/event/click', '/event/view') GROUP BY 1")
def d02(spark, sf_dir):
    known = spark.createDataFrame([("/event/click",), ("/event/view",)], "path string")
    paths = derived(spark, sf_dir, "SELECT concat('/event/', event_type) AS path FROM events").groupBy("path").agg(F.count("*").alias("n"))
    return Q.drift(paths, known)


ISS = "SELECT l_orderkey * 10 + l_linenumber AS issue_id, 'S' || CAST(l_suppkey % 20 AS VARCHAR(9)) AS source_id, 'C' || CAST(l_partkey % 30 AS VARCHAR(9)) AS category, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS field, l_linestatus AS st FROM lineitem"


@query("d19_resolved_issues", f"WITH i AS ({ISS}), n AS (SELECT DISTINCT source_id, category, coalesce(field, '') AS f FROM i WHERE st = 'O' AND issue_id % 3 = 0) SELECT issue_id, source_id, category FROM i WHERE st = 'F' AND NOT EXISTS (SELECT 1 FROM n WHERE n.source_id = i.source_id AND n.category = i.category AND n.f = coalesce(i.field, ''))")
def d19(spark, sf_dir):
    i = derived(spark, sf_dir, ISS)
    return Q.resolved_issues(i.where("st = 'F'"), i.where("st = 'O' AND issue_id % 3 = 0")).select("issue_id", "source_id", "category")


@query("d20_suggested_floors", f"WITH m AS ({_M}), r AS (SELECT *, dense_rank() OVER (PARTITION BY source_id ORDER BY seq DESC) AS r FROM m) SELECT source_id, field, min(value) AS lo, max(value) AS hi, count(*) AS n, round(greatest(min(value) - 0.05, 0), 4) AS floor FROM r WHERE r <= 5 GROUP BY 1, 2 HAVING min(value) >= 0.2")
def d20(spark, sf_dir):
    return Q.suggest_floors(derived(spark, sf_dir, METRICS))


@query("a15_unchanged_inputs", f"WITH p1 AS (SELECT source_id, sha256(string_agg(source_key || amount, ',' ORDER BY source_key)) AS h FROM ({PARTY1}) GROUP BY 1), p2 AS (SELECT source_id, sha256(string_agg(source_key || amount, ',' ORDER BY source_key)) AS h FROM ({PARTY2}) GROUP BY 1) SELECT p2.source_id, CASE WHEN p1.h = p2.h THEN 'NO_CHANGE' ELSE 'PARSE' END AS step FROM p2 LEFT JOIN p1 USING (source_id) UNION ALL SELECT source_id, 'NO_CHANGE' FROM p1")
def a15(spark, sf_dir):
    from ..sources.landing import unchanged

    shas = lambda sql: M.roots(derived(spark, sf_dir, sql), ["source_id"], ["source_key"], "amount").withColumnRenamed("root", "sha256")
    p1, p2 = shas(PARTY1), shas(PARTY2)
    known = p1.withColumn("status", F.lit("PUBLISHED"))
    return unchanged(p2, known).unionByName(unchanged(p1, known)).select("source_id", "step")
