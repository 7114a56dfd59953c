"""Registered queries: diff, versions, snapshots, removals (section F)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import intervals as IV
from ..operators import jsondiff as J
from ..operators import kept as KM
from ..operators import merkle as M
from ..operators import publish as PB
from ..operators import removals as R
from ..operators import versioning as V
from ..session import durable, new_path
from .derive import IDENTIFIERS, PARTY1, PARTY2, PARTY3, derived
from .registry import query

KEYS = ["source_id", "source_key"]
FIELDS = ["entity_type", "primary_name", "country", "amount"]


def _hashed(spark, sf_dir, sql):
    return derived(spark, sf_dir, sql).withColumn("content_hash", F.sha2(F.concat_ws("|", *FIELDS), 256))


def _versions(spark, sf_dir):
    return [_hashed(spark, sf_dir, s) for s in (PARTY1, PARTY2, PARTY3)]


HASH = "sha256(concat_ws('|', entity_type, primary_name, country, amount))"
P = f"p1 AS (SELECT *, {HASH} AS h FROM ({PARTY1})), p2 AS (SELECT *, {HASH} AS h FROM ({PARTY2})), p3 AS (SELECT * FROM p1)"


def _d(name: str, a: str, b: str) -> str:
    return f"""{name} AS (SELECT coalesce(n.source_id, o.source_id) AS source_id, coalesce(n.source_key, o.source_key) AS source_key,
  CASE WHEN o.h IS NULL THEN 'ADD' WHEN n.h IS NULL THEN 'REMOVE' WHEN o.h <> n.h THEN 'CHANGE' ELSE 'SAME' END AS change_type, o.h AS old_hash, n.h AS new_hash,
  coalesce(n.entity_type, o.entity_type) AS entity_type, coalesce(n.primary_name, o.primary_name) AS primary_name
  FROM {a} o FULL JOIN {b} n ON o.source_key = n.source_key AND o.source_id = n.source_id)"""


WITH = f"WITH {P}, {_d('d12', 'p1', 'p2')}, {_d('d23x', 'p2', 'p3')}, d23 AS (SELECT * REPLACE (CASE WHEN change_type = 'ADD' AND source_key IN (SELECT source_key FROM p1) THEN 'RELIST' ELSE change_type END AS change_type) FROM d23x)"
LOG = WITH + """, log AS (SELECT source_id, source_key, 'ADD' AS change_type, h, entity_type, 1 AS seq FROM p1
  UNION ALL SELECT source_id, source_key, change_type, new_hash, entity_type, 2 FROM d12 WHERE change_type <> 'SAME'
  UNION ALL SELECT source_id, source_key, change_type, new_hash, entity_type, 3 FROM d23 WHERE change_type <> 'SAME'),
v AS (SELECT * FROM (SELECT *, lead(seq) OVER (PARTITION BY source_id, source_key ORDER BY seq) AS valid_to FROM log) WHERE change_type <> 'REMOVE')"""


def _changes(spark, sf_dir):
    p1, p2, p3 = _versions(spark, sf_dir)
    keep = ("entity_type", "primary_name")
    d12 = V.diff(p1, p2, KEYS, keep=keep)
    d23 = V.promote_relisted(V.diff(p2, p3, KEYS, keep=keep), p1, KEYS)
    return p1, d12, d23


def _log(spark, sf_dir):
    p1, d12, d23 = _changes(spark, sf_dir)
    first = p1.select(*KEYS, F.lit("ADD").alias("change_type"), F.col("content_hash").alias("new_hash"), "entity_type", F.lit(1).alias("seq"))
    rest = [V.log_rows(d, s).select(*KEYS, "change_type", "new_hash", "entity_type", "seq") for d, s in ((d12, 2), (d23, 3))]
    return reduce(lambda a, b: a.unionByName(b), rest, first)


@query("f01_diff_preview", WITH + " SELECT count(*) FILTER (change_type = 'ADD') AS added, count(*) FILTER (change_type = 'REMOVE') AS removed, count(*) FILTER (change_type = 'CHANGE') AS changed, count(*) FILTER (change_type = 'SAME') AS unchanged, count(*) FILTER (change_type <> 'ADD') AS previous FROM d12")
def f01(spark, sf_dir):
    return V.preview(_changes(spark, sf_dir)[1])


@query("f02_diff_classes", WITH + " SELECT source_id, entity_type, change_type, count(*) AS n FROM d12 GROUP BY ALL")
def f02(spark, sf_dir):
    return _changes(spark, sf_dir)[1].groupBy("source_id", "entity_type", "change_type").agg(F.count("*").alias("n"))


@query("f03_relisted", WITH + " SELECT source_id, source_key, change_type FROM d23 WHERE change_type <> 'SAME'")
def f03(spark, sf_dir):
    return _changes(spark, sf_dir)[2].where("change_type <> 'SAME'").select(*KEYS, "change_type")


@query("f04_validity", LOG + " SELECT source_id, source_key, change_type, seq AS valid_from_seq, valid_to AS valid_to_seq, sha256(concat_ws('|', source_id, source_key, seq)) AS record_version_id FROM v")
def f04(spark, sf_dir):
    v = V.validity(_log(spark, sf_dir), KEYS)
    return v.select(*KEYS, "change_type", "valid_from_seq", "valid_to_seq", V.version_id(*KEYS, "valid_from_seq").alias("record_version_id"))


def _published(spark, sf_dir):
    """Three versions published one after the other into a folder of their own."""
    store = PB.ListStore(spark, new_path(spark, "lists"), KEYS)
    for seq, rows in enumerate(_versions(spark, sf_dir), 1):
        store.publish(seq, rows)
    return store


@query("f04_published_versions", LOG + " SELECT source_id, source_key, h AS content_hash, CAST(seq AS BIGINT) AS valid_from_seq, CAST(valid_to AS BIGINT) AS valid_to_seq FROM v")
def f04_published(spark, sf_dir):
    return _published(spark, sf_dir).versions().select(*KEYS, "content_hash", "valid_from_seq", "valid_to_seq")


@query("f10_published_changes", LOG + " SELECT source_id, source_key, change_type, CAST(seq AS BIGINT) AS seq FROM log")
def f10_published(spark, sf_dir):
    return _published(spark, sf_dir).changes().select(*KEYS, "change_type", "seq")


@query("f09_published_as_of", LOG + " SELECT source_id, source_key, h AS content_hash, CAST(seq AS BIGINT) AS valid_from_seq FROM v WHERE seq <= 2 AND (valid_to IS NULL OR valid_to > 2)")
def f09_published(spark, sf_dir):
    return _published(spark, sf_dir).as_of(2).select(*KEYS, "content_hash", "valid_from_seq")


_DOCS = "docs AS (SELECT source_id, source_key, list({'rid': rid, 'label': label, 'value': value} ORDER BY rid) AS ids FROM (" + IDENTIFIERS + ") GROUP BY ALL)"


def _docs(spark, sf_dir):
    rows = derived(spark, sf_dir, IDENTIFIERS)
    return rows.groupBy(*KEYS).agg(F.array_sort(F.collect_list(F.struct("rid", "label", "value"))).alias("ids"))


@query("f05_child_rows", f"WITH {_DOCS} SELECT source_id, source_key, (i - 1)::INT AS ord, ids[i].rid AS rid, ids[i].label AS label, ids[i].value AS value FROM (SELECT *, unnest(generate_series(1, len(ids))) AS i FROM docs)")
def f05(spark, sf_dir):
    return V.children(_docs(spark, sf_dir), KEYS, "ids")


_K = "c_custkey"
_CH = f"""SELECT {_K} AS source_key, 'name' AS tab, 0 AS ord, lower(replace(c_name, '#', ' ')) AS what, 'UNKNOWN' AS more FROM customer UNION ALL SELECT {_K}, 'name', 1, lower(c_mktsegment), 'WEAK' FROM customer WHERE {_K} % 3 <> 0
UNION ALL SELECT {_K}, 'identifier', 0, 'N' || {_K}, CASE WHEN {_K} % 2 = 0 THEN 'DE' END FROM customer UNION ALL SELECT {_K}, 'address', 0, 'Street ' || c_nationkey, CASE WHEN {_K} % 5 = 0 THEN 'FR' END FROM customer WHERE {_K} % 4 <> 1
UNION ALL SELECT {_K}, 'birth', 0, 'DOB', 'DAY' FROM customer WHERE {_K} % 2 = 0 UNION ALL SELECT {_K}, 'birth', CASE WHEN {_K} % 2 = 0 THEN 1 ELSE 0 END, 'POB', CASE WHEN {_K} % 6 = 0 THEN 'IR' END FROM customer WHERE {_K} % 3 = 0
UNION ALL SELECT {_K}, 'nationality', 0, 'CITIZENSHIP', NULL FROM customer UNION ALL SELECT {_K}, 'listing', 0, 'A', 'ASSET_FREEZE' FROM customer UNION ALL SELECT {_K}, 'listing', 1, 'B', '' FROM customer WHERE {_K} % 7 = 0
UNION ALL SELECT {_K}, 'relationship', 0, 'OWNED', 'R' || ({_K} + 1) FROM customer WHERE {_K} % 10 = 0 UNION ALL SELECT {_K}, 'vessel', 0, 'tanker', CASE WHEN {_K} % 3 = 0 THEN 'PA' END FROM customer WHERE c_mktsegment = 'MACHINERY' UNION ALL SELECT {_K}, 'aircraft', 0, 'M1', NULL FROM customer WHERE c_mktsegment = 'AUTOMOBILE'"""


@query("f05_child_tables", f"SELECT source_key, tab, ord::INT AS ord, what, more FROM ({_CH})")
def f05_tables(spark, sf_dir):
    from ..sources import canonical as C

    k, lit = F.col("source_key"), F.lit
    rows = derived(spark, sf_dir, "SELECT c_custkey AS source_key, c_name, c_mktsegment, c_nationkey FROM customer")
    some = lambda cond, *xs: F.filter(F.array(*[F.when(cond if i == 0 else c, x) for i, (x, c) in enumerate(xs)]), lambda x: x.isNotNull())
    yes = lit(True)
    name = lambda t, v, q: C.fill(C.NAME, name_type=lit(t), full_name=v, quality=q)
    docs = rows.select(
        k,
        some(yes, (name("PRIMARY", F.replace("c_name", lit("#"), lit("-")), lit(None)), yes), (name("AKA", F.col("c_mktsegment"), lit("WEAK")), k % 3 != 0)).alias("names"),
        some(yes, (C.fill(C.IDENT, id_type=lit("OTHER"), value_norm=F.concat(lit("N"), k), country_iso2=F.when(k % 2 == 0, "DE").otherwise("DEU")), yes)).alias("identifiers"),
        some(k % 4 != 1, (C.fill(C.ADDRESS, street=F.concat(lit("Street "), "c_nationkey"), country_iso2=F.when(k % 5 == 0, "FR").otherwise("")), yes)).alias("addresses"),
        some(k % 2 == 0, (F.struct(F.to_date(lit("1970-01-02")).alias("date_value"), lit("DAY").alias("precision")), yes)).alias("birth_dates"),
        some(k % 3 == 0, (C.fill(C.PLACE, place=lit("Town"), country_iso2=F.when(k % 2 == 0, "IR").otherwise("X")), yes)).alias("birth_places"),
        some(yes, (C.fill(C.COUNTRY, kind=lit("CITIZENSHIP"), country_iso2=lit("FRA")), yes)).alias("countries"),
        some(yes, (C.fill(C.LISTING, program_code=lit("A"), measures=F.array(lit("ASSET_FREEZE"))), yes), (C.fill(C.LISTING, program_code=lit("B"), measures=F.array()), k % 7 == 0)).alias("listings"),
        some(k % 10 == 0, (C.fill(C.RELATION, rel_type=lit("OWNED"), target_source_key=F.concat(lit("R"), k + 1)), yes)).alias("relationships"),
        F.when(F.col("c_mktsegment") == "MACHINERY", C.fill(C.VESSEL, vessel_type=lit("tanker"), flag_iso2=F.when(k % 3 == 0, "PA").otherwise("PAN"))).alias("vessel"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", C.fill(C.AIRCRAFT, model=lit("M1"))).alias("aircraft"),
    )
    shown = {
        "name": ("normalized_name", "quality"), "identifier": ("value_norm", "country_iso2"), "address": ("street", "country_iso2"), "birth": ("kind", F.coalesce("precision", "country_iso2")), "nationality": ("kind", "country_iso2"),
        "listing": ("program_code", F.array_join("measures", ",")), "relationship": ("rel_type", "target_source_key"), "vessel": ("vessel_type", "flag_iso2"), "aircraft": ("model", "manufacturer"),
    }
    tables = V.child_tables(docs, ["source_key"])
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return reduce(lambda a, b: a.union(b), [tables[t].select("source_key", F.lit(t).alias("tab"), "ord", col(w).alias("what"), col(m).alias("more")) for t, (w, m) in shown.items()])


@query(
    "f06_field_diff",
    WITH + """ SELECT n.source_id, n.source_key, array_to_string(list_filter([CASE WHEN o.entity_type IS DISTINCT FROM n.entity_type THEN 'entity_type' END,
      CASE WHEN o.primary_name IS DISTINCT FROM n.primary_name THEN 'primary_name' END, CASE WHEN o.country IS DISTINCT FROM n.country THEN 'country' END,
      CASE WHEN o.amount IS DISTINCT FROM n.amount THEN 'amount' END], lambda x: x IS NOT NULL), ',') AS changed, o.amount AS gone, n.amount AS came
      FROM p1 o JOIN p2 n USING (source_id, source_key) WHERE o.h <> n.h""",
)
def f06(spark, sf_dir):
    p1, p2, _ = (d.withColumn("amounts", F.array("amount")) for d in _versions(spark, sf_dir))
    out = V.field_diff(p1, p2, KEYS, FIELDS[:3], ["amounts"])
    return out.select(*KEYS, F.replace(F.array_join("changed_fields", ","), F.lit("amounts"), F.lit("amount")).alias("changed"), F.array_join("amounts_removed", ",").alias("gone"), F.array_join("amounts_added", ",").alias("came"))


@query("f07_change_summary", LOG + " SELECT seq, count(*) FILTER (change_type = 'ADD') AS added, count(*) FILTER (change_type = 'CHANGE') AS changed, count(*) FILTER (change_type = 'REMOVE') AS removed, count(*) FILTER (change_type = 'RELIST') AS relisted FROM log GROUP BY seq")
def f07(spark, sf_dir):
    n = lambda k: F.count_if(F.col("change_type") == k)
    return _log(spark, sf_dir).groupBy("seq").agg(n("ADD").alias("added"), n("CHANGE").alias("changed"), n("REMOVE").alias("removed"), n("RELIST").alias("relisted"))


CANDS = "SELECT o_orderkey AS candidate_id, 'L' || CAST(o_custkey % 3 AS VARCHAR(9)) AS source_id, o_custkey AS source_key, CASE WHEN o_orderkey % 5 = 0 THEN 'PENDING' WHEN o_orderkey % 5 = 1 THEN 'EVIDENCE_FOUND' WHEN o_orderkey % 5 = 2 THEN 'REJECTED_PARSER' WHEN o_orderkey % 5 = 3 THEN 'CONFIRMED' ELSE 'RELISTED' END AS status, o_orderdate AS created_at FROM orders"
VERS = "SELECT o_orderkey AS version_id, 'S' || CAST(o_custkey % 40 AS VARCHAR(9)) AS source_id, CAST(o_orderkey % 100000 AS INT) AS seq, CASE o_orderstatus WHEN 'O' THEN 'PUBLISHED' WHEN 'F' THEN 'HELD' ELSE 'QUARANTINED' END AS status, CAST(floor(o_totalprice) AS BIGINT) AS record_count, o_orderdate AS created_at FROM orders"


@query(
    "f08_snapshot",
    f"WITH c AS ({CANDS}), v AS ({VERS}), p AS (SELECT source_id, max(seq) AS seq FROM v WHERE status = 'PUBLISHED' GROUP BY 1), h AS (SELECT candidate_id FROM c WHERE status IN ('PENDING','EVIDENCE_FOUND','REJECTED_PARSER')) "
    "SELECT (SELECT string_agg(source_id || ':' || seq, ',' ORDER BY source_id) FROM p) AS pins, (SELECT count(*) FROM h) AS n_held, (SELECT sha256(string_agg(candidate_id::VARCHAR, ',' ORDER BY candidate_id)) FROM h) AS held_sha",
)
def f08(spark, sf_dir):
    s = V.snapshot(derived(spark, sf_dir, VERS), derived(spark, sf_dir, CANDS))
    pins = F.array_join(F.transform("pins", lambda p: F.concat_ws(":", p["source_id"], p["seq"])), ",")
    return s.select(pins.alias("pins"), F.size("held_removal_ids").cast("long").alias("n_held"), F.sha2(F.array_join(F.col("held_removal_ids").cast("array<string>"), ","), 256).alias("held_sha"))


@query(
    "f09_as_of",
    LOG + """, pins AS (SELECT 'L0' AS source_id, 1 AS pin UNION ALL SELECT 'L1', 2 UNION ALL SELECT 'L2', 3), held AS (SELECT DISTINCT source_id, source_key FROM d12 WHERE change_type = 'REMOVE' AND source_key % 20 = 7)
    SELECT source_id, source_key, seq AS valid_from_seq, false AS held FROM v JOIN pins USING (source_id) WHERE seq <= pin AND (valid_to IS NULL OR valid_to > pin)
    UNION ALL SELECT source_id, source_key, max(seq), true FROM v SEMI JOIN held USING (source_id, source_key) GROUP BY 1, 2""",
)
def f09(spark, sf_dir):
    v = V.validity(_log(spark, sf_dir), KEYS)
    pins = spark.createDataFrame([("L0", 1), ("L1", 2), ("L2", 3)], "source_id string, pin int")
    held = _changes(spark, sf_dir)[1].where("change_type = 'REMOVE' AND source_key % 20 = 7")
    return V.as_of_with_holds(v, F.broadcast(pins), held, KEYS).select(*KEYS, "valid_from_seq", "held")


@query(
    "f10_version_states",
    f"WITH v AS ({VERS}), t AS (SELECT *, max(CASE WHEN status = 'PUBLISHED' THEN seq END) OVER (PARTITION BY source_id) AS top FROM v) SELECT version_id, source_id, seq, CASE WHEN status IN ('PUBLISHED','HELD') AND seq < top THEN 'SUPERSEDED' ELSE status END AS status FROM t",
)
def f10(spark, sf_dir):
    return V.supersede(derived(spark, sf_dir, VERS)).select("version_id", "source_id", "seq", "status")


@query(
    "f11_removal_candidates",
    WITH + f", c AS ({CANDS}), op AS (SELECT DISTINCT source_id, source_key FROM c WHERE status = 'PENDING') SELECT source_id, source_key, 'PENDING' AS status FROM d12 ANTI JOIN op USING (source_id, source_key) WHERE change_type = 'REMOVE' UNION ALL SELECT source_id, source_key, 'RELISTED' FROM op SEMI JOIN (SELECT * FROM d12 WHERE change_type = 'ADD') a USING (source_id, source_key)",
)
def f11(spark, sf_dir):
    d12 = _changes(spark, sf_dir)[1]
    opened = derived(spark, sf_dir, CANDS).where("status = 'PENDING'").select(*KEYS).distinct()
    new = V.open_removals(d12, opened, KEYS).withColumn("status", F.lit("PENDING"))
    return new.unionByName(V.close_relisted(opened, d12, KEYS))


@query(
    "f12_release_held",
    WITH + " SELECT (SELECT count(*) FROM p3) AS staged, count(*) FILTER (change_type IN ('ADD','CHANGE','SAME','RELIST')) AS seen, count(*) FILTER (change_type = 'RELIST') AS relisted, count(*) FILTER (change_type = 'REMOVE') AS removed FROM d23",
)
def f12(spark, sf_dir):
    _, p2, p3 = _versions(spark, sf_dir)
    return R.release_held(p2, p3, _versions(spark, sf_dir)[0], KEYS)


_IDS = f"ids AS (SELECT *, upper(regexp_replace(trim(value), '[\\s\\-./]', '', 'g')) AS norm FROM ({IDENTIFIERS}) WHERE trim(value) <> '')"
_STRONG = _IDS + ", keys AS (SELECT DISTINCT source_id, source_key, CASE label WHEN 'Passport' THEN 'PASSPORT' WHEN 'MMSI' THEN 'MMSI' END AS key_type, norm || '|' AS key_value FROM ids WHERE label IN ('Passport', 'MMSI'))"


def _ids(spark, sf_dir):
    """Identifiers of the records, as the table that a publish stores: typed and normalised once, read by several steps."""
    from ..functions import text as T

    return durable(R.identifier_rows(derived(spark, sf_dir, IDENTIFIERS), "label", "value").where(T.clean(F.col("value")).isNotNull()).select(*KEYS, "id_type", "value_norm", "checksum_valid"), "identifiers")


def _strong(spark, sf_dir, ids=None):
    ids = ids if ids is not None else _ids(spark, sf_dir)
    return R.crosslist_keys(ids, KEYS, plain=(), checked=("IMO",), with_country=("PASSPORT", "MMSI")).where("key_type <> 'IMO'")


@query("f14_crosslist_keys", f"WITH {_STRONG} SELECT * FROM keys")
def f14(spark, sf_dir):
    return _strong(spark, sf_dir)


@query(
    "f15_crosslist_hits",
    f"WITH {_STRONG}, c AS (SELECT DISTINCT source_id, source_key FROM ({CANDS}) WHERE status = 'PENDING') SELECT c.source_id, c.source_key, count(DISTINCT k2.source_id || '/' || k2.source_key) AS n_hits FROM c JOIN keys k1 ON k1.source_id = c.source_id AND k1.source_key = c.source_key JOIN keys k2 ON k1.key_type = k2.key_type AND k1.key_value = k2.key_value AND (k2.source_id <> c.source_id OR k2.source_key <> c.source_key) GROUP BY 1, 2",
)
def f15(spark, sf_dir):
    cands = derived(spark, sf_dir, CANDS).where("status = 'PENDING'").select(*KEYS).distinct()
    return R.crosslist_hits(cands, _strong(spark, sf_dir), KEYS)


@query(
    "f16_id_change_suspects",
    f"""WITH {_IDS}, c AS (SELECT DISTINCT source_id, source_key FROM ({CANDS}) WHERE status = 'PENDING'), s AS (SELECT * FROM ids WHERE label IN ('IMO number','Passport','MMSI')),
    m AS (SELECT DISTINCT source_id, source_key, 'SHARED_IDENTIFIER' AS reason, CASE label WHEN 'IMO number' THEN 'IMO' ELSE upper(label) END || ':' || norm AS mark FROM s UNION ALL SELECT 'L' || (c_custkey % 3), c_custkey, 'SAME_NAME', c_nationkey || '/' || c_mktsegment FROM customer)
    SELECT source_id, source_key, reason, mark AS value, candidate, first_key, n_others FROM (SELECT m.*, c.source_key IS NOT NULL AS candidate, min(m.source_key) OVER w AS first_key, count(*) OVER w - 1 AS n_others, bool_or(c.source_key IS NOT NULL) OVER w AS asked FROM m LEFT JOIN c ON c.source_id = m.source_id AND c.source_key = m.source_key WINDOW w AS (PARTITION BY m.source_id, m.reason, m.mark)) WHERE n_others > 0 AND asked""",
)
def f16(spark, sf_dir):
    cands = derived(spark, sf_dir, CANDS).where("status = 'PENDING'").select(*KEYS).distinct()
    names = derived(spark, sf_dir, "SELECT 'L' || (c_custkey % 3) AS source_id, c_custkey AS source_key, concat(c_nationkey, '/', c_mktsegment) AS name_norm FROM customer")
    return R.id_change_suspects(cands, _ids(spark, sf_dir), names)


LINKS = "SELECT l_orderkey * 10 + l_linenumber AS link_id, 'L' || CAST(l_suppkey % 3 AS VARCHAR(9)) AS source_id, l_partkey AS source_key, CASE l_returnflag WHEN 'R' THEN 'DELISTING' WHEN 'A' THEN 'LISTING' ELSE 'AMENDMENT' END AS link_type, CASE l_linestatus WHEN 'F' THEN 'AUTO' ELSE 'REJECTED' END AS status, CAST(CAST(l_quantity AS INT) % 10 AS DOUBLE) / 10 AS confidence, CAST(l_shipdate AS DATE) AS published_on FROM lineitem"
_EV = f"""c AS ({CANDS}), l AS ({LINKS}), ev AS (SELECT c.candidate_id, l.link_id, l.confidence, l.published_on, row_number() OVER (PARTITION BY c.candidate_id ORDER BY l.confidence DESC, l.published_on DESC, l.link_id) AS r, count(*) OVER (PARTITION BY c.candidate_id) AS n
  FROM c JOIN l ON l.source_id = c.source_id AND l.source_key = c.source_key AND l.link_type = 'DELISTING' AND l.status <> 'REJECTED' AND (l.published_on IS NULL OR l.published_on >= CAST(c.created_at AS DATE) - INTERVAL 60 DAY))"""


def _evidence(spark, sf_dir):
    return R.delisting_evidence(derived(spark, sf_dir, CANDS), derived(spark, sf_dir, LINKS))


@query("f17_delisting_evidence", f"WITH {_EV} SELECT candidate_id, link_id, confidence, n AS n_evidence FROM ev WHERE r = 1")
def f17(spark, sf_dir):
    return _evidence(spark, sf_dir)


_REASONS = f"""s AS (SELECT * FROM ids WHERE label IN ('IMO number','Passport','MMSI')),
n AS (SELECT 'L' || (c_custkey % 3) AS source_id, c_custkey AS source_key, c_nationkey || '/' || c_mktsegment AS nm FROM customer),
mk AS (SELECT source_id, source_key, 1 AS p, label || '|' || norm AS mark FROM s UNION SELECT source_id, source_key, 2, nm FROM n),
sus AS (SELECT source_id, source_key, CASE min(p) WHEN 1 THEN 'SHARED_IDENTIFIER' ELSE 'SAME_NAME' END AS reason, arg_min(o, p * 1000000000 + o) AS other_key FROM (
  SELECT a.source_id, a.source_key, a.p, min(b.source_key) AS o FROM mk a JOIN mk b ON a.source_id = b.source_id AND a.p = b.p AND a.mark = b.mark AND a.source_key <> b.source_key GROUP BY 1, 2, 3) SEMI JOIN c USING (source_id, source_key) GROUP BY 1, 2)"""


def _reasons(spark, sf_dir, ids=None):
    names = derived(spark, sf_dir, "SELECT 'L' || (c_custkey % 3) AS source_id, c_custkey AS source_key, concat(c_nationkey, '/', c_mktsegment) AS name_norm FROM customer")
    return R.id_change_reasons(derived(spark, sf_dir, CANDS), ids if ids is not None else _ids(spark, sf_dir), names)


@query("f16_id_change_reasons", f"WITH {_IDS}, c AS ({CANDS}), {_REASONS} SELECT * FROM sus")
def f16_reasons(spark, sf_dir):
    return _reasons(spark, sf_dir)


_ASSESS = f"""WITH {_EV}, {_STRONG}, {_REASONS}, kl AS (SELECT key_type, key_value, source_id AS other, count(*) AS n FROM keys GROUP BY ALL),
els AS (SELECT source_id, source_key, list_sort(list(DISTINCT other)) AS sources FROM (SELECT DISTINCT source_id, source_key FROM c) JOIN keys USING (source_id, source_key) JOIN kl USING (key_type, key_value) WHERE other <> source_id OR n > 1 GROUP BY 1, 2),
a AS (SELECT c.candidate_id, c.status, c.source_id, c.source_key, ev.candidate_id IS NOT NULL AS has_evidence, els.sources, s.source_key IS NOT NULL AS suspect, c.status IN ('PENDING', 'EVIDENCE_FOUND', 'REJECTED_PARSER') AS holds
  FROM c LEFT JOIN (SELECT * FROM ev WHERE r = 1) ev USING (candidate_id) LEFT JOIN els ON els.source_id = c.source_id AND els.source_key = c.source_key LEFT JOIN sus s ON s.source_id = c.source_id AND s.source_key = c.source_key),
ad AS (SELECT *, CASE WHEN holds THEN CASE WHEN suspect AND NOT has_evidence THEN 'REJECTED_ID_CHANGE' WHEN has_evidence AND sources IS NOT NULL THEN 'STILL_LISTED_ELSEWHERE' WHEN has_evidence THEN 'CONFIRMED' END END AS recommendation FROM a)"""


def _assessed(spark, sf_dir):
    cands = derived(spark, sf_dir, CANDS)
    ids = _ids(spark, sf_dir)
    elsewhere = R.listed_elsewhere(cands, _strong(spark, sf_dir, ids))
    return R.assess(cands, _evidence(spark, sf_dir), elsewhere, _reasons(spark, sf_dir, ids)), elsewhere


@query("f18_removal_assessment", _ASSESS + " SELECT candidate_id, CASE WHEN has_evidence AND holds THEN 'EVIDENCE_FOUND' ELSE status END AS status, recommendation FROM ad")
def f18(spark, sf_dir):
    return _assessed(spark, sf_dir)[0].select("candidate_id", "status", "recommendation")


@query(
    "f18_removal_proposals",
    _ASSESS + """ SELECT candidate_id, source_id || ':' || source_key AS subject_ref, 'removal:' || candidate_id AS dedupe_key, CASE recommendation WHEN 'CONFIRMED' THEN 'Confirm delisting of ' || c_name || ' from ' || source_id
      WHEN 'STILL_LISTED_ELSEWHERE' THEN 'Release the listing of ' || c_name || ' on ' || source_id || ', still listed on ' || array_to_string(sources, ', ') ELSE 'Confirm the change of key of ' || c_name || ' on ' || source_id END AS title
      FROM ad JOIN customer ON c_custkey = source_key WHERE recommendation IS NOT NULL AND candidate_id % 11 <> 0""",
)
def f18_proposals(spark, sf_dir):
    assessed, elsewhere = _assessed(spark, sf_dir)
    named = assessed.join(derived(spark, sf_dir, "SELECT c_custkey AS source_key, c_name AS primary_name FROM customer"), "source_key")
    opened = assessed.where("candidate_id % 11 = 0").select(F.concat(F.lit("removal:"), "candidate_id").alias("dedupe_key"))
    return R.removal_proposals(named, elsewhere, opened).select("candidate_id", "subject_ref", "dedupe_key", "title")


@query(
    "c05_as_of_predicate",
    LOG + ", pins AS (SELECT 'L' || k AS source_id, (SELECT (count(*) % 3)::INT FROM orders WHERE o_custkey % 3 = k) + 1 AS pin FROM range(3) t(k)) SELECT source_id, source_key, seq AS valid_from_seq, valid_to AS valid_to_seq FROM v JOIN pins USING (source_id) WHERE seq <= pin AND (valid_to IS NULL OR valid_to > pin)",
)
def c05(spark, sf_dir):
    pins = derived(spark, sf_dir, "SELECT 'L' || CAST(o_custkey % 3 AS VARCHAR(9)) AS source_id, CAST(count(*) % 3 AS INT) + 1 AS pin FROM orders GROUP BY o_custkey % 3")
    return V.as_of(V.validity(_log(spark, sf_dir), KEYS), pins).select(*KEYS, "valid_from_seq", "valid_to_seq")


DECISIONS = "SELECT o_orderkey AS decision_id, o_orderkey - o_orderkey % 2 AS candidate_id, CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' WHEN 'O' THEN 'STILL_LISTED' ELSE 'REJECTED_PARSER' END AS resolution FROM orders WHERE o_orderkey % 3 <> 0"


@query(
    "f19_removal_resolution",
    f"WITH c AS ({CANDS}), d AS (SELECT candidate_id, arg_max(resolution, decision_id) AS resolution FROM ({DECISIONS}) GROUP BY 1), r AS (SELECT c.candidate_id, coalesce(d.resolution, c.status) AS status FROM c LEFT JOIN d USING (candidate_id)) SELECT status, status IN ('PENDING','EVIDENCE_FOUND','REJECTED_PARSER') AS held, count(*) AS n FROM r GROUP BY ALL",
)
def f19(spark, sf_dir):
    out = R.resolve(derived(spark, sf_dir, CANDS), derived(spark, sf_dir, DECISIONS))
    return out.groupBy("status", "held").agg(F.count("*").alias("n"))


ANNEX = "SELECT o_orderkey AS change_id, 'K' || CAST(o_custkey % 200 AS VARCHAR(9)) AS entry_key, CASE o_orderstatus WHEN 'F' THEN 'REMOVE' WHEN 'O' THEN 'ADD' ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'REPLACE' ELSE 'LEAD' END END AS op, CAST(o_orderkey % 7 AS VARCHAR(9)) AS name FROM orders"


@query("f20_curated_apply", f"SELECT entry_key, arg_max(name, change_id) AS name FROM ({ANNEX}) WHERE op <> 'LEAD' GROUP BY 1 HAVING arg_max(op, change_id) <> 'REMOVE'")
def f20(spark, sf_dir):
    return R.apply_curated(derived(spark, sf_dir, ANNEX)).select("entry_key", "name")


@query(
    "f21_lead_comparison",
    """WITH page AS (SELECT lpad(CAST(o_orderkey * 7919 % 10000000 AS VARCHAR), 7, '0') AS imo FROM orders WHERE o_orderkey % 2 = 0), ours AS (SELECT lpad(CAST(o_orderkey * 7919 % 10000000 AS VARCHAR), 7, '0') AS imo FROM orders WHERE o_orderkey % 3 = 0),
    ok AS (SELECT DISTINCT imo FROM page WHERE (7*substr(imo,1,1)::INT+6*substr(imo,2,1)::INT+5*substr(imo,3,1)::INT+4*substr(imo,4,1)::INT+3*substr(imo,5,1)::INT+2*substr(imo,6,1)::INT)%10 = substr(imo,7,1)::INT)
    SELECT imo, 'missing' AS side FROM ok WHERE imo NOT IN (SELECT imo FROM ours) UNION ALL SELECT DISTINCT imo, 'extra' FROM ours WHERE imo NOT IN (SELECT imo FROM ok)""",
)
def f21(spark, sf_dir):
    page = derived(spark, sf_dir, "SELECT concat('vessel IMO ', lpad(CAST(o_orderkey * 7919 % 10000000 AS STRING), 7, '0'), ' seen') AS text FROM orders WHERE o_orderkey % 2 = 0")
    ours = derived(spark, sf_dir, "SELECT lpad(CAST(o_orderkey * 7919 % 10000000 AS STRING), 7, '0') AS imo FROM orders WHERE o_orderkey % 3 = 0")
    return R.lead_comparison(page, "text", ours, "imo")


PROPS = "SELECT o_orderkey AS change_id, 'user' || CAST(o_custkey % 7 AS VARCHAR(9)) AS maker, 'K' || CAST(CAST(floor(o_orderkey / 2) AS BIGINT) AS VARCHAR(12)) AS dedupe_key, CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'F' THEN 'APPROVED' ELSE 'REJECTED' END AS status, CASE WHEN o_orderkey % 3 = 0 THEN 'RELEASE_HELD' WHEN o_orderkey % 3 = 1 THEN 'REMOVAL' ELSE 'ANNEX' END AS kind FROM orders"
DECS = "SELECT l_orderkey AS change_id, l_linenumber AS decision_no, 'user' || CAST(l_suppkey % 7 AS VARCHAR(9)) AS checker, CASE l_linestatus WHEN 'O' THEN 'APPROVED' ELSE 'REJECTED' END AS decision FROM lineitem"


@query(
    "f23_review_decisions",
    f"WITH p AS ({PROPS}), d AS ({DECS}), f AS (SELECT d.*, row_number() OVER (PARTITION BY d.change_id ORDER BY d.decision_no, d.checker, d.decision) AS r, p.kind FROM d JOIN p USING (change_id) WHERE p.status = 'PENDING' AND p.maker <> d.checker) SELECT change_id, kind, checker, decision AS status, CASE WHEN decision = 'APPROVED' THEN CASE kind WHEN 'RELEASE_HELD' THEN 'PUBLISH' WHEN 'REMOVAL' THEN 'RESOLVE' ELSE 'APPLY' END END AS effect FROM f WHERE r = 1",
)
def f23(spark, sf_dir):
    effects = {"RELEASE_HELD": "PUBLISH", "REMOVAL": "RESOLVE", "ANNEX": "APPLY"}
    return R.decide(derived(spark, sf_dir, PROPS), derived(spark, sf_dir, DECS), effects)


@query(
    "f24_proposal_dedupe",
    f"WITH p AS ({PROPS}), o AS (SELECT DISTINCT dedupe_key FROM p WHERE status = 'PENDING' AND change_id % 2 = 0), n AS (SELECT *, row_number() OVER (PARTITION BY dedupe_key ORDER BY change_id) AS r FROM p WHERE change_id % 2 = 1) SELECT change_id, dedupe_key FROM n ANTI JOIN o USING (dedupe_key) WHERE r = 1",
)
def f24(spark, sf_dir):
    p = derived(spark, sf_dir, PROPS)
    return R.new_proposals(p.where("change_id % 2 = 1"), p.where("status = 'PENDING' AND change_id % 2 = 0")).select("change_id", "dedupe_key")


@query("f25_audit_rows", WITH + " SELECT coalesce(o.source_key, n.source_key) AS source_key, CASE WHEN o.source_key IS NULL THEN 'INSERT' WHEN n.source_key IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS op, 'publisher' AS actor, o.amount AS old_amount, n.amount AS new_amount FROM p1 o FULL JOIN p2 n ON o.source_key = n.source_key WHERE o.h IS DISTINCT FROM n.h")
def f25(spark, sf_dir):
    p1, p2, _ = _versions(spark, sf_dir)
    out = V.audit(p1, p2, "source_key", FIELDS, "publisher")
    return out.select("source_key", "op", "actor", F.get_json_object("old_row", "$.amount").alias("old_amount"), F.get_json_object("new_row", "$.amount").alias("new_amount"))


@query(
    "b25_config_diff",
    "WITH c AS (SELECT o_custkey AS config_id, o_orderstatus AS path, CAST(o_orderkey % 3 AS INT) AS version, max(o_orderpriority) AS value FROM orders GROUP BY ALL), b AS (SELECT config_id, version + 1 AS version, path, value AS old_value FROM c), f AS (SELECT config_id, min(version) AS lo, max(version) AS hi FROM c GROUP BY 1) "
    "SELECT config_id, version, 'auth.' || path AS path, old_value, value AS new_value, path = 'F' AS sensitive FROM (SELECT * FROM c FULL JOIN b USING (config_id, version, path)) JOIN f USING (config_id) WHERE version > lo AND version <= hi AND value IS DISTINCT FROM old_value",
)
def b25(spark, sf_dir):
    c = derived(spark, sf_dir, "SELECT o_custkey AS config_id, concat('auth.', o_orderstatus) AS path, CAST(o_orderkey % 3 AS INT) AS version, max(o_orderpriority) AS value FROM orders GROUP BY ALL")
    return V.json_paths(c, ["config_id"], "path", "value", "version", ["F"])


#: Two versions of nested settings of each customer.
_CONF = """SELECT c_custkey AS id, '{"fetch": {"url": "https://host/' || CAST({n} AS VARCHAR(9)) || '", "retry": {"times": ' || CAST({t} AS VARCHAR(9)) || ', "wait": [1, 2]}}, ' || CASE WHEN {m} = 0 THEN '"limits": {"added": 5}' WHEN {m} = 1 THEN '"limits": 7' ELSE '"note": null' END || ', "name": "x"}' AS doc FROM customer"""
_CONF1 = _CONF.replace("{n}", "c_nationkey").replace("{t}", "c_custkey % 5").replace("{m}", "c_custkey % 3")
_CONF2 = _CONF.replace("{n}", "(c_nationkey + CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END)").replace("{t}", "c_custkey % 7").replace("{m}", "c_custkey % 2")


def _nodes(name: str, sql: str) -> str:
    """SQL of the nodes of a document that are reached through objects: path, whether an object, JSON text (null for objects and JSON's null)."""
    return f"{name} AS (SELECT d.id AS id, substr(fullkey, 3) AS path, type = 'OBJECT' AS obj, CASE WHEN type NOT IN ('OBJECT', 'NULL') THEN CAST(value AS VARCHAR) END AS value FROM ({sql}) d, json_tree(doc) WHERE fullkey NOT LIKE '%[%')"


@query(
    "b25_nested_diff",
    f"WITH {_nodes('o', _CONF1)}, {_nodes('n', _CONF2)}, b AS (SELECT coalesce(o.id, n.id) AS id, coalesce(o.path, n.path) AS path, coalesce(o.obj, false) AS oo, coalesce(n.obj, false) AS nn, o.value AS ov, n.value AS nv FROM o FULL JOIN n ON o.id = n.id AND o.path = n.path) "
    r"SELECT c.id, c.path, c.ov AS old_value, c.nv AS new_value, list_has_any(string_split(c.path, '.'), ['url', 'base_url']) AS sensitive FROM b c JOIN b p ON p.id = c.id AND p.oo AND p.nn AND p.path = CASE WHEN contains(c.path, '.') THEN regexp_replace(c.path, '\.[^.]*$', '') ELSE '' END WHERE c.path <> '' AND NOT (c.oo AND c.nn) AND (c.oo <> c.nn OR c.ov IS DISTINCT FROM c.nv)",
)
def b25_nested(spark, sf_dir):
    return J.diff_paths(derived(spark, sf_dir, _CONF1), derived(spark, sf_dir, _CONF2), ["id"], "doc", ["url", "base_url"])


def _trees(spark, sf_dir):
    out = []
    for rows in _versions(spark, sf_dir)[:2]:
        out.append(new_path(spark, "version"))
        M.write(rows, out[-1], KEYS)
    return [M.Version(spark, p) for p in out]


@query("f02_tree_diff", WITH + " SELECT source_id, source_key, change_type, old_hash, new_hash FROM d12 WHERE change_type <> 'SAME'")
def f02_tree(spark, sf_dir):
    return M.changes(*_trees(spark, sf_dir), KEYS).select(*KEYS, "change_type", "old_hash", "new_hash")


@query("f01_tree_preview", WITH + " SELECT count(*) FILTER (change_type = 'ADD') AS added, count(*) FILTER (change_type = 'REMOVE') AS removed, count(*) FILTER (change_type = 'CHANGE') AS changed, count(*) FILTER (change_type = 'SAME') AS unchanged, count(*) FILTER (change_type <> 'ADD') AS previous FROM d12")
def f01_tree(spark, sf_dir):
    return M.preview(*_trees(spark, sf_dir), KEYS)


#: Versions of orders with validity, some of them open, and the sequence that each of many snapshots pins for each source.
_VALID = "SELECT 'S' || CAST(o_custkey % 5 AS VARCHAR(9)) AS source_id, o_orderkey AS source_key, o_orderkey % 1000 AS valid_from_seq, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 1000 + 1 + o_custkey % 300 END AS valid_to_seq FROM orders"
_PINS = "SELECT n_nationkey AS snapshot_id, 'S' || CAST(k AS VARCHAR(9)) AS source_id, n_nationkey * 40 + k AS pin FROM nation, (SELECT DISTINCT n_nationkey % 5 AS k FROM nation) AS ks"


@query("f09_many_snapshots", f"SELECT snapshot_id, v.source_id, source_key FROM ({_VALID}) v JOIN ({_PINS}) p ON v.source_id = p.source_id AND valid_from_seq <= pin AND (valid_to_seq IS NULL OR pin < valid_to_seq)")
def f09_many(spark, sf_dir):
    return IV.as_of_many(derived(spark, sf_dir, _VALID), derived(spark, sf_dir, _PINS)).select("snapshot_id", "source_id", "source_key")


def _mart(spark, sf_dir, dims, rows):
    """A mart kept up with three publishes, of which the second was held at first and then released."""
    mart = KM.KeptMart(spark, new_path(spark, "mart"), dims)
    log = durable(_log(spark, sf_dir), "log")
    for seq in (1, 2, 3):
        mart.apply(seq, rows(log.where(F.col("seq") == seq).withColumn("status", F.lit("HELD" if seq == 2 else "PUBLISHED"))))
    return mart, log


@query("k08_kept_change_volume", LOG + " SELECT source_id, CAST(seq AS INT) AS seq, 'PUBLISHED' AS status, change_type, entity_type, count(*) AS n FROM log GROUP BY ALL")
def k08_kept(spark, sf_dir):
    mart, log = _mart(spark, sf_dir, "source_id string, seq int, status string, change_type string, entity_type string", lambda df: KM.change_rows(df, ["source_id", "seq", "status", "change_type", "entity_type"]))
    held = KM.change_rows(log.where("seq = 2").withColumn("status", F.lit("HELD")), mart.dims)
    mart.apply(4, KM.released(held, F.lit("HELD"), F.lit("PUBLISHED")))
    mart.compact()
    return mart.read()


@query("k05_kept_counts", f"WITH {P} SELECT source_id, seq, entity_type, count(*) AS n FROM (SELECT *, 1 AS seq FROM p1 UNION ALL SELECT *, 2 FROM p2 UNION ALL SELECT *, 3 FROM p3) GROUP BY ALL")
def k05_kept(spark, sf_dir):
    old = F.when(~F.col("change_type").isin("ADD", "RELIST"), F.col("entity_type"))
    new = F.when(F.col("change_type") != "REMOVE", F.col("entity_type"))
    mart, _ = _mart(spark, sf_dir, "source_id string, seq int, entity_type string", lambda df: KM.count_rows(df.withColumns({"old": old, "new": new}), ["source_id", "seq"], "old", "new"))
    return KM.running_counts(mart.read(), ["source_id", "entity_type"], "seq").select("source_id", "seq", "entity_type", "n")
