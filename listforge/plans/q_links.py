"""Registered queries: notices, enrichment, monitoring (sections G, H, L)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import text as T
from ..operators import enrich as E
from ..operators import fuzzy as FZ
from ..operators import monitor as MO
from ..operators import notices as G
from ..operators import removals as R
from ..operators import retention as RT
from ..session import new_path
from .derive import FETCHES, RUNS, derived
from .q_versioning import CANDS, LINKS
from .registry import query

NOTICES = """SELECT doc_id AS notice_id, source AS title, text || CASE doc_id % 6 WHEN 0 THEN ' entry TAi.' || lpad(CAST(doc_id % 50 AS VARCHAR(9)), 3, '0') || ' was removed.' WHEN 1 THEN ' Designation of CDe.' || lpad(CAST(doc_id % 70 AS VARCHAR(9)), 3, '0') ELSE '' END AS text FROM documents"""
NKEYS = "SELECT 'UN_REF' AS key_type, CASE WHEN c_custkey % 2 = 0 THEN 'TAI' ELSE 'CDE' END || lpad(CAST(c_custkey % 1000 AS VARCHAR(9)), 3, '0') AS key_value, 'L' || CAST(c_custkey % 3 AS VARCHAR(9)) AS source_id, c_custkey AS source_key FROM customer"


def _notices(spark, sf_dir):
    n = derived(spark, sf_dir, NOTICES)
    return n.withColumn("action_types", T.classify_actions(F.concat_ws("\n", "title", "text")))


@query("g01_new_notices", "SELECT lang AS provider, 'x' || (doc_id % 300) AS external_id, min(doc_id) AS first_id FROM documents d WHERE doc_id % 300 >= 20 GROUP BY 1, 2")
def g01(spark, sf_dir):
    b = derived(spark, sf_dir, "SELECT lang AS provider, 'x' || (doc_id % 300) AS external_id, doc_id AS position, source AS title, text FROM documents")
    known = b.where("position % 300 < 20").select("provider", "external_id")
    return G.new_notices(b, known).select("provider", "external_id", F.col("position").alias("first_id"))


@query("g02_id_links", f"""WITH n AS ({NOTICES}), k AS ({NKEYS}), r AS (SELECT notice_id, title || chr(10) || text AS full_text, unnest(list_distinct(regexp_extract_all(title || chr(10) || text, '\\b([A-Z]{{2}}[ie]\\.\\d{{3}})\\b', 1))) AS ref FROM n)
  SELECT DISTINCT notice_id, source_id, source_key, CASE WHEN contains(full_text, ' was removed.') THEN 'DELISTING' ELSE 'LISTING' END AS link_type, contains(full_text, ref) AS quoted FROM r JOIN k ON upper(replace(ref, '.', '')) = key_value""")
def g02(spark, sf_dir):
    n = _notices(spark, sf_dir)
    return G.id_links(n, G.references(n), derived(spark, sf_dir, NKEYS)).select("notice_id", "source_id", "source_key", "link_type", F.col("verbatim_quote").isNotNull().alias("quoted"))


@query("g03_removed_id_links", f"WITH r AS (SELECT notice_id, unnest(list_distinct(regexp_extract_all(text, '\\b([A-Z]{{2}}[ie]\\.\\d{{3}})\\b', 1))) AS ref FROM ({NOTICES})) SELECT notice_id, 'L' || (nr % 3) AS source_id, ref AS source_key, 'DELISTING' AS link_type FROM r JOIN (SELECT DISTINCT c_custkey % 100 AS nr FROM customer WHERE c_custkey % 100 < 25) c ON ref = 'TAi.' || lpad(nr::VARCHAR, 3, '0')")
def g03(spark, sf_dir):
    n = _notices(spark, sf_dir)
    cands = derived(spark, sf_dir, "SELECT DISTINCT 'TAi.' || lpad(CAST(c_custkey % 100 AS VARCHAR(9)), 3, '0') AS source_key, 'L' || CAST(c_custkey % 100 % 3 AS VARCHAR(9)) AS source_id, 'PENDING' AS status FROM customer WHERE c_custkey % 100 < 25")
    return G.removed_id_links(G.references(n), cands).select("notice_id", "source_id", "source_key", "link_type")


_nrm = lambda c: f"trim(regexp_replace(regexp_replace(lower(strip_accents({c})), '[^a-z0-9_\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
#: The rule of ``normalize_name``: letters and digits of any script stay, marks and modifiers vanish, all else is a blank.
_fold = lambda c: f"trim(regexp_replace(regexp_replace(replace(lower(strip_accents(regexp_replace({c}, '[\u00a8\u00af\u00b4\u00b8]', ' ', 'g'))), 'ß', 'ss'), '[\\p{{Mn}}\\p{{Lm}}\\p{{Sk}}]', '', 'g'), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"
#: Names of one token or under six characters are too common to count, as ``names_in_texts`` says.
_HITS = f"t AS (SELECT doc_id, {_fold('text')} AS norm FROM documents), b AS (SELECT item_id, {_fold('text')} AS name FROM benchmark), hit AS (SELECT doc_id AS notice_id, item_id AS name_id FROM t JOIN b ON length(name) >= 6 AND contains(name, ' ') AND contains(' ' || norm || ' ', ' ' || name || ' '))"


def _hits(spark, sf_dir):
    texts = derived(spark, sf_dir, "SELECT doc_id AS notice_id, text FROM documents").select("notice_id", N.normalize_name(F.col("text")).alias("norm"))
    names = derived(spark, sf_dir, "SELECT item_id AS name_id, text FROM benchmark").select("name_id", N.normalize_name(F.col("text")).alias("name"))
    return G.names_in_texts(texts, names)


@query("g04_names_in_texts", f"WITH {_HITS} SELECT * FROM hit")
def g04(spark, sf_dir):
    return _hits(spark, sf_dir)


EV = "SELECT item_id AS name_id, 'L' || CAST(item_id % 3 AS VARCHAR(9)) AS source_id, item_id AS source_key, CASE item_id % 3 WHEN 0 THEN 'REMOVE' WHEN 1 THEN 'ADD' ELSE 'CHANGE' END AS change_type, DATE '2024-01-15' AS created_at FROM benchmark"


@query("g05_g06_notice_status", f"WITH {_HITS}, e AS ({EV}), l AS (SELECT DISTINCT notice_id FROM hit JOIN e USING (name_id) WHERE change_type <> 'CHANGE' AND (notice_id % 4 <> 0)) SELECT doc_id AS notice_id, CASE WHEN l.notice_id IS NOT NULL THEN 'MATCHED' ELSE 'NO_MATCH' END AS extraction_status FROM documents LEFT JOIN l ON doc_id = l.notice_id")
def g05(spark, sf_dir):
    n = derived(spark, sf_dir, "SELECT doc_id AS notice_id, CASE WHEN doc_id % 4 = 0 THEN DATE '2023-01-01' WHEN doc_id % 4 = 1 THEN DATE '2024-02-20' END AS published_on, CAST(array() AS array<string>) AS action_types FROM documents")
    links = G.name_links(_hits(spark, sf_dir), n, derived(spark, sf_dir, EV), F.to_date(F.lit("2024-01-20")))
    return G.statuses(n, G.dedupe_links(links.union(links)), pending=0).select("notice_id", "extraction_status")


SIG = "SELECT event_id AS notice_id, 'e' || CAST(event_id % 4000 AS VARCHAR(9)) AS external_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS published_on, user_id FROM events"


@query("g07_signals", f"SELECT DISTINCT external_id || '->' || t AS signal_id, t AS target_source_id FROM (SELECT external_id, published_on, unnest(['S' || (user_id % 60), 'S1']) AS t FROM ({SIG})) WHERE (published_on IS NULL OR published_on >= DATE '2024-01-10' - 2) AND t IN (SELECT 'S' || (o_custkey % 40) FROM orders)")
def g07(spark, sf_dir):
    n = derived(spark, sf_dir, SIG).withColumn("signal_for", F.array(F.concat(F.lit("S"), F.col("user_id") % 60), F.lit("S1")))
    return G.signals(n, derived(spark, sf_dir, RUNS), F.to_date(F.lit("2024-01-10"))).select("signal_id", "target_source_id")


OBS = "SELECT event_id AS signal_id, 'S' || CAST(user_id % 40 AS VARCHAR(9)) AS target_source_id, ts AS observed_at FROM events WHERE event_type = 'signup'"
PUB = "SELECT 'S' || CAST(user_id % 40 AS VARCHAR(9)) AS source_id, ts AS published_at FROM events WHERE event_type = 'purchase'"


@query("g08_signal_consumption", f"WITH s AS ({OBS}), p AS ({PUB}) SELECT signal_id, target_source_id, (SELECT min(published_at) FROM p WHERE p.source_id = s.target_source_id AND p.published_at >= s.observed_at)::DATE AS consumed_on FROM s")
def g08(spark, sf_dir):
    return G.consumed(derived(spark, sf_dir, OBS), derived(spark, sf_dir, PUB)).select("signal_id", "target_source_id", F.to_date("consumed_at").alias("consumed_on"))


EXTR = "SELECT doc_id, CAST(doc_id % 3 AS INT) AS entry_no, CASE WHEN doc_id % 5 = 0 THEN 'not in the text at all' ELSE substring(text, 3, 40) END AS quote, source, text FROM documents"


@query("f22_extraction_checks", f"WITH e AS (SELECT *, {_nrm('text')} AS norm FROM ({EXTR})), n AS (SELECT *, CASE WHEN doc_id % 4 = 0 THEN 'nobody of that name' ELSE array_to_string(string_split(norm, ' ')[2:4], ' ') END AS name FROM e) SELECT doc_id, entry_no, contains(trim(regexp_replace(text, '\\s+', ' ', 'g')), trim(regexp_replace(quote, '\\s+', ' ', 'g'))) AS quote_ok, contains(' ' || norm || ' ', ' ' || name || ' ') AS name_ok, contains(upper(regexp_replace(text, '[\\s\\-./]', '', 'g')), upper(regexp_replace(quote, '[\\s\\-./]', '', 'g'))) AS ids_ok FROM n")
def f22(spark, sf_dir):
    e = derived(spark, sf_dir, EXTR).withColumn("norm_text", N.normalize_name(F.col("text")))
    name = F.when(F.col("doc_id") % 4 == 0, "nobody of that name").otherwise(F.array_join(F.slice(F.split("norm_text", " "), 2, 3), " "))
    entries = e.select("doc_id", "entry_no", "quote", F.array("quote").alias("identifiers"), name.alias("name_norm"))
    out = R.verify_extraction(entries, e.select("doc_id", "text", "norm_text"), "name_norm", "norm_text")
    ok = lambda problem: ~F.array_contains("problems", problem)
    return out.select("doc_id", "entry_no", ok("QUOTE_NOT_FOUND").alias("quote_ok"), ok("NAME_NOT_FOUND").alias("name_ok"), ok("IDENTIFIER_NOT_FOUND").alias("ids_ok"))


@query("g09_extraction_links", f"WITH e AS (SELECT doc_id, 'entry ' || (doc_id % 200) AS nm FROM documents), c AS (SELECT DISTINCT source_id, source_key, 'entry ' || (source_key % 500) AS nm FROM ({CANDS}) WHERE status = 'PENDING') SELECT DISTINCT e.doc_id, c.source_id, c.source_key, 0.8::DOUBLE AS confidence FROM e JOIN c USING (nm)")
def g09(spark, sf_dir):
    e = derived(spark, sf_dir, "SELECT doc_id, concat('Entry, ', doc_id % 200) AS raw FROM documents")
    c = derived(spark, sf_dir, CANDS).where("status = 'PENDING'").selectExpr("source_id", "source_key", "concat('entry ', source_key % 500) AS nm").distinct()
    # a record has one name, so both sides without repeats give links without repeats, and no link is shuffled
    named = N.with_normalized(e, "raw", "nm").select("doc_id", "nm").distinct()
    # both sides are small where their links are many, so a given number of partitions keeps them from being put together in one task
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return named.repartition(n, "nm").join(c.repartition(n, "nm"), "nm").select("doc_id", "source_id", "source_key", F.lit(0.8).alias("confidence"))


CUR = "SELECT 'L' || CAST(c_custkey % 3 AS VARCHAR(9)) AS source_id, c_custkey AS source_key, c_mktsegment AS entity_type, CAST(floor(c_acctbal) AS BIGINT) AS created_at FROM customer"
RES = "SELECT o_orderkey AS result_id, 'L' || CAST(o_custkey % 3 AS VARCHAR(9)) AS source_id, o_custkey AS source_key, o_custkey AS subject_id, 'P' || CAST(o_orderkey % 3 AS VARCHAR(9)) AS provider, o_orderdate AS fetched_at, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey + 1 END AS superseded_by, CASE o_orderstatus WHEN 'F' THEN 'NEEDS_REVIEW' ELSE 'NO_MATCH' END AS status, CAST(o_orderkey % 100 AS DOUBLE) / 100 AS score FROM orders"


@query("h01_subjects", f"WITH y AS (SELECT DISTINCT source_id, source_key FROM ({RES}) WHERE superseded_by IS NULL AND fetched_at::DATE > DATE '2001-06-30' - 700) SELECT source_key, entity_type FROM ({CUR}) c ANTI JOIN y USING (source_id, source_key) WHERE entity_type IN ('MACHINERY','BUILDING') ORDER BY created_at DESC, source_key LIMIT 100")
def h01(spark, sf_dir):
    return E.subjects(derived(spark, sf_dir, CUR), derived(spark, sf_dir, RES), F.to_date(F.lit("2001-06-30")), 700, 100, ("MACHINERY", "BUILDING")).select("source_key", "entity_type")


@query("h03_decisions", "SELECT o_orderkey, CASE WHEN o_orderkey % 100 >= 95 THEN 'AUTO_ACCEPTED' WHEN o_orderkey % 100 >= 85 THEN 'NEEDS_REVIEW' ELSE 'NO_MATCH' END AS status FROM orders")
def h03(spark, sf_dir):
    return derived(spark, sf_dir, "SELECT o_orderkey, CAST(o_orderkey % 100 AS DOUBLE) / 100 AS score FROM orders").select("o_orderkey", N.decision(F.col("score")).alias("status"))


def _score(a: str, b: str) -> str:
    """SQL of the name score: common subsequence of the token-sorted names, bit-parallel in 128-bit integers (names of 120 characters at most)."""
    tidy = lambda x: f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"
    x, y = tidy(a), tidy(b)
    masks = f"list_transform(string_split({y}, ''), lambda c: list_sum(list_transform(range(length({x})), lambda i: CASE WHEN substr({x}, (i + 1)::INT, 1) = c THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END))::HUGEINT)"
    full = f"((1::HUGEINT << length({x})::INT) - 1)"
    rest = f"list_reduce(list_prepend({full}, {masks}), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full})"
    return f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 ELSE round(2 * (length({x}) - bit_count({rest}))::DOUBLE / (length({x}) + length({y})), 4) END::DOUBLE"


def _near(a: str, b: str) -> str:
    """SQL of an upper bound: the edit distance is never above the number of insertions and deletions, which a score of 0.85 limits."""
    tidy = lambda x: f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"
    return f"{a} <> '' AND {b} <> '' AND levenshtein({tidy(a)}, {tidy(b)}) <= 0.1501 * (length({a}) + length({b}))"


@query("h02_name_scores", f"WITH p AS (SELECT DISTINCT p_name AS a, string_split(p_name, ' ')[1] AS t FROM part) SELECT p.a, q.a AS b, {_score('p.a', 'q.a')} AS score FROM p JOIN p q USING (t) WHERE p.a <= q.a")
def h02(spark, sf_dir):
    p = derived(spark, sf_dir, "SELECT DISTINCT p_name AS a, split(p_name, ' ')[0] AS t FROM part")
    return p.join(p.withColumnRenamed("a", "b"), "t").where("a <= b").select("a", "b", N.name_score(F.col("a"), F.col("b")).alias("score"))


#: Subjects and register entries with names of two tokens, some misspelt, some without a country.
SUBJ = "SELECT p_partkey AS subject_id, 'LEI' || CAST(p_partkey % 900 AS VARCHAR(9)) AS lei, p_partkey % 7 = 0 AS lei_valid, CAST(p_partkey % 1500 AS VARCHAR(9)) AS reg_norm, CASE WHEN p_partkey % 10 <> 4 THEN p_brand END AS country, CASE p_partkey % 12 WHEN 2 THEN substring(p_name, 2, 40) WHEN 6 THEN replace(p_name, ' ', 'x ') || 'x' WHEN 8 THEN substring(p_name, 1, 3) || substring(p_name, 5, 40) || 'y' ELSE p_name END AS core FROM part WHERE p_partkey % 2 = 0"
REG = "SELECT 'LEI' || CAST(p_partkey AS VARCHAR(9)) AS lei, CAST(p_partkey % 1400 AS VARCHAR(9)) AS reg_norm, p_brand AS country, p_name || CASE WHEN p_partkey % 3 = 0 THEN 'ory' ELSE '' END AS core FROM part WHERE p_partkey % 2 = 1"


@query("h04_legal_entities", f"""WITH s AS ({SUBJ}), r AS ({REG}), hits AS (
  SELECT subject_id, r.lei AS k, 'LEI' AS m, 1.0::DOUBLE AS score, 1 AS tier FROM s JOIN r ON s.lei = r.lei WHERE lei_valid
  UNION ALL SELECT subject_id, r.lei, 'REGISTRATION_NUMBER', 1.0, 2 FROM s JOIN (SELECT *, count(*) OVER (PARTITION BY reg_norm, country) AS n FROM r) r ON s.reg_norm = r.reg_norm AND s.country = r.country WHERE r.n = 1 AND r.reg_norm <> ''),
l AS (SELECT * FROM s ANTI JOIN hits USING (subject_id)), cp AS (SELECT c.core, q.core AS r_core FROM (SELECT DISTINCT core FROM l) c JOIN (SELECT DISTINCT core FROM r) q ON {_near('c.core', 'q.core')}),
sc AS MATERIALIZED (SELECT * FROM (SELECT core, r_core, {_score('core', 'r_core')} AS score FROM cp) WHERE score >= 0.85),
w AS (SELECT DISTINCT core, country FROM l), home AS (SELECT w.core, w.country, r.lei AS k, sc.score FROM w JOIN sc USING (core) JOIN (SELECT core AS r_core, country AS rc, min(lei) AS lei FROM r GROUP BY ALL) r USING (r_core) WHERE w.country IS NULL OR w.country = r.rc),
low AS (SELECT * FROM w WHERE w.country IS NOT NULL AND NOT EXISTS (SELECT 1 FROM home h WHERE h.core = w.core AND h.country = w.country AND h.score >= 0.85)),
away AS (SELECT low.core, low.country, r.lei AS k, round(sc.score - 0.15, 4) AS score FROM low JOIN sc USING (core) JOIN (SELECT core AS r_core, country AS rc, min(lei) AS lei FROM r GROUP BY ALL) r USING (r_core) WHERE r.rc <> low.country AND round(sc.score - 0.15, 4) >= 0.85),
nm AS (SELECT core, country, k, score FROM (SELECT *, row_number() OVER (PARTITION BY core, country ORDER BY score DESC, k) AS rn FROM (SELECT * FROM home UNION ALL SELECT * FROM away)) WHERE rn = 1),
every AS (SELECT * FROM hits UNION ALL SELECT subject_id, k, 'NAME_COUNTRY', score, 3 FROM l JOIN nm ON l.core = nm.core AND l.country IS NOT DISTINCT FROM nm.country),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY tier, score DESC, k) AS rn FROM every) WHERE rn = 1),
o AS (SELECT s.subject_id, coalesce(m, 'NAME_COUNTRY') AS match_method, coalesce(score, 0.0)::DOUBLE AS score, CASE WHEN tier < 3 OR score >= 0.95 THEN 'AUTO_ACCEPTED' WHEN score >= 0.85 THEN 'NEEDS_REVIEW' ELSE 'NO_MATCH' END AS status, k FROM s LEFT JOIN best USING (subject_id))
SELECT subject_id, match_method, score, status, CASE WHEN status <> 'NO_MATCH' THEN k END AS provider_key FROM o""")
def h04(spark, sf_dir):
    return E.legal_entities(derived(spark, sf_dir, SUBJ), derived(spark, sf_dir, REG)).select("subject_id", "match_method", "score", "status", "provider_key")


#: Names of one to three invented words, and the same misspelt: a letter gone, one doubled, the words turned round, one more word.
MISSPELT = "SELECT CASE length(core) % 4 WHEN 0 THEN substring(core, 1, 2) || substring(core, 4, 90) WHEN 1 THEN substring(core, 1, 4) || substring(core, 4, 90) WHEN 2 THEN core || ' bank' ELSE core END AS core FROM cores"
_WORDS = "lower(regexp_replace(array_to_string(string_split(text, ' ')[1 : CAST(doc_id % 3 AS INT) + 1], ' '), '[^A-Za-z0-9]+', ' ', 'g'))"


@query("h04_name_candidates", f"""WITH cores AS (SELECT DISTINCT trim({_WORDS}) AS core FROM documents WHERE text IS NOT NULL), r AS (SELECT DISTINCT trim(replace(core, '  ', ' ')) AS r_core FROM ({MISSPELT})),
cp AS MATERIALIZED (SELECT core, r_core FROM cores JOIN r ON {_near('core', 'r_core')}), sc AS (SELECT core, r_core, {_score('core', 'r_core')} AS score FROM cp)
SELECT * FROM sc WHERE score >= 0.85""")
def h04_candidates(spark, sf_dir):
    cores = derived(spark, sf_dir, "SELECT DISTINCT trim(lower(regexp_replace(substring_index(text, ' ', CAST(doc_id % 3 AS INT) + 1), '[^A-Za-z0-9]+', ' '))) AS core FROM documents WHERE text IS NOT NULL")
    cores.createOrReplaceTempView("cores")
    return FZ.pairs(cores, spark.sql(f"SELECT DISTINCT trim(replace(core, '  ', ' ')) AS r_core FROM ({MISSPELT})"), 0.85)


PAR = "SELECT 'LEI' || CAST(o_orderkey AS VARCHAR(9)) AS lei, 'LEI' || CAST(o_custkey AS VARCHAR(9)) AS parent, CASE WHEN o_orderkey % 2 = 0 THEN 'DIRECT' ELSE 'ULTIMATE' END AS kind FROM orders"


@query("h05_parents", f"WITH a AS (SELECT c_custkey AS subject_id, 'LEI' || (c_custkey * 3) AS provider_key FROM customer), p AS ({PAR}) SELECT subject_id, a.provider_key, d.parent AS direct_parent, u.parent AS ultimate_parent FROM a LEFT JOIN p d ON d.lei = provider_key AND d.kind = 'DIRECT' LEFT JOIN p u ON u.lei = provider_key AND u.kind = 'ULTIMATE'")
def h05(spark, sf_dir):
    a = derived(spark, sf_dir, "SELECT c_custkey AS subject_id, 'LEI' || (c_custkey * 3) AS provider_key FROM customer")
    return E.parents(a, derived(spark, sf_dir, PAR))


CO = "SELECT p_partkey AS subject_id, CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 3 = 1 THEN 'GB' ELSE 'FR' END AS country, lpad(CAST(p_partkey % 1700 AS VARCHAR(9)), 7, '0') AS reg_norm, CASE WHEN p_partkey % 4 = 1 THEN p_name || 's' ELSE p_name END || ' ' || p_brand AS core FROM part"
COREG = "SELECT lpad(CAST(p_partkey * 2 AS VARCHAR(9)), 7, '0') AS number, p_name || ' ' || p_brand AS core FROM part WHERE p_partkey % 5 = 0"


@query("h06_companies", f"""WITH s AS (SELECT * FROM ({CO}) WHERE country IS NULL OR country = 'GB'), r AS ({COREG}), x AS (SELECT subject_id, number, 1 AS tier, 1.0::DOUBLE AS score FROM s JOIN r ON reg_norm = number),
l AS (SELECT * FROM s ANTI JOIN x USING (subject_id)), f AS (SELECT core AS r_core, min(number) AS number FROM r GROUP BY 1),
cp AS (SELECT l.core, f.r_core, f.number FROM (SELECT DISTINCT core FROM l) l JOIN f ON {_near('l.core', 'f.r_core')}),
sc AS MATERIALIZED (SELECT * FROM (SELECT core, number, {_score('core', 'r_core')} AS score FROM cp) WHERE score >= 0.85), t AS (SELECT core, number, score FROM (SELECT *, row_number() OVER (PARTITION BY core ORDER BY score DESC, number) AS rn FROM sc) WHERE rn = 1),
b AS (SELECT * FROM x UNION ALL SELECT subject_id, number, 2, score FROM l JOIN t USING (core)),
fq AS (SELECT t, count(*) AS n FROM (SELECT r_core, unnest(list_distinct(string_split(r_core, ' '))) AS t FROM f) GROUP BY 1), z AS (SELECT DISTINCT core FROM l WHERE core NOT IN (SELECT core FROM t)),
rare AS (SELECT core, t, own FROM (SELECT *, row_number() OVER (PARTITION BY core, own ORDER BY coalesce(n, 0), t) AS rn, count(*) OVER (PARTITION BY core, own) AS k FROM (SELECT core, own, unnest(list_distinct(string_split(core, ' '))) AS t FROM (SELECT core, true AS own FROM z UNION ALL SELECT r_core, false FROM f)) LEFT JOIN fq USING (t)) WHERE rn <= k - ceil(k / 2) + 1),
nr AS (SELECT core, max({_score('core', 'r_core')}) AS near FROM (SELECT DISTINCT a.core, b.core AS r_core FROM rare a JOIN rare b ON a.t = b.t AND a.own AND NOT b.own) GROUP BY 1),
o AS (SELECT s.subject_id, CASE tier WHEN 1 THEN 'REGISTRATION_NUMBER' ELSE 'NAME' END AS match_method, coalesce(score, near, 0.0)::DOUBLE AS score, CASE WHEN tier = 1 OR score >= 0.95 THEN 'AUTO_ACCEPTED' WHEN score >= 0.85 THEN 'NEEDS_REVIEW' ELSE 'NO_MATCH' END AS status, number FROM s LEFT JOIN b USING (subject_id) LEFT JOIN nr ON nr.core = s.core)
SELECT subject_id, match_method, score, status, CASE WHEN status <> 'NO_MATCH' THEN number END AS provider_key FROM o""")
def h06(spark, sf_dir):
    return E.companies(derived(spark, sf_dir, CO), derived(spark, sf_dir, COREG)).select("subject_id", "match_method", F.col("near_score").alias("score"), "status", "provider_key")


AIR = "SELECT c_custkey AS subject_id, CASE WHEN c_custkey % 2 = 0 THEN 'N-' || CAST(c_custkey AS VARCHAR(9)) ELSE 'D-1' END AS tail, CAST(c_custkey % 700 AS VARCHAR(9)) AS serial, 'Model ' || CAST(c_nationkey AS VARCHAR(9)) AS model FROM customer"
MAST = "SELECT CAST(p_partkey * 4 AS VARCHAR(9)) AS n_number, CAST(p_partkey % 500 AS VARCHAR(9)) AS serial, CAST(p_size AS VARCHAR(9)) AS code, p_partkey AS pos FROM part"
MODS = "SELECT CAST(n_nationkey AS VARCHAR(9)) AS code, 'model ' || CAST(n_nationkey AS VARCHAR(9)) AS model FROM nation"


@query("h07_aircraft", f"""WITH s AS ({AIR}), m AS (SELECT n_number AS n, serial AS s, upper(model) AS r_model, pos FROM ({MAST}) a LEFT JOIN ({MODS}) b USING (code)), x AS (
  SELECT subject_id, n, 'TAIL_NUMBER' AS match_method, 1.0::DOUBLE AS score, 1 AS tier, pos FROM s JOIN m ON m.n = subject_id::VARCHAR WHERE subject_id % 2 = 0
  UNION ALL SELECT subject_id, n, 'SERIAL_NUMBER', CASE WHEN r_model IS NOT NULL AND (contains(upper(model), r_model) OR contains(r_model, upper(model))) THEN 1.0 ELSE 0.9 END::DOUBLE, 2, pos FROM s JOIN m ON m.s = s.serial)
  SELECT subject_id, 'N' || n AS provider_key, match_method, score, CASE WHEN score >= 1 THEN 'AUTO_ACCEPTED' ELSE 'NEEDS_REVIEW' END AS status FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY tier, pos) AS rn FROM x) WHERE rn = 1""")
def h07(spark, sf_dir):
    return E.aircraft(derived(spark, sf_dir, AIR), derived(spark, sf_dir, MAST), derived(spark, sf_dir, MODS))


@query("h08_leads", "WITH r AS (SELECT p_name AS core, arg_min('n' || p_partkey, p_partkey) AS provider_key, count(*) - 1 AS others FROM part GROUP BY 1) SELECT p_partkey AS subject_id, provider_key, others, 'NEEDS_REVIEW' AS status FROM part JOIN r ON p_name = core WHERE length(core) >= 6")
def h08(spark, sf_dir):
    return E.leads(derived(spark, sf_dir, "SELECT p_partkey AS subject_id, p_name AS core FROM part"), derived(spark, sf_dir, "SELECT p_name AS core, 'n' || p_partkey AS node_id, p_partkey AS pos FROM part"))


TRIP = "SELECT CASE WHEN o_custkey % 2 = 0 THEN 'IMO' ELSE 'LEI' END AS key_type, CAST(o_custkey AS VARCHAR(9)) AS key, o_orderkey AS pos, CASE WHEN o_orderkey % 3 = 0 THEN 'l' || CAST(o_orderkey AS VARCHAR(9)) END AS label, CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END AS flag, o_orderpriority AS owner FROM orders"


@query("a13_h09_graph", f"WITH f AS (SELECT key_type, key, array_to_string(list_sort(list(DISTINCT owner)), ',') AS owners, arg_max(flag, pos) FILTER (flag IS NOT NULL) AS flag, arg_min(label, pos) FILTER (label IS NOT NULL) AS label FROM ({TRIP}) GROUP BY 1, 2), s AS (SELECT c_custkey AS subject_id, 'IMO' AS key_type, (c_custkey // 2 * 2)::VARCHAR AS key FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'LEI', (c_custkey // 2 * 2 + 1)::VARCHAR FROM customer) SELECT subject_id, key_type, owners, flag, label FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY CASE key_type WHEN 'IMO' THEN 0 ELSE 1 END, key) AS r FROM s JOIN f USING (key_type, key)) WHERE r = 1")
def h09(spark, sf_dir):
    s = derived(spark, sf_dir, "SELECT c_custkey AS subject_id, 'IMO' AS key_type, CAST(c_custkey div 2 * 2 AS STRING) AS key FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, 'LEI', CAST(c_custkey div 2 * 2 + 1 AS STRING) FROM customer")
    return E.graph(s, E.fold(derived(spark, sf_dir, TRIP))).select("subject_id", "key_type", F.array_join("owners", ",").alias("owners"), "flag", "label")


@query("h10_newest_results", f"SELECT subject_id, provider, max(result_id) AS result_id FROM ({RES}) GROUP BY 1, 2")
def h10(spark, sf_dir):
    return E.newest_results(derived(spark, sf_dir, RES)).select("subject_id", "provider", "result_id")


@query("h11_review_proposals", f"WITH n AS (SELECT subject_id, provider, score, row_number() OVER (PARTITION BY subject_id, provider ORDER BY result_id DESC) AS r, status FROM ({RES})) SELECT provider || '|' || subject_id AS dedupe_key, score FROM n WHERE r = 1 AND status = 'NEEDS_REVIEW' AND subject_id % 10 <> 0 ORDER BY score DESC, dedupe_key LIMIT 50")
def h11(spark, sf_dir):
    r = E.newest_results(derived(spark, sf_dir, RES))
    known = r.where("subject_id % 10 = 0").select(F.concat_ws("|", "provider", "subject_id").alias("dedupe_key"))
    return E.review_proposals(r, known).select("dedupe_key", "score")


@query("h12_batch_outcomes", f"SELECT provider, status, count(*) AS n FROM ({RES}) GROUP BY 1, 2")
def h12(spark, sf_dir):
    return derived(spark, sf_dir, RES).groupBy("provider", "status").agg(F.count("*").alias("n"))


SRC = "SELECT 'S' || CAST(o_custkey % 40 AS VARCHAR(9)) AS source_id, o_custkey % 40 < 10 AS is_core, max(CASE WHEN o_custkey % 40 <> 3 AND o_orderkey % 50 = 0 THEN o_orderdate END) AS last_success_at, max(CASE WHEN o_orderkey % 70 = 0 THEN o_orderdate END) AS last_change_at, o_custkey % 40 * 24 AS warn_hours, o_custkey % 40 * 48 AS hard_hours FROM orders GROUP BY o_custkey % 40"


@query("l01_staleness", f"WITH s AS (SELECT *, (epoch(TIMESTAMP '2001-08-30') - epoch(last_success_at)) / 3600 AS age FROM ({SRC})) SELECT source_id, CASE WHEN age > hard_hours THEN CASE WHEN is_core THEN 'PAGE' ELSE 'WARN' END WHEN age > warn_hours OR age IS NULL THEN 'WARN' ELSE 'RESOLVE' END AS level FROM s")
def l01(spark, sf_dir):
    return MO.staleness(derived(spark, sf_dir, SRC), F.to_timestamp(F.lit("2001-08-30")))


@query("l02_unchanged", f"SELECT source_id, (DATE '2001-08-30' - last_change_at::DATE)::INT AS idle_days FROM ({SRC}) WHERE DATE '2001-08-30' - last_change_at::DATE > 40")
def l02(spark, sf_dir):
    return MO.unchanged_for(derived(spark, sf_dir, SRC), F.to_date(F.lit("2001-08-30")), 40)


@query("l03_unanswered_signals", f"SELECT signal_id FROM ({OBS}) s WHERE observed_at + INTERVAL 6 HOUR <= TIMESTAMP '2024-01-30' AND NOT EXISTS (SELECT 1 FROM ({PUB}) p WHERE p.source_id = s.target_source_id AND p.published_at BETWEEN s.observed_at AND s.observed_at + INTERVAL 6 HOUR)")
def l03(spark, sf_dir):
    return MO.unanswered(derived(spark, sf_dir, OBS), derived(spark, sf_dir, PUB), F.expr("TIMESTAMP_NTZ '2024-01-30'")).select("signal_id")


@query("l04_circuits", f"WITH l AS (SELECT source_id, event_id, error_class IS NULL AND event_id % 3 = 0 AS ok FROM ({FETCHES})), i AS (SELECT *, sum(ok::INT) OVER (PARTITION BY source_id ORDER BY event_id) AS isl FROM l), k AS (SELECT *, sum((NOT ok)::INT) OVER (PARTITION BY source_id, isl ORDER BY event_id)::BIGINT AS streak FROM i) SELECT source_id, event_id, streak, CASE WHEN streak >= 3 THEN 'OPEN' ELSE 'CLOSED' END AS breaker_state, CASE WHEN streak = 0 THEN 0 WHEN streak >= 3 THEN least(360, 30 * pow(2, streak - 3)) ELSE least(120, 10 * pow(2, streak - 1)) END::INT AS wait_minutes FROM k")
def l04(spark, sf_dir):
    log = derived(spark, sf_dir, FETCHES).select("source_id", F.col("event_id").alias("seq"), (F.col("error_class").isNull() & (F.col("event_id") % 3 == 0)).alias("ok"))
    return MO.circuit_states(log).select("source_id", F.col("seq").alias("event_id"), "streak", "breaker_state", "wait_minutes")


@query("l05_bookkeeping", f"WITH r AS (SELECT *, attempt < 3 AS contacted FROM ({RUNS})) SELECT source_id, max(queued_at) FILTER (contacted)::DATE AS last_attempt, max(queued_at) FILTER (contacted AND status <> 'FAILED')::DATE AS last_fetch, max(queued_at) FILTER (contacted AND status IN ('SUCCEEDED','NO_CHANGE'))::DATE AS last_success, max(queued_at) FILTER (status = 'SUCCEEDED')::DATE AS last_change FROM r GROUP BY 1")
def l05(spark, sf_dir):
    r = derived(spark, sf_dir, RUNS).select("source_id", F.col("queued_at").alias("at"), "status", (F.col("attempt") < 3).alias("contacted"))
    b = MO.bookkeeping(r)
    return b.select("source_id", *[F.to_date(f"{c}_at").alias(c) for c in ("last_attempt", "last_fetch", "last_success", "last_change")])


INC = "SELECT 'K' || CAST(user_id % 60 AS VARCHAR(9)) AS dedupe_key, event_id AS seq, CAST(ts AS DATE) AS at, CASE WHEN event_type = 'signup' THEN 'RESOLVED' ELSE 'SEEN' END AS kind, CASE event_id % 5 WHEN 0 THEN 'PAGE' WHEN 1 THEN 'WARN' WHEN 2 THEN 'WARN' ELSE 'INFO' END AS severity FROM events"


@query("l06_incidents", f"WITH l AS (SELECT *, coalesce(sum((kind = 'RESOLVED')::INT) OVER (PARTITION BY dedupe_key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS island FROM ({INC})) SELECT dedupe_key, island, count(*) FILTER (kind <> 'RESOLVED') AS occurrences, min(l.at) AS opened_at, max(l.at) FILTER (kind <> 'RESOLVED') AS last_seen_at, arg_max(severity, CASE severity WHEN 'PAGE' THEN 3 WHEN 'WARN' THEN 2 ELSE 1 END) AS severity, CASE WHEN bool_or(kind = 'RESOLVED') THEN 'RESOLVED' ELSE 'OPEN' END AS status FROM l GROUP BY 1, 2 HAVING count(*) FILTER (kind <> 'RESOLVED') > 0")
def l06(spark, sf_dir):
    return MO.incidents(derived(spark, sf_dir, INC))


AL = "SELECT event_id AS incident_id, CASE WHEN event_type = 'click' THEN 'RESOLVED' ELSE 'OPEN' END AS status, CASE WHEN event_id % 2 = 0 THEN 'PAGE' ELSE 'WARN' END AS severity, CASE WHEN event_id % 3 <> 0 THEN ts END AS alerted_at FROM events"


@query("l07_alerts", f"SELECT incident_id FROM ({AL}) WHERE status = 'OPEN' AND (alerted_at IS NULL OR (severity = 'PAGE' AND alerted_at < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 1 HOUR))")
def l07(spark, sf_dir):
    return MO.alerts(derived(spark, sf_dir, AL), F.to_timestamp(F.lit("2024-01-20"))).select("incident_id")


@query("l08_attention", f"SELECT 'pending' AS what, count(*) AS n FROM ({CANDS}) WHERE status = 'PENDING' UNION ALL SELECT 'held', count(*) FROM ({RUNS}) WHERE status = 'HELD' UNION ALL SELECT 'rejected_links', count(*) FROM ({LINKS}) WHERE status = 'REJECTED'")
def l08(spark, sf_dir):
    n = lambda what, df: df.agg(F.lit(what).alias("what"), F.count("*").alias("n"))
    return n("pending", derived(spark, sf_dir, CANDS).where("status = 'PENDING'")).union(n("held", derived(spark, sf_dir, RUNS).where("status = 'HELD'"))).union(n("rejected_links", derived(spark, sf_dir, LINKS).where("status = 'REJECTED'")))


@query("l09_resume_chains", "WITH RECURSIVE r AS (SELECT c_custkey AS run_id, CASE WHEN c_custkey % 40 <> 0 THEN c_custkey - 1 END AS resumed_from FROM customer), w AS (SELECT run_id, resumed_from, 0 AS n FROM r UNION ALL SELECT w.run_id, r.resumed_from, w.n + 1 FROM w JOIN r ON r.run_id = w.resumed_from) SELECT run_id, max(n) AS chain FROM w GROUP BY 1")
def l09(spark, sf_dir):
    return MO.chain_lengths(derived(spark, sf_dir, "SELECT c_custkey AS run_id, CASE WHEN c_custkey % 40 <> 0 THEN c_custkey - 1 END AS resumed_from FROM customer"))


@query("l10_expired_staging", f"SELECT run_id FROM ({RUNS}) WHERE queued_at::DATE < DATE '2001-01-01' - 90 AND status <> 'HELD'")
def l10(spark, sf_dir):
    return MO.expired(derived(spark, sf_dir, RUNS).withColumnRenamed("queued_at", "created_at"), F.to_date(F.lit("2001-01-01")), 90).select("run_id")


@query("l10_retention", f"SELECT run_id, status FROM ({RUNS}) WHERE status = 'HELD' OR date_trunc('month', queued_at)::DATE + INTERVAL 1 MONTH > DATE '1999-01-01' - 90")
def l10_retention(spark, sf_dir):
    """Runs written by month, then what expires is dropped by whole months."""
    runs = derived(spark, sf_dir, RUNS).select("run_id", F.col("queued_at").cast("timestamp").alias("queued_at"), "status")
    evidence = RT.Evidence(spark, new_path(spark, "evidence"), ", ".join(f"{n} {t}" for n, t in runs.dtypes), "queued_at")
    evidence.append(runs)
    evidence.expire(dt.date(1999, 1, 1), 90, F.col("status") == "HELD")
    return evidence.read().select("run_id", "status")
