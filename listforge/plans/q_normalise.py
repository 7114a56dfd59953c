"""Registered queries: normalisers and filters (sections B and C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import countries as K
from ..functions import dates as D
from ..functions import names as N
from ..functions import text as T
from ..operators import filters as FL
from .derive import IDENTIFIERS, derived
from .registry import query

CODES = {"DEU": "DE", "FRA": "FR", "IRN": "IR", "BHS": "BS"}
NAMES = {"Germany": "DE", "France": "FR"}
COUNTRY_TEXT = """SELECT c_custkey AS id, CASE c_custkey % 12 WHEN 0 THEN 'Iran (Islamic Republic of)' WHEN 1 THEN 'Tehran, Iran' WHEN 2 THEN 'de' WHEN 3 THEN 'deu' WHEN 4 THEN ' The  Bahamas. ' WHEN 5 THEN 'Atlantis'
 WHEN 6 THEN 'Hong Kong, China' WHEN 7 THEN 'GERMANY' WHEN 8 THEN '' WHEN 9 THEN NULL WHEN 10 THEN 'Congo (Democratic Republic)' ELSE c_mktsegment || ', France' END AS raw FROM customer"""


def _sq(x: str) -> str:
    return x.replace("'", "''")


_ckey = lambda c: f"regexp_replace(trim(regexp_replace(lower(trim({c})), '\\s+', ' ', 'g'), ' .;'), '^the ', '')"
_rows = [f"('iso2','{c}','{c}')" for c in {*CODES.values(), "XK"}] + [f"('iso3','{k}','{c}')" for k, c in CODES.items()]
_rows += [f"('name','{_sq(n)}','{c}')" for n, c in {**NAMES, **K.ALIASES, **{k.replace(',', ''): v for k, v in K.ALIASES.items()}}.items()]
COUNTRY_ORACLE = f"""WITH dim AS (SELECT kind, CASE WHEN kind = 'name' THEN {_ckey('raw')} ELSE raw END AS k, max(iso2) AS iso2 FROM (VALUES {','.join(_rows)}) t(kind, raw, iso2) GROUP BY 1, 2),
n AS (SELECT k, iso2 FROM dim WHERE kind = 'name'), r AS (SELECT id, raw, trim(raw) AS s, {_ckey('raw')} AS k FROM ({COUNTRY_TEXT}))
SELECT id, raw, coalesce((SELECT iso2 FROM dim WHERE kind = 'iso2' AND length(s) = 2 AND dim.k = upper(s)), (SELECT iso2 FROM dim WHERE kind = 'iso3' AND length(s) = 3 AND dim.k = upper(s)),
  (SELECT iso2 FROM n WHERE n.k = r.k), (SELECT iso2 FROM n WHERE n.k = replace(r.k, ',', '')), (SELECT iso2 FROM n WHERE n.k = regexp_extract(r.k, '^(.*?)\\s*\\((.*)\\)$', 1) AND n.k <> ''),
  (SELECT iso2 FROM n WHERE contains(r.k, ',') AND n.k = trim(regexp_extract(r.k, '([^,]*)$', 1)))) AS iso2 FROM r"""


@query("b01_country_codes", COUNTRY_ORACLE)
def b01(spark, sf_dir):
    return K.to_iso2(derived(spark, sf_dir, COUNTRY_TEXT), "raw", "iso2", K.dimension(spark, NAMES, CODES))


NAME_TEXT = """SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 'Étienne  O''Brien-' || c_mktsegment WHEN 1 THEN upper(c_name) || ', JR.' WHEN 2 THEN ' Ünsal (' || c_mktsegment || ') ' WHEN 3 THEN 'a.b.c.' || c_custkey ELSE c_name END AS name FROM customer"""


@query("b02_name_normal", f"SELECT id, trim(regexp_replace(regexp_replace(lower(strip_accents(name)), '[^a-z0-9_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS norm FROM ({NAME_TEXT})")
def b02(spark, sf_dir):
    return N.with_normalized(derived(spark, sf_dir, NAME_TEXT), "name", "norm").select("id", "norm")


DATE_SPARK = """SELECT o_orderkey AS id, CASE o_orderkey % 9 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 1 THEN date_format(o_orderdate, 'dd/MM/yyyy') WHEN 2 THEN date_format(o_orderdate, 'd MMM yyyy') WHEN 3 THEN date_format(o_orderdate, 'MMMM yyyy')
 WHEN 4 THEN concat('circa ', date_format(o_orderdate, 'yyyy')) WHEN 5 THEN concat('Between ', year(o_orderdate), ' and ', year(o_orderdate) + o_custkey % 4) WHEN 6 THEN concat('dd/mm/', year(o_orderdate)) WHEN 7 THEN concat('31/02/', year(o_orderdate)) ELSE 'unknown' END AS raw FROM orders"""
DATE_DUCK = """SELECT o_orderkey AS id, o_orderdate::DATE AS d, year(o_orderdate)::INT AS y, o_orderkey % 9 AS k, (o_custkey % 4)::INT AS w FROM orders"""


@query(
    "b03_partial_dates",
    f"SELECT id, CASE WHEN k <= 2 THEN d WHEN k = 3 THEN date_trunc('month', d)::DATE END AS date_value, CASE WHEN k NOT IN (5, 8) THEN y END AS year, CASE WHEN k = 5 THEN y END AS year_from, CASE WHEN k = 5 THEN y + w END AS year_to, "
    f"CASE WHEN k <= 2 THEN 'DAY' WHEN k = 3 THEN 'MONTH' WHEN k IN (4, 6) THEN 'YEAR' WHEN k = 5 THEN 'RANGE' ELSE 'UNKNOWN' END AS precision FROM ({DATE_DUCK})",
)
def b03(spark, sf_dir):
    df = derived(spark, sf_dir, DATE_SPARK).select("id", D.parse_partial(F.col("raw")).alias("p"))
    return df.select("id", *[f"p.{c}" for c in ("date_value", "year", "year_from", "year_to", "precision")])


@query("b04_full_dates", f"SELECT id, CASE WHEN k <= 2 THEN d END AS parsed FROM ({DATE_DUCK})")
def b04(spark, sf_dir):
    return derived(spark, sf_dir, DATE_SPARK).select("id", D.parse_full(F.col("raw")).alias("parsed"))


_imo = "CASE WHEN length(n) = 7 THEN (7*substr(n,1,1)::INT+6*substr(n,2,1)::INT+5*substr(n,3,1)::INT+4*substr(n,4,1)::INT+3*substr(n,5,1)::INT+2*substr(n,6,1)::INT)%10 = substr(n,7,1)::INT ELSE false END"


@query(
    "b10_identifiers",
    f"""WITH r AS (SELECT rid, label, trim(value) AS value, regexp_extract(replace(value, ' ', ''), '(\\d{{7}})', 1) AS n, upper(regexp_replace(trim(value), '[\\s\\-./]', '', 'g')) AS norm FROM ({IDENTIFIERS}) WHERE trim(value) <> '')
    SELECT rid, CASE label WHEN 'IMO number' THEN 'IMO' WHEN 'Passport' THEN 'PASSPORT' WHEN 'MMSI' THEN 'MMSI' ELSE 'OTHER' END AS id_type, CASE WHEN label = 'IMO number' THEN n ELSE norm END AS value_norm,
      CASE label WHEN 'IMO number' THEN {_imo} WHEN 'MMSI' THEN length(norm) = 9 END AS checksum_valid FROM r""",
)
def b10(spark, sf_dir):
    ident = T.make_identifier(F.col("label"), F.col("value"))
    return derived(spark, sf_dir, IDENTIFIERS).select("rid", ident.alias("i")).where("i IS NOT NULL").select("rid", "i.id_type", "i.value_norm", "i.checksum_valid")


LEI_TEXT = "SELECT c_custkey AS id, upper(substring(sha256(CAST(c_custkey AS VARCHAR(20))), 1, 18)) || lpad(CAST(c_custkey % 98 AS VARCHAR(9)), 2, '0') AS lei FROM customer"


@query(
    "b07_lei_checksums",
    f"WITH r AS ({LEI_TEXT}), d AS (SELECT id, lei, array_to_string(list_transform(regexp_extract_all(lei, '.'), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE (ascii(c) - 55)::VARCHAR END), '') AS n FROM r) SELECT id, lei, CAST(list_reduce(list_prepend(0::BIGINT, list_transform(regexp_extract_all(n, '.'), lambda c: c::BIGINT)), lambda a, b: (a * 10 + b) % 97) = 1 AS BOOLEAN) AS ok FROM d",
)
def b07(spark, sf_dir):
    df = derived(spark, sf_dir, LEI_TEXT.replace("sha256(CAST(c_custkey AS VARCHAR(20)))", "sha2(CAST(c_custkey AS STRING), 256)"))
    return df.withColumn("ok", T.lei_checksum_ok(F.col("lei")))


IMO_TEXT = "SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'IMO ' || lpad(CAST(o_orderkey * 7919 % 10000000 AS VARCHAR(9)), 7, '0') WHEN 1 THEN lpad(CAST(o_orderkey * 7919 % 10000000 AS VARCHAR(9)), 7, '0') WHEN 2 THEN 'no. 90' || CAST(10000 + o_orderkey % 90000 AS VARCHAR(9)) || '.' WHEN 3 THEN '12345678' ELSE 'imo none' END AS raw FROM orders"


@query("b06_imo_numbers", f"WITH r AS (SELECT id, nullif(CASE WHEN id % 5 < 3 THEN regexp_extract(raw, '([0-9]{{7}})', 1) ELSE '' END, '') AS n FROM ({IMO_TEXT})) SELECT id, n AS imo, CASE WHEN n IS NULL THEN false ELSE (7*substr(n,1,1)::INT+6*substr(n,2,1)::INT+5*substr(n,3,1)::INT+4*substr(n,4,1)::INT+3*substr(n,5,1)::INT+2*substr(n,6,1)::INT)%10 = substr(n,7,1)::INT END AS ok FROM r")
def b06(spark, sf_dir):
    df = derived(spark, sf_dir, IMO_TEXT).withColumn("imo", T.extract_imo(F.col("raw")))
    return df.select("id", "imo", T.imo_checksum_ok(F.col("imo")).alias("ok"))


#: Labels as publishers write them, with the type each must get.
LABELS = {
    "IMO number": "IMO", "Vessel Registration Identification": "IMO", "MMSI": "MMSI", "Vessel Call Sign": "CALL_SIGN", "Legal Entity Number": "LEI", "LEI": "LEI", "SWIFT/BIC": "SWIFT", "Passport": "PASSPORT", "National ID No.": "NATIONAL_ID", "Identity Card": "NATIONAL_ID",
    "Cedula No.": "NATIONAL_ID", "Tax ID No.": "TAX", "INN": "TAX", "V.A.T. Number": "OTHER", "VAT Number": "TAX", "Registration Number": "REGISTRATION", "Company Number": "REGISTRATION", "Business Number": "REGISTRATION", "Unified Social Credit Code": "REGISTRATION",
    "Aircraft Serial Number (maker)": "AIRCRAFT_MSN", "Serial Number": "AIRCRAFT_MSN", "Aircraft Tail Number": "AIRCRAFT_TAIL", "Email Address": "EMAIL", "Website": "WEBSITE", "Minimum": "OTHER", "Taxi": "OTHER", "D-U-N-S Number": "OTHER", "": "OTHER",
}
LABEL_TEXT = "SELECT o_orderkey AS id, " + "CASE o_orderkey % " + str(len(LABELS)) + " " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(LABELS)) + " END AS label FROM orders"


@query("b09_label_types", "SELECT o_orderkey AS id, CASE o_orderkey % " + str(len(LABELS)) + " " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(LABELS.values())) + " END AS id_type FROM orders")
def b09(spark, sf_dir):
    return derived(spark, sf_dir, LABEL_TEXT).select("id", T.classify_label(F.col("label")).alias("id_type"))


#: What publishers call a measure, with the common name each must get.
MEASURES = {"Block": "ASSET_FREEZE", "Blocking (non-SDN)": "ASSET_FREEZE", "Directive 1": "SECTORAL", "CAPTA list": "SECTORAL", "Export ban": "EXPORT_RESTRICTION", "Procurement ban": "PROCUREMENT_BAN", "Visa": "OTHER"}


@query(
    "b13_measures",
    "SELECT o_orderkey AS id, CASE o_orderkey % 7 " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MEASURES.values())) + " END AS normalised, CASE o_orderkey % 3 WHEN 0 THEN 'ASSET_FREEZE,TRAVEL_BAN' WHEN 1 THEN 'ARMS_EMBARGO,ASSET_FREEZE' ELSE '' END AS uk, "
    "CASE o_orderkey % 4 WHEN 0 THEN 'LICENSE_REQUIREMENT' WHEN 1 THEN 'EXPORT_RESTRICTION' WHEN 2 THEN 'DEBARMENT' ELSE 'OTHER' END AS us FROM orders",
)
def b13(spark, sf_dir):
    from ..sources import advanced as A
    from ..sources import lists as L

    k = F.col("id")
    names = "CASE o_orderkey % 7 " + " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MEASURES)) + " END"
    df = derived(spark, sf_dir, f"SELECT o_orderkey AS id, {names} AS kind, CASE o_orderkey % 4 WHEN 0 THEN 'EL' WHEN 1 THEN 'UVL' WHEN 2 THEN 'DTC' ELSE 'ZZ' END AS code FROM orders")
    flags = F.array(F.when(k % 3 == 0, "TRAVEL_BAN"), F.when(k % 3 == 0, "ASSET_FREEZE"), F.when(k % 3 == 0, "ASSET_FREEZE"))
    said = F.when(k % 3 == 1, "Asset freeze, and an arms embargo.")
    return df.select("id", A.measure(F.col("kind")).alias("normalised"), F.array_join(L.uk_measures(flags, said), ",").alias("uk"), L._lit(L.CSL_MEASURES, F.col("code"), "OTHER").alias("us"))


@query(
    "b20_birth_dates",
    "SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'DAY' WHEN 1 THEN 'RANGE' WHEN 2 THEN 'YEAR' ELSE 'UNKNOWN' END AS un_precision, CASE WHEN o_orderkey % 4 = 1 THEN year(o_orderdate) + 2 END::INT AS un_to, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'between ' || year(o_orderdate) || ' and ' || (year(o_orderdate) + 2) WHEN 2 THEN 'approximately ' || year(o_orderdate) ELSE 'n.k.' END AS un_raw, "
    "CASE o_orderkey % 4 WHEN 0 THEN 'DAY' WHEN 1 THEN 'MONTH' WHEN 2 THEN 'YEAR' ELSE 'RANGE' END AS eu_precision, CASE o_orderkey % 4 WHEN 0 THEN o_orderdate::DATE WHEN 1 THEN date_trunc('month', o_orderdate)::DATE END AS eu_date, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m') WHEN 2 THEN 'circa ' || year(o_orderdate) ELSE year(o_orderdate) || '-' || (year(o_orderdate) + 2) END AS eu_raw FROM orders",
)
def b20(spark, sf_dir):
    from ..sources import lists as L

    df = derived(spark, sf_dir, "SELECT o_orderkey AS id, o_orderkey % 4 AS k, CAST(o_orderdate AS DATE) AS d FROM orders")
    k, y = F.col("k"), F.year("d").cast("string")
    un = F.struct(F.when(k == 1, "BETWEEN").when(k == 2, "APPROXIMATELY").otherwise("EXACT").alias("TYPE_OF_DATE"), F.when(k == 0, F.col("d").cast("string")).when(k == 3, "n.k.").alias("DATE"), F.when(k == 2, y).alias("YEAR"), F.when(k == 1, y).alias("FROM_YEAR"), F.when(k == 1, (F.year("d") + 2).cast("string")).alias("TO_YEAR"))
    none = F.lit(None).cast("string")
    eu = F.struct(none.alias("_birthdate"), F.when(k < 3, y).alias("_year"), F.when(k < 2, F.month("d").cast("string")).alias("_monthOfYear"), F.when(k == 0, F.dayofmonth("d").cast("string")).alias("_dayOfMonth"), F.when(k == 3, y).alias("_yearRangeFrom"), F.when(k == 3, (F.year("d") + 2).cast("string")).alias("_yearRangeTo"), F.when(k == 2, "true").otherwise("false").alias("_circa"))
    out = df.select("id", un.alias("un"), eu.alias("eu")).select("id", L.un_birth_date(F.col("un")).alias("u"), L.eu_birth_date(F.col("eu")).alias("e"))
    return out.select("id", F.col("u.precision").alias("un_precision"), F.col("u.year_to").alias("un_to"), F.col("u.raw").alias("un_raw"), F.col("e.precision").alias("eu_precision"), F.col("e.date_value").alias("eu_date"), F.col("e.raw").alias("eu_raw"))


@query(
    "b21_alias_kinds",
    "SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 'FKA' ELSE 'AKA' END AS un_type, CASE c_custkey % 5 WHEN 2 THEN 'STRONG' WHEN 3 THEN 'WEAK' ELSE 'UNKNOWN' END AS un_quality, CASE c_custkey % 3 WHEN 0 THEN 'STRONG' WHEN 1 THEN 'WEAK' ELSE 'UNKNOWN' END AS eu_quality, CASE c_custkey % 5 WHEN 2 THEN 'STRONG' WHEN 3 THEN 'WEAK' WHEN 4 THEN 'STRONG' ELSE 'UNKNOWN' END AS uk_quality FROM customer",
)
def b21(spark, sf_dir):
    from ..sources import lists as L

    df = derived(spark, sf_dir, "SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN 'f.k.a.' WHEN 1 THEN ' A.K.A. ' WHEN 2 THEN 'Good' WHEN 3 THEN ' low' ELSE 'Good quality' END AS said, CASE c_custkey % 3 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'false' END AS strong FROM customer")
    said = F.col("said")
    return df.select("id", L.un_alias_type(said).alias("un_type"), L.alias_quality(L.UN_QUALITY, said).alias("un_quality"), L.alias_quality(L.EU_QUALITY, F.col("strong")).alias("eu_quality"), L.alias_quality(L.UK_QUALITY, said).alias("uk_quality"))


@query("b05_compact_ids", f"SELECT rid, upper(regexp_replace(value, '[\\s\\-./]', '', 'g')) AS norm FROM ({IDENTIFIERS})")
def b05(spark, sf_dir):
    return derived(spark, sf_dir, IDENTIFIERS).select("rid", T.compact(F.col("value")).alias("norm"))


@query("b08_mmsi", f"SELECT rid, regexp_full_match(value, '\\d{{9}}') AS ok FROM ({IDENTIFIERS})")
def b08(spark, sf_dir):
    return derived(spark, sf_dir, IDENTIFIERS).select("rid", T.mmsi_ok(F.col("value")).alias("ok"))


_FORMS = ",".join(f"'{f}'" for f in T.LEGAL_FORMS)


@query("b11_core_names", f"SELECT p_partkey, array_to_string(list_filter(string_split(p_name || CASE WHEN p_partkey % 2 = 0 THEN ' ltd' ELSE ' the holding co' END, ' '), lambda t: t NOT IN ({_FORMS})), ' ') AS core FROM part")
def b11(spark, sf_dir):
    return derived(spark, sf_dir, "SELECT p_partkey, p_name || CASE WHEN p_partkey % 2 = 0 THEN ' ltd' ELSE ' the holding co' END AS n FROM part").select("p_partkey", T.core_name(F.col("n")).alias("core"))


@query("b12_join_names", "SELECT c_custkey, trim(regexp_replace(concat_ws(' ', nullif(trim(c_name), ''), nullif(trim(CASE WHEN c_custkey % 2 = 0 THEN '  ' ELSE ' x  y ' END), ''), c_mktsegment), '\\s+', ' ', 'g')) AS full_name FROM customer")
def b12(spark, sf_dir):
    df = derived(spark, sf_dir, "SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN '  ' ELSE ' x  y ' END AS mid FROM customer")
    return df.select("c_custkey", T.join_name(F.col("c_name"), F.col("mid"), F.col("c_mktsegment")).alias("full_name"))


_any = lambda ws: " OR ".join(f"contains(low, '{w}')" for w in ws)
NOTICE_TEXT = "SELECT doc_id, text || CASE doc_id % 5 WHEN 0 THEN ' The entry was removed.' WHEN 1 THEN ' Designation added' WHEN 2 THEN ' amendment and delisting' ELSE '' END AS text FROM documents"


@query("b15_action_kinds", f"SELECT doc_id, concat_ws(',', CASE WHEN {_any(T.DELIST_WORDS)} THEN 'DELISTING' END, CASE WHEN {_any(T.LIST_WORDS)} THEN 'LISTING' END, CASE WHEN {_any(T.AMEND_WORDS)} THEN 'AMENDMENT' END) AS actions FROM (SELECT doc_id, lower(text) AS low FROM ({NOTICE_TEXT}))")
def b15(spark, sf_dir):
    return derived(spark, sf_dir, NOTICE_TEXT).select("doc_id", F.array_join(T.classify_actions(F.col("text")), ",").alias("actions"))


@query(
    "b16_link_types",
    f"WITH t AS (SELECT doc_id, text, instr(text, ' the ') AS i FROM ({NOTICE_TEXT})), w AS (SELECT doc_id, CASE WHEN i > 0 THEN lower(substr(text, greatest(i - 301, 0)::INT + 1, (i - 1 + 300 - greatest(i - 301, 0))::INT)) ELSE '' END AS low FROM t) SELECT doc_id, CASE WHEN {_any(T.DELIST_WORDS)} THEN 'DELISTING' WHEN {_any(T.AMEND_WORDS)} THEN 'AMENDMENT' WHEN {_any(T.LIST_WORDS)} THEN 'LISTING' ELSE 'REFERENCE' END AS link_type FROM w",
)
def b16(spark, sf_dir):
    return derived(spark, sf_dir, NOTICE_TEXT).select("doc_id", T.link_type_near(F.col("text"), F.lit(" the "), F.array().cast("array<string>")).alias("link_type"))


@query(
    "b17_quotes",
    f"WITH t AS (SELECT doc_id, text, instr(lower(text), 'removed') AS i FROM ({NOTICE_TEXT})) SELECT doc_id, CASE WHEN i > 0 THEN trim(regexp_replace(substr(text, greatest(i - 121, 0)::INT + 1, (i - 1 + 7 + 120 - greatest(i - 121, 0))::INT), '\\s+', ' ', 'g')) END AS quote FROM t",
)
def b17(spark, sf_dir):
    return derived(spark, sf_dir, NOTICE_TEXT).select("doc_id", T.quote(F.col("text"), F.lit("removed")).alias("quote"))


@query("b18_list_codes", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'SDN' WHEN s_suppkey % 3 = 1 THEN 'AB-C' END AS code FROM supplier")
def b18(spark, sf_dir):
    df = derived(spark, sf_dir, "SELECT s_suppkey, s_name || CASE s_suppkey % 3 WHEN 0 THEN ' (SDN) - x' WHEN 1 THEN ' list (AB-C)' ELSE ' (sdn)' END AS src FROM supplier")
    return df.select("s_suppkey", T.list_code(F.col("src")).alias("code"))


def _gone(sql: str, pattern: str, to: str = "''") -> str:
    return f"regexp_replace({sql}, '{pattern}', {to}, 'g')"


_VISIBLE = _gone("html", "(?is)<!--.*?-->")
for _tag in ("script", "style", "nav", "header", "footer", "noscript"):
    _VISIBLE = _gone(_VISIBLE, rf"(?is)<{_tag}\b[^>]*>.*?</{_tag}\s*>")
_VISIBLE = _gone(_gone(_VISIBLE, r"(?i)</(?:p|div|li|tr|td|th|h[1-6]|section|article|table|ul|ol|dt|dd)\s*>|<br\s*/?>", "chr(10)"), "(?s)<[^>]*>")
for _from, _to in (("lt", 60), ("gt", 62), ("quot", 34), ("#39", 39), ("nbsp", 160), ("amp", 38)):
    _VISIBLE = f"replace({_VISIBLE}, '&{_from};', chr({_to}))"
_VISIBLE = _gone(_gone(_VISIBLE, r"\n\s*\n+", "chr(10) || chr(10)"), r"[ \t\r\f\x0B]+", "' '")


@query("b14_html_text", f"SELECT page_id, sha256(t) AS text_sha256, CAST(length(t) AS INT) AS n_chars FROM (SELECT page_id, trim({_VISIBLE}, chr(32) || chr(9) || chr(10) || chr(13) || chr(160)) AS t FROM pages)")
def b14(spark, sf_dir):
    text = T.html_to_text(F.col("html"))
    return derived(spark, sf_dir, "SELECT page_id, html FROM pages").select("page_id", text.alias("text")).select("page_id", F.sha2("text", 256).alias("text_sha256"), F.length("text").alias("n_chars"))


@query(
    "b19_date_periods",
    "WITH r AS (SELECT o_orderkey AS id, o_orderkey % 4 AS k, o_orderdate::DATE AS d, year(o_orderdate)::INT AS y FROM orders) SELECT id, CASE k WHEN 0 THEN d WHEN 1 THEN date_trunc('month', d)::DATE END AS date_value, CASE WHEN k < 3 THEN y END AS year, CASE WHEN k = 3 THEN y END AS year_from, CASE WHEN k = 3 THEN y + 2 END AS year_to, CASE k WHEN 0 THEN 'DAY' WHEN 1 THEN 'MONTH' WHEN 2 THEN 'YEAR' ELSE 'RANGE' END AS precision FROM r",
)
def b19(spark, sf_dir):
    df = derived(spark, sf_dir, "SELECT o_orderkey AS id, o_orderkey % 4 AS k, CAST(o_orderdate AS DATE) AS d FROM orders")
    k, d = F.col("k"), F.col("d")
    part = lambda y, m, x: F.struct(y.cast("int").alias("year"), m.cast("int").alias("month"), x.cast("int").alias("day"))
    start = part(F.year(d), F.when(k == 2, 1).when(k < 2, F.month(d)), F.when(k == 0, F.dayofmonth(d)).when(k < 3, 1))
    end = part(F.year(d) + F.when(k == 3, 2).otherwise(0), F.when(k == 2, 12).when(k < 2, F.month(d)), F.when(k == 0, F.dayofmonth(d)).when(k == 1, F.dayofmonth(F.last_day(d))).when(k == 2, 31))
    p = D.period_partial(start, end, F.lit(False))
    return df.select("id", p.alias("p")).select("id", *[f"p.{c}" for c in ("date_value", "year", "year_from", "year_to", "precision")])


_DOCS = "SELECT c_custkey, list({'name_type': t, 'full_name': n} ORDER BY i) AS names FROM (SELECT c_custkey, 1 AS i, CASE WHEN c_custkey % 3 = 0 THEN 'PRIMARY' ELSE 'ALIAS' END AS t, c_name AS n FROM customer UNION ALL SELECT c_custkey, 2, CASE WHEN c_custkey % 3 = 1 THEN 'PRIMARY' ELSE 'ALIAS' END, c_mktsegment FROM customer) GROUP BY 1"


@query("b22_primary_names", f"SELECT c_custkey, coalesce(list_filter(names, lambda n: n.name_type = 'PRIMARY')[1].full_name, names[1].full_name, '') AS primary_name FROM ({_DOCS})")
def b22(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT c_custkey, 1 AS i, CASE WHEN c_custkey % 3 = 0 THEN 'PRIMARY' ELSE 'ALIAS' END AS name_type, c_name AS full_name FROM customer UNION ALL SELECT c_custkey, 2, CASE WHEN c_custkey % 3 = 1 THEN 'PRIMARY' ELSE 'ALIAS' END, c_mktsegment FROM customer")
    docs = rows.groupBy("c_custkey").agg(F.array_sort(F.collect_list(F.struct("i", "name_type", "full_name"))).alias("names"))
    return docs.select("c_custkey", T.primary_name(F.col("names")).alias("primary_name"))


@query("b23_content_hashes", "SELECT c_custkey, sha256('{\"c_custkey\":' || c_custkey || ',\"c_name\":\"' || c_name || '\",\"c_mktsegment\":' || CASE WHEN c_custkey % 2 = 0 THEN 'null' ELSE '\"' || c_mktsegment || '\"' END || '}') AS content_hash FROM customer")
def b23(spark, sf_dir):
    df = derived(spark, sf_dir, "SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
    return df.select("c_custkey", T.content_hash("c_custkey", "c_name", "c_mktsegment").alias("content_hash"))


@query("b24_act_references", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN regexp_extract('CELEX:3' || o_custkey || 'R&q', 'CELEX[:%3A]*([0-9A-Z]+)', 1) ELSE 'ext' || o_orderkey END AS act FROM orders")
def b24(spark, sf_dir):
    df = derived(spark, sf_dir, "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'https://x/?uri=CELEX:3' || o_custkey || 'R&q' ELSE 'https://x/y' END AS url, 'ext' || o_orderkey AS ext FROM orders")
    return df.select("o_orderkey", T.act_from_notice(F.col("url"), F.col("ext")).alias("act"))


RAW = "SELECT o_orderkey AS pos, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_custkey END AS source_key, CASE WHEN o_orderkey % 17 = 0 THEN ' ' ELSE o_orderpriority END AS name FROM orders"


@query("c01_required_fields", f"SELECT CASE WHEN source_key IS NULL THEN 'missing key' WHEN trim(name) = '' THEN 'missing name' END AS reason, count(*) AS n FROM ({RAW}) WHERE source_key IS NULL OR trim(name) = '' GROUP BY 1")
def c01(spark, sf_dir):
    _, bad = FL.required(derived(spark, sf_dir, RAW), {"missing key": F.col("source_key").isNull(), "missing name": T.clean(F.col("name")).isNull()})
    return bad.groupBy("reason").agg(F.count("*").alias("n"))


@query("c02_first_kept", f"SELECT source_key, min(pos) AS pos, count(*) - 1 AS duplicates FROM ({RAW}) WHERE source_key IS NOT NULL GROUP BY 1")
def c02(spark, sf_dir):
    return FL.first_kept(derived(spark, sf_dir, RAW).where("source_key IS NOT NULL"), ["source_key"], "pos").select("source_key", "pos", "duplicates")


@query("c03_keywords", "SELECT doc_id FROM documents WHERE contains(lower(source || ' ' || text), 'tion than') OR contains(lower(source || ' ' || text), 'src7')")
def c03(spark, sf_dir):
    df = derived(spark, sf_dir, "SELECT doc_id, source, text FROM documents")
    return df.where(FL.keyword_keep(F.concat_ws(" ", "source", "text"), ["tion THAN", "SRC7"])).select("doc_id")


@query("c04_newest_after_cutoff", "SELECT o_orderkey FROM orders WHERE o_orderdate IS NULL OR o_orderdate::DATE >= DATE '2000-01-01' - 30 ORDER BY o_orderdate DESC NULLS LAST, o_orderkey LIMIT 200")
def c04(spark, sf_dir):
    df = derived(spark, sf_dir, "SELECT o_orderkey, o_orderdate FROM orders")
    return FL.newest(df, "o_orderdate", F.to_date(F.lit("2000-01-01")), 30, 200, F.col("o_orderkey")).select("o_orderkey")


@query("c06_optional_filters", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1")
def c06(spark, sf_dir):
    df = derived(spark, sf_dir, "SELECT * FROM orders")
    return FL.optional(df, o_orderpriority="1-URGENT", o_orderstatus=None).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("c07_search", "SELECT doc_id, lang FROM documents WHERE text ILIKE '%the than%' OR source ILIKE '%the than%' ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT 30")
def c07(spark, sf_dir):
    df = derived(spark, sf_dir, "SELECT * FROM documents")
    return FL.search(df, "THE than", ["text", "source"], 30, F.col("n_chars").desc_nulls_last(), F.col("doc_id")).select("doc_id", "lang")
