"""Registered queries: readers (section A), over files that Spark writes from the tables to the shared folder first."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..session import new_path
from ..sources import canonical as C
from ..sources import feeds as FD
from ..sources import landing as LD
from ..sources import lists as L
from .derive import derived
from .registry import query

_COUNTRY = "CASE c_nationkey % 3 WHEN 0 THEN 'France' WHEN 1 THEN 'Iran (Islamic Republic of)' ELSE 'Atlantis' END"
_ISO = "CASE c_nationkey % 3 WHEN 0 THEN 'FR' WHEN 1 THEN 'IR' END"


#: Elements of one landed file. An XML file is read by one task, so a longer list lands in more files, not in longer ones.
FILE_ROWS = 20_000


def _dealt(df):
    return df.repartition(max(1, -(-df.count() // FILE_ROWS)))


def _xml(df, tag: str) -> str:
    path = new_path(df.sparkSession, "landed-xml")
    _dealt(df).write.format("xml").option("rootTag", "LIST").option("rowTag", tag).option("attributePrefix", "_").option("valueTag", "_VALUE").save(path)
    return path


@query("a01_a03_un_list", f"SELECT 'QQi.' || c_custkey AS source_key, c_name AS primary_name, {_ISO} AS country, CASE WHEN c_custkey % 2 = 0 THEN 'DAY' ELSE 'RANGE' END AS precision, CASE WHEN c_custkey % 3 = 0 THEN 'WEAK' ELSE 'STRONG' END AS alias_quality FROM customer")
def a03(spark, sf_dir):
    src = derived(spark, sf_dir, f"SELECT c_custkey, c_name, c_mktsegment, {_COUNTRY} AS country FROM customer")
    k, s = F.col("c_custkey"), lambda c: c.cast("string")
    rows = src.select(
        s(k).alias("DATAID"), F.col("c_name").alias("FIRST_NAME"), F.concat(F.lit("QQi."), s(k)).alias("REFERENCE_NUMBER"), F.struct(F.array("country").alias("VALUE")).alias("NATIONALITY"),
        F.array(F.struct(F.when(k % 3 == 0, "Low").otherwise("Good").alias("QUALITY"), F.col("c_mktsegment").alias("ALIAS_NAME"))).alias("INDIVIDUAL_ALIAS"),
        F.array(F.struct(F.when(k % 2 == 0, "EXACT").otherwise("BETWEEN").alias("TYPE_OF_DATE"), F.when(k % 2 == 0, "1970-01-02").alias("DATE"), F.when(k % 2 == 1, "1960").alias("FROM_YEAR"), F.when(k % 2 == 1, "1962").alias("TO_YEAR"))).alias("INDIVIDUAL_DATE_OF_BIRTH"),
    )
    out, _ = C.split_rejects(L.un_list(spark, _xml(rows, "INDIVIDUAL"), C.iso_lookup(spark)))
    at = lambda a, i: F.get(F.col(a), F.lit(i))
    return out.select("source_key", T.primary_name(F.col("names")).alias("primary_name"), at("countries", 0)["country_iso2"].alias("country"), at("birth_dates", 0)["precision"].alias("precision"), at("names", 1)["quality"].alias("alias_quality"))


@query("a02_file_headers", "SELECT strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS publication_marker, max(o_orderdate)::DATE AS published_on FROM orders GROUP BY o_custkey % 20")
def a02(spark, sf_dir):
    """Files of two publishers: one names its date in a root attribute, the other in a leaf."""
    items = derived(spark, sf_dir, "SELECT o_custkey % 20 AS f, max(date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")) AS at, concat_ws('', collect_list(concat('<R><K>', o_orderkey, '</K></R>'))) AS body FROM orders GROUP BY 1")
    head = F.when(F.col("f") % 2 == 0, F.concat(F.lit('<LIST dateGenerated="'), "at", F.lit('">'))).otherwise(F.concat(F.lit("<LIST><DateGenerated>"), "at", F.lit("</DateGenerated>")))
    path = new_path(spark, "landed-headers")
    items.select("f", F.concat(head, "body", F.lit("</LIST>")).alias("value")).repartition("f").write.partitionBy("f").text(path)
    return C.header(spark, path, "LIST", ("_dateGenerated", "DateGenerated")).select("publication_marker", F.to_date("published_at").alias("published_on"))


_UK_KIND = "CASE c_mktsegment WHEN 'MACHINERY' THEN 'VESSEL' WHEN 'BUILDING' THEN 'ORGANIZATION' ELSE 'PERSON' END"


@query(
    "a04_uk_list",
    f"SELECT 'UK' || c_custkey AS source_key, {_UK_KIND} AS entity_type, c_name AS primary_name, CASE c_custkey % 3 WHEN 0 THEN 'WEAK' WHEN 1 THEN 'STRONG' ELSE 'UNKNOWN' END AS alias_quality, DATE '2020-02-01' + (c_custkey % 28)::INT AS listed_on, "
    "CASE c_custkey % 3 WHEN 0 THEN 'ASSET_FREEZE,TRAVEL_BAN' WHEN 1 THEN 'ASSET_FREEZE' ELSE 'ARMS_EMBARGO' END AS measures, CASE c_nationkey % 3 WHEN 0 THEN 'FR' WHEN 1 THEN 'IR' END AS country, CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'BUILDING') THEN CASE WHEN c_custkey % 2 = 0 THEN 'DAY' ELSE 'YEAR' END END AS precision, "
    "CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey % 2 = 0 END AS imo_valid, CASE WHEN c_mktsegment = 'MACHINERY' THEN 1990 + (c_custkey % 30)::INT END AS build_year FROM customer",
)
def a04(spark, sf_dir):
    src = derived(spark, sf_dir, f"SELECT c_custkey, c_name, c_mktsegment, {_COUNTRY} AS country, {_UK_KIND} AS kind FROM customer")
    k, lit = F.col("c_custkey"), F.lit
    text_ = lambda c: c.cast("string")
    ship, person = F.col("kind") == "VESSEL", F.col("kind") == "PERSON"
    name = lambda v, t, q: F.struct(v.alias("Name6"), lit(t).alias("NameType"), q.alias("AliasStrength"))
    rows = src.select(
        F.concat(lit("UK"), k).alias("UniqueID"), F.when(ship, "Ship").when(person, "Individual").otherwise("Entity").alias("IndividualEntityShip"), F.date_format(F.date_add(F.to_date(lit("2020-02-01")), (k % 28).cast("int")), "dd/MM/yyyy").alias("DateDesignated"),
        F.when(k % 3 == 2, "Arms embargo").alias("SanctionsImposed"),
        F.struct(F.array(name(lit("Other one"), "Alias", F.when(k % 3 == 0, "Low quality").when(k % 3 == 1, "Good quality")), name(F.col("c_name"), "Primary Name", lit(None).cast("string"))).alias("Name")).alias("Names"),
        F.when(k % 3 != 2, F.struct(lit("true").alias("AssetFreeze"), F.when(k % 3 == 0, "true").otherwise("false").alias("TravelBan"))).alias("SanctionsImposedIndicators"),
        F.struct(F.array(F.struct(lit("1 St").alias("AddressLine1"), F.col("country").alias("AddressCountry"))).alias("Address")).alias("Addresses"),
        F.when(person, F.struct(F.struct(F.struct(F.array(F.when(k % 2 == 0, "03/04/1965").otherwise("dd/mm/1965")).alias("DOB")).alias("DOBs")).alias("Individual"))).alias("IndividualDetails"),
        F.when(ship, F.struct(F.struct(F.struct(F.array(F.when(k % 2 == 0, "9074729").otherwise("9074728")).alias("IMONumber")).alias("IMONumbers"), F.struct(F.array(text_(1990 + k % 30)).alias("YearBuilt")).alias("YearBuilts")).alias("Ship"))).alias("ShipDetails"),
    )
    out, _ = C.split_rejects(L.uk_list(spark, _xml(rows, "Designation"), C.iso_lookup(spark)))
    at = lambda a, i: F.get(F.col(a), F.lit(i))
    return out.select(
        "source_key", "entity_type", T.primary_name(F.col("names")).alias("primary_name"), at("names", 1)["quality"].alias("alias_quality"), at("listings", 0)["listed_on"].alias("listed_on"), F.array_join(at("listings", 0)["measures"], ",").alias("measures"),
        at("addresses", 0)["country_iso2"].alias("country"), at("birth_dates", 0)["precision"].alias("precision"), F.get(F.filter("identifiers", lambda i: i["id_type"] == "IMO"), lit(0))["checksum_valid"].alias("imo_valid"), F.col("vessel.build_year").alias("build_year"),
    )


_SETS = """<ReferenceValueSets><AliasTypeValues><AliasType ID="1">A.K.A.</AliasType></AliasTypeValues><FeatureTypeValues><FeatureType ID="8">Birthdate</FeatureType><FeatureType ID="10">Location</FeatureType></FeatureTypeValues><CountryValues>{countries}</CountryValues>
<IDRegDocTypeValues><IDRegDocType ID="d1">Passport</IDRegDocType></IDRegDocTypeValues><PartySubTypeValues><PartySubType ID="1" PartyTypeID="4">Vessel</PartySubType><PartySubType ID="3" PartyTypeID="2">Unknown</PartySubType><PartySubType ID="4" PartyTypeID="1">Unknown</PartySubType></PartySubTypeValues>
<PartyTypeValues><PartyType ID="1">Individual</PartyType><PartyType ID="2">Entity</PartyType><PartyType ID="4">Transport</PartyType></PartyTypeValues><SanctionsTypeValues><SanctionsType ID="s1">Program</SanctionsType><SanctionsType ID="s2">Block</SanctionsType><SanctionsType ID="s3">Export ban</SanctionsType></SanctionsTypeValues>
<ListValues><List ID="l1">List One</List></ListValues><LegalBasisValues><LegalBasis ID="b1" LegalBasisShortRef="EO 1">EO 1</LegalBasis></LegalBasisValues><RelationTypeValues><RelationType ID="r1">Owned By</RelationType></RelationTypeValues><LocPartTypeValues><LocPartType ID="p1">CITY</LocPartType></LocPartTypeValues></ReferenceValueSets>"""


@query(
    "a06_normalised_list",
    f"WITH d AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 1) SELECT c_custkey::VARCHAR AS source_key, {_UK_KIND} AS entity_type, c_name AS primary_name, CASE WHEN c_custkey % 4 = 0 THEN 'WEAK' ELSE 'STRONG' END AS alias_quality, coalesce(n, 0) AS passports, "
    f"CASE c_nationkey % 3 WHEN 0 THEN 'FR' ELSE 'IR' END AS country, CASE WHEN c_custkey % 2 = 0 THEN 'DAY' ELSE 'YEAR' END AS precision, unnest(CASE WHEN c_custkey % 5 = 0 THEN ['P1', 'P2'] WHEN c_custkey % 5 = 1 THEN [NULL] ELSE ['P1'] END) AS program, CASE WHEN c_custkey % 3 = 0 THEN 'ASSET_FREEZE,EXPORT_RESTRICTION' ELSE 'ASSET_FREEZE' END AS measures, "
    f"make_date(2020, 1 + (c_custkey % 12)::INT, 4) AS listed_on, CASE WHEN c_custkey % 10 = 0 THEN (c_custkey + 1)::VARCHAR END AS owner FROM customer LEFT JOIN d ON k = c_custkey",
)
def a06(spark, sf_dir):
    from ..sources.advanced import advanced_list

    src = derived(spark, sf_dir, f"SELECT c_custkey, c_name, c_nationkey, {_UK_KIND} AS kind FROM customer")
    k, lit = F.col("c_custkey"), F.lit
    s = lambda c: c.cast("string")
    base = new_path(spark, "landed-normalised")

    def put(df, tag: str, name: str) -> None:
        _dealt(df).write.format("xml").option("rootTag", "PART").option("rowTag", tag).option("attributePrefix", "_").option("valueTag", "_VALUE").save(f"{base}/{name}")

    nations = derived(spark, sf_dir, "SELECT concat_ws('', collect_list(concat('<Country ID=\"c', n_nationkey, '\" ISO2=\"', CASE WHEN n_nationkey % 3 = 0 THEN 'FR' ELSE 'IR' END, '\">', n_name, '</Country>'))) AS x FROM nation")  # a dimension
    nations.select(F.replace(lit(_SETS), lit("{countries}"), F.col("x"))).write.text(f"{base}/sets")
    put(derived(spark, sf_dir, "SELECT n_nationkey FROM nation").select(F.concat(lit("L"), "n_nationkey").alias("_ID"), F.struct(F.concat(lit("c"), "n_nationkey").alias("_CountryID")).alias("LocationCountry"), F.array(F.struct(lit("p1").alias("_LocPartTypeID"), F.array(F.struct(lit("true").alias("_Primary"), lit("Town").alias("Value"))).alias("LocationPartValue"))).alias("LocationPart")), "Location", "locations")
    put(derived(spark, sf_dir, "SELECT o_custkey, o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH'").select(F.concat(lit("i"), "o_custkey").alias("_IdentityID"), lit("d1").alias("_IDRegDocTypeID"), F.concat(lit("P-"), "o_orderkey").alias("IDRegistrationNo")), "IDRegDocument", "documents")
    put(src.where(k % 10 == 0).select(s(k).alias("_From-ProfileID"), s(k + 1).alias("_To-ProfileID"), lit("r1").alias("_RelationTypeID"), lit("false").alias("_Former")), "ProfileRelationship", "relationships")
    act = lambda t, c=None: F.struct(lit(t).alias("_SanctionsTypeID"), lit(c).cast("string").alias("Comment"))
    acts = F.array(F.when(k % 5 != 1, act("s1", "P1")), F.when(k % 5 == 0, act("s1", "P2")), act("s2"), F.when(k % 3 == 0, act("s3")))
    when = F.struct(lit("2020").alias("Year"), s(1 + k % 12).alias("Month"), lit("4").alias("Day"))
    put(src.select(F.concat(lit("e"), k).alias("_ID"), s(k).alias("_ProfileID"), lit("l1").alias("_ListID"), F.array(F.struct(lit("b1").alias("_LegalBasisID"), when.alias("Date"))).alias("EntryEvent"), F.filter(acts, lambda x: x.isNotNull()).alias("SanctionsMeasure")), "SanctionsEntry", "entries")
    named = lambda v: F.array(F.struct(F.array(F.struct(F.struct(v.alias("_VALUE"), lit("g").alias("_NamePartGroupID")).alias("NamePartValue"))).alias("DocumentedNamePart")))
    alias = lambda v, first, low: F.struct(lit(first).alias("_Primary"), lit("1").alias("_AliasTypeID"), low.alias("_LowQuality"), named(v).alias("DocumentedName"))
    day = lambda m, d: F.struct(lit("1970").alias("Year"), m.alias("Month"), d.alias("Day"))
    point = lambda lo, hi: F.struct(lo.alias("From"), hi.alias("To"))
    lo, hi = day(lit("1"), lit("1")), day(F.when(k % 2 == 0, "1").otherwise("12"), F.when(k % 2 == 0, "1").otherwise("31"))
    born = F.struct(point(lo, hi).alias("Start"), point(lo, hi).alias("End"))
    no_loc, no_period = lit(None).cast("array<struct<_LocationID:string>>"), lit(None).cast("struct<Start:struct<From:struct<Year:string,Month:string,Day:string>,To:struct<Year:string,Month:string,Day:string>>,End:struct<From:struct<Year:string,Month:string,Day:string>,To:struct<Year:string,Month:string,Day:string>>>")
    feature = lambda t, loc, per: F.struct(lit(t).alias("_FeatureTypeID"), F.array(F.struct(loc.alias("VersionLocation"), per.alias("DatePeriod"))).alias("FeatureVersion"))
    profile = F.struct(
        s(k).alias("_ID"), F.when(F.col("kind") == "VESSEL", "1").when(F.col("kind") == "ORGANIZATION", "3").otherwise("4").alias("_PartySubTypeID"),
        F.array(F.struct(F.concat(lit("i"), k).alias("_ID"), lit("true").alias("_Primary"), F.array(alias(lit("Second"), "false", F.when(k % 4 == 0, "true").otherwise("false")), alias(F.col("c_name"), "true", lit("false"))).alias("Alias"))).alias("Identity"),
        F.array(feature("8", no_loc, born), feature("10", F.array(F.struct(F.concat(lit("L"), "c_nationkey").alias("_LocationID"))), no_period)).alias("Feature"),
    )
    put(src.select(s(k).alias("_FixedRef"), profile.alias("Profile")), "DistinctParty", "parties")
    out = advanced_list(spark, f"{base}/*", C.iso_lookup(spark))
    first = lambda a: F.get(F.col(a), lit(0))
    return out.select(
        "source_key", "entity_type", T.primary_name(F.col("names")).alias("primary_name"), F.get(F.col("names"), lit(1))["quality"].alias("alias_quality"), F.size(F.filter("identifiers", lambda i: i["id_type"] == "PASSPORT")).cast("long").alias("passports"),
        first("addresses")["country_iso2"].alias("country"), first("birth_dates")["precision"].alias("precision"), F.explode("listings").alias("l"), first("relationships")["target_source_key"].alias("owner"),
    ).select("source_key", "entity_type", "primary_name", "alias_quality", "passports", "country", "precision", F.col("l.program_code").alias("program"), F.array_join("l.measures", ",").alias("measures"), "l.listed_on", "owner")


@query("a08_curated_build", "WITH e AS (SELECT 'K' || (o_custkey % 200) AS entry_key, arg_max(CASE o_orderstatus WHEN 'F' THEN 'REMOVE' ELSE 'ADD' END, o_orderkey) AS op, max(o_orderkey) AS last FROM orders GROUP BY 1) SELECT lpad((last % 10000000)::VARCHAR, 7, '0') AS source_key, 'Ship ' || entry_key AS primary_name, 2::INT AS n_names, CASE WHEN last % 2 = 0 THEN 'IR' END AS flag, 'PORT_BAN' AS measure FROM e WHERE op <> 'REMOVE'")
def a08(spark, sf_dir):
    from ..operators import removals as R

    events = derived(spark, sf_dir, "SELECT o_orderkey AS change_id, 'K' || CAST(o_custkey % 200 AS VARCHAR(9)) AS entry_key, CASE o_orderstatus WHEN 'F' THEN 'REMOVE' ELSE 'ADD' END AS op FROM orders")
    active = R.apply_curated(events).select(F.lpad((F.col("change_id") % 10_000_000).cast("string"), 7, "0").alias("imo"), F.concat(F.lit("Ship "), "entry_key").alias("name"), F.when(F.col("change_id") % 2 == 0, "Iran").otherwise("Atlantis").alias("flag"), F.array(F.lit("Old name")).alias("aliases"))
    out = FD.curated_records(active, C.iso_lookup(spark), vessels=True)
    first = F.get(F.col("listings"), F.lit(0))
    return out.select("source_key", T.primary_name(F.col("names")).alias("primary_name"), F.size("names").alias("n_names"), F.col("vessel.flag_iso2").alias("flag"), F.get(first["measures"], F.lit(0)).alias("measure"))


@query("a10_notice_pages", "SELECT doc_id::VARCHAR AS external_id, 'Sanctions of ' || source AS title, DATE '2024-01-01' + (doc_id % 28)::INT AS published_on, sha256(text) AS text_sha FROM documents WHERE doc_id % 3 = 0")
def a10(spark, sf_dir):
    src = derived(spark, sf_dir, "SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 THEN text ELSE 'nothing' END AS text FROM documents")
    k = F.col("doc_id")
    one = F.struct(k.cast("string").alias("id"), F.concat(F.when(k % 3 == 0, "Sanctions of ").otherwise("Notes of "), "source").alias("t"), F.concat(F.date_add(F.to_date(F.lit("2024-01-01")), (k % 28).cast("int")).cast("string"), F.lit("T00:00:00Z")).alias("d"), F.col("text").alias("b"))
    pages = src.groupBy(F.floor(k / 50).alias("f")).agg(F.to_json(F.struct(F.collect_list(one).alias("results"))).alias("value"))
    path = new_path(spark, "landed-pages")
    pages.repartition("f").write.partitionBy("f").text(path)
    out = FD.notice_pages(spark, path, {"external_id": "id", "title": "t", "published": "d", "text": "b"}, "sanction")
    return out.select("external_id", "title", "published_on", F.sha2("text", 256).alias("text_sha"))


@query("a17_curated_import", "SELECT 'Ship ' || s_suppkey AS name, CASE s_suppkey % 4 WHEN 0 THEN '9074729' WHEN 1 THEN '9074728' END AS imo, CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 0 END::INT AS n_aliases, CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'IMO fails its check digit' ELSE 'IMO is missing' END AS problems, s_suppkey % 4 = 0 AS ok FROM supplier")
def a17(spark, sf_dir):
    path = new_path(spark, "landed-curated")
    src = derived(spark, sf_dir, "SELECT concat(' Ship ', s_suppkey) AS `Name`, CASE s_suppkey % 4 WHEN 0 THEN 'IMO 9074729' WHEN 1 THEN '9074728' WHEN 2 THEN '123' END AS ` IMO`, 'Iran' AS Flag, CASE WHEN s_suppkey % 3 = 0 THEN ' A; B;' END AS Aliases FROM supplier")
    src.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return FD.curated_csv(spark, path, needs_imo=True).select("name", "imo", F.size("aliases").alias("n_aliases"), F.array_join("problems", "; ").alias("problems"), "ok")


@query("a05_eu_list", f"SELECT c_custkey::VARCHAR AS source_key, c_name AS primary_name, {_ISO} AS country, unnest(CASE WHEN c_custkey % 4 = 0 THEN ['AAA', 'BBB'] ELSE ['BBB'] END) AS programme, 'R' || CASE WHEN c_custkey % 4 = 0 THEN 2 ELSE 1 END AS legal_basis FROM customer")
def a05(spark, sf_dir):
    src = derived(spark, sf_dir, f"SELECT c_custkey, c_name, {_COUNTRY} AS country FROM customer")
    k = F.col("c_custkey")
    reg = lambda n, p, d: F.struct(F.lit(n).alias("_numberTitle"), F.lit(p).alias("_programme"), F.lit(d).alias("_publicationDate"), F.lit("u").alias("publicationUrl"))
    rows = src.select(
        k.cast("string").alias("_logicalId"), F.struct(F.lit("person").alias("_code")).alias("subjectType"),
        F.when(k % 4 == 0, F.array(reg("R1", "BBB", "2020-01-01"), reg("R2", "AAA", "2019-01-01"))).otherwise(F.array(reg("R1", "BBB", "2020-01-01"))).alias("regulation"),
        F.array(F.struct(F.col("c_name").alias("_wholeName"), F.lit("true").alias("_strong"))).alias("nameAlias"), F.array(F.struct(F.lit("00").alias("_countryIso2Code"), F.col("country").alias("_countryDescription"))).alias("citizenship"),
    )
    out, _ = C.split_rejects(L.eu_list(spark, _xml(rows, "sanctionEntity"), C.iso_lookup(spark)))
    return out.select("source_key", T.primary_name(F.col("names")).alias("primary_name"), F.get(F.col("countries"), F.lit(0))["country_iso2"].alias("country"), F.explode("listings").alias("l")).select("source_key", "primary_name", "country", F.col("l.program_code").alias("programme"), "l.legal_basis")


@query("a07_csl_list", "SELECT CASE WHEN p_partkey % 2 = 0 THEN 'EL' ELSE 'DPL' END AS code, p_partkey::VARCHAR AS source_key, trim(p_name) AS primary_name, CASE WHEN p_partkey % 2 = 0 THEN 'LICENSE_REQUIREMENT' ELSE 'DENIAL_OF_EXPORT_PRIVILEGES' END AS measure FROM part WHERE p_partkey % 3 <> 0")
def a07(spark, sf_dir):
    src = derived(spark, sf_dir, "SELECT p_partkey, p_name FROM part")
    k = F.col("p_partkey")
    one = F.struct(k.cast("string").alias("id"), F.when(k % 3 == 0, "Other (SDN)").when(k % 2 == 0, "Entity List (EL) - X").otherwise("Denied (DPL)").alias("source"), F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("name"), F.lit("Entity").alias("type"))
    docs = src.groupBy(F.floor(k / 100)).agg(F.to_json(F.struct(F.collect_list(one).alias("results"))).alias("value")).select("value")  # one document a file
    path = new_path(spark, "landed-json")
    docs.withColumn("f", F.xxhash64("value")).repartition("f").write.partitionBy("f").text(path)
    out, _ = C.split_rejects(L.csl_list(spark, path, C.iso_lookup(spark)))
    first = F.get(F.col("listings"), F.lit(0))
    return out.select(first["program_code"].alias("code"), "source_key", T.primary_name(F.col("names")).alias("primary_name"), F.get(first["measures"], F.lit(0)).alias("measure"))


@query("a09_feed_items", "SELECT 'g' || o_orderkey AS external_id, o_orderpriority AS title, o_orderdate::DATE AS published_on FROM orders")
def a09(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT concat('g', o_orderkey) AS guid, o_orderpriority AS title, concat(date_format(o_orderdate, 'EEE, d MMM yyyy'), ' 06:00:00 GMT') AS pubDate FROM orders")
    return FD.rss(spark, _xml(rows, "item")).select("external_id", "title", F.to_date("published_at").alias("published_on"))


@query("a11_action_links", "SELECT strftime(o_orderdate, '%Y%m%d') AS external_id, o_orderdate::DATE AS published_on FROM orders GROUP BY ALL")
def a11(spark, sf_dir):
    pages = derived(spark, sf_dir, "SELECT concat('<a href=\"/recent-actions/', date_format(o_orderdate, 'yyyyMMdd'), CASE WHEN o_orderkey % 2 = 0 THEN '_33' ELSE '' END, '\">x</a>') AS html FROM orders")
    return FD.action_links(pages, "html")


@query("a12_registry_rows", "SELECT p_partkey::VARCHAR AS n_number, p_name AS name, CASE WHEN p_size > 25 THEN p_brand END AS brand FROM part")
def a12(spark, sf_dir):
    path = new_path(spark, "landed-csv")
    derived(spark, sf_dir, "SELECT concat(' ', p_partkey) AS `N-NUMBER `, concat(p_name, '  ') AS ` NAME`, CASE WHEN p_size > 25 THEN p_brand ELSE ' ' END AS BRAND FROM part").write.option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    r = FD.registry_csv(spark, path)
    return r.select(F.col("`N-NUMBER`").alias("n_number"), F.col("NAME").alias("name"), F.col("BRAND").alias("brand"))


@query("a14_malformed_shares", "SELECT round(avg(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END), 4) AS share, avg(CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) > 0.1 AS fails FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 500)")
def a14(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT o_orderkey AS pos, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS name FROM orders")
    return LD.malformed_share(rows, ["name"], "pos")


@query("a16_staged_partitions", "SELECT o_orderstatus AS source_id, CAST(o_orderkey % 3 AS INT) AS seq, count(*) AS n, sum(CASE WHEN o_orderkey % 3 = 1 THEN 1 ELSE 0 END)::BIGINT AS rewritten FROM orders GROUP BY 1, 2")
def a16(spark, sf_dir):
    rows = derived(spark, sf_dir, "SELECT o_orderkey AS source_key, o_orderstatus AS source_id, CAST(o_orderkey % 3 AS INT) AS seq, false AS again FROM orders")
    path = new_path(spark, "staging")
    LD.stage(rows, path, "source_id", "seq")
    LD.stage(rows.where("seq = 1").withColumn("again", F.lit(True)), path, "source_id", "seq")  # a rerun replaces its partitions alone
    staged = spark.read.schema("source_key long, again boolean, source_id string, seq int").parquet(path)
    return staged.groupBy("source_id", "seq").agg(F.count("*").alias("n"), F.count_if("again").alias("rewritten"))
