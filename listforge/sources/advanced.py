"""Reader of the normalised list file: reference sets, locations, documents, relationships and entries joined to parties.

Each part of the file is one scan by row tag. Reference sets and locations are small dimensions and are joined by broadcast;
documents, relationships and entries are grouped by their owner and joined once. Ids within the file are unique.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..session import durable
from . import canonical as C

# The reference sets that are read, and vocabularies.
SETS = ("AliasType", "NamePartType", "FeatureType", "DetailReference", "Country", "IDRegDocType", "EntryEventType", "LegalBasis", "SanctionsType", "List", "RelationType", "PartySubType", "PartyType", "LocPartType", "Script")
ALIAS_TYPES = {"a.k.a.": "AKA", "f.k.a.": "FKA", "n.k.a.": "NKA"}
PARTY_TYPES = {"individual": "PERSON", "entity": "ORGANIZATION", "vessel": "VESSEL", "aircraft": "AIRCRAFT"}
YMD = "struct<Year:string,Month:string,Day:string>"
POINT = f"struct<_Approximate:string,From:{YMD},To:{YMD}>"
PERIOD = f"struct<Start:{POINT},End:{POINT}>"


def references(spark: SparkSession, path: str) -> DataFrame:
    """(set, id, text, parent, iso2): items of the reference sets, which all stand in one element."""
    item = "array<struct<_ID:string,_VALUE:string,_ISO2:string,_PartyTypeID:string,_LegalBasisShortRef:string>>"
    whole = C.xml(spark, path, "ReferenceValueSets", ", ".join(f"{s}Values struct<{s}:{item}>" for s in SETS))
    sets = F.array(*[F.struct(F.lit(s).alias("set"), F.col(f"{s}Values.{s}").alias("items")) for s in SETS])
    one = whole.select(F.explode(sets).alias("s")).select("s.set", F.explode("s.items").alias("i")).where("i._ID IS NOT NULL")
    named = F.coalesce(C.text(F.col("i._VALUE")), C.text(F.col("i._LegalBasisShortRef")))
    return one.select("set", F.col("i._ID").alias("id"), named.alias("text"), F.col("i._PartyTypeID").alias("parent"), F.col("i._ISO2").alias("iso2"))


def measure(kind: Column) -> Column:
    """Measure behind a sanctions type's name."""
    t = F.lower(kind)
    has = lambda *ws: reduce(lambda a, b: a | b, [t.contains(w) for w in ws])
    return (
        F.when((t == "block") | t.contains("blocking"), "ASSET_FREEZE")
        .when(has("directive", "sectoral", "capta", "correspondent", "menu", "cmic", "military-industrial"), "SECTORAL")
        .when(t.contains("export"), "EXPORT_RESTRICTION").when(t.contains("procurement"), "PROCUREMENT_BAN").otherwise("OTHER")
    )


def period(p: Column) -> Column:
    """Structured period to a partial date: from the first day it may mean to the last."""
    point = lambda y: F.struct(y["Year"].try_cast("int").alias("year"), y["Month"].try_cast("int").alias("month"), y["Day"].try_cast("int").alias("day"))
    return D.period_partial(point(p["Start"]["From"]), point(F.coalesce(p["End"]["To"], p["Start"]["To"], p["Start"]["From"])), F.coalesce(p["Start"]["_Approximate"] == "true", F.lit(False)))


def advanced_list(spark: SparkSession, path: str, iso: C.Iso) -> DataFrame:
    """Canonical records of the file."""
    ref = durable(references(spark, path), "reference-sets")  # a small dimension that is joined a dozen times; each read would scan the file
    look = lambda s, alias: F.broadcast(ref.where(F.col("set") == s).select(F.col("id").alias(f"{alias}_id"), F.col("text").alias(alias)))
    c = F.col

    loc = C.xml(spark, path, "Location", "_ID string, LocationCountry struct<_CountryID:string>, LocationPart array<struct<_LocPartTypeID:string,LocationPartValue:array<struct<_Primary:string,Value:string>>>>").where("_ID IS NOT NULL")
    pieces = loc.select("_ID", F.explode_outer("LocationPart").alias("p")).select("_ID", c("p._LocPartTypeID").alias("t"), F.get(C.texts(F.transform("p.LocationPartValue", lambda v: v["Value"])), F.lit(0)).alias("v"))
    cells = pieces.join(look("LocPartType", "part"), c("t") == c("part_id"), "left").groupBy("_ID").agg(*[F.max(F.when(F.lower("part") == k, c("v"))).alias(n) for k, n in (("address1", "a1"), ("address2", "a2"), ("city", "city"), ("state/province", "region"), ("postal code", "postal"))])
    country = F.broadcast(ref.where("set = 'Country'").select(F.col("id").alias("country_id"), F.col("text").alias("country_raw"), "iso2"))
    places = loc.select("_ID", c("LocationCountry._CountryID").alias("cid")).join(cells, "_ID").join(country, c("cid") == c("country_id"), "left")
    places = places.select(c("_ID").alias("location_id"), C.address(iso, c("country_raw"), T.join_name(c("a1"), c("a2")), c("city"), c("region"), c("postal"), code=c("iso2")).alias("address"))

    docs = C.xml(spark, path, "IDRegDocument", "_IdentityID string, _IDRegDocTypeID string, `_IssuedBy-CountryID` string, IDRegistrationNo string").where("_IdentityID IS NOT NULL")
    docs = docs.withColumn("pos", F.monotonically_increasing_id()).join(look("IDRegDocType", "doc_type"), c("_IDRegDocTypeID") == c("doc_type_id"), "left").join(country, c("_IssuedBy-CountryID") == c("country_id"), "left")
    one = C.ident(c("doc_type"), c("IDRegistrationNo"), iso, country=c("country_raw"))
    docs = docs.select("_IdentityID", "pos", F.when(one.isNotNull(), one.withField("country_iso2", F.coalesce(one["country_iso2"], c("iso2")))).alias("ident")).where("ident IS NOT NULL")
    docs = docs.groupBy(c("_IdentityID").alias("identity_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "ident"))), lambda x: x["ident"]).alias("documents"))

    rels = C.xml(spark, path, "ProfileRelationship", "`_From-ProfileID` string, `_To-ProfileID` string, _RelationTypeID string, _Former string").where("`_From-ProfileID` IS NOT NULL")
    rels = rels.join(look("RelationType", "rel"), c("_RelationTypeID") == c("rel_id"), "left").groupBy(c("`_From-ProfileID`").alias("profile_id")).agg(
        F.array_sort(F.collect_list(C.fill(C.RELATION, rel_type=F.coalesce("rel", F.lit("RELATED")), target_source_key=c("`_To-ProfileID`"), raw=F.concat(F.when(c("_Former") == "true", "former ").otherwise(""), F.coalesce("rel", F.lit("")))))).alias("relationships")
    )

    entry = C.xml(spark, path, "SanctionsEntry", f"_ID string, _ProfileID string, _ListID string, EntryEvent array<struct<_LegalBasisID:string,Date:{YMD}>>, SanctionsMeasure array<struct<_SanctionsTypeID:string,Comment:string>>").where("_ProfileID IS NOT NULL").withColumn("eid", F.monotonically_increasing_id())
    acts = entry.select("eid", F.posexplode_outer("SanctionsMeasure").alias("pos", "m")).join(look("SanctionsType", "kind"), c("m._SanctionsTypeID") == c("kind_id"), "left")
    acts = acts.groupBy("eid").agg(
        F.array_sort(F.collect_set(F.when(F.lower("kind") != "program", measure(c("kind"))))).alias("measures"),
        F.transform(F.array_sort(F.collect_list(F.when((F.lower("kind") == "program") & C.text(c("m.Comment")).isNotNull(), F.struct("pos", c("m.Comment").alias("p"))))), lambda x: x["p"]).alias("programs"),
    )
    day = lambda d: D.safe_date(d["Year"].try_cast("int"), d["Month"].try_cast("int"), d["Day"].try_cast("int"))
    entry = entry.withColumn("basis_id", F.get(F.filter(F.transform("EntryEvent", lambda e: e["_LegalBasisID"]), lambda x: x.isNotNull()), F.lit(0))).withColumn("listed", F.array_min(F.transform("EntryEvent", lambda e: day(e["Date"]))))
    entry = entry.join(acts, "eid").join(F.broadcast(ref.where("set = 'LegalBasis'").select(F.col("id").alias("bid"), F.col("text").alias("basis"))), c("basis_id") == c("bid"), "left").join(look("List", "list"), c("_ListID") == c("list_id"), "left")
    entry = entry.withColumn("program", F.explode(F.when(F.size("programs") > 0, c("programs")).otherwise(F.array(F.lit(None).cast("string")))))
    listing = C.fill(C.LISTING, authority=F.lit("OFAC"), list_name=c("list"), program_code=c("program"), listed_on=c("listed"), legal_basis=c("basis"), measures=c("measures"))
    entry = entry.groupBy(c("_ProfileID").alias("entry_profile")).agg(F.transform(F.array_sort(F.collect_list(F.struct("eid", c("program").alias("p"), listing.alias("l")))), lambda x: x["l"]).alias("listings"))

    names = "array<struct<_Primary:string,_AliasTypeID:string,_LowQuality:string,DocumentedName:array<struct<DocumentedNamePart:array<struct<NamePartValue:struct<_VALUE:string,_NamePartGroupID:string,_ScriptID:string>>>>>>>"
    party = C.xml(spark, path, "DistinctParty", f"""_FixedRef string, Profile struct<_ID:string,_PartySubTypeID:string,Identity:array<struct<_ID:string,_Primary:string,Alias:{names}>>,
      Feature:array<struct<_FeatureTypeID:string,FeatureVersion:array<struct<VersionDetail:array<struct<_DetailReferenceID:string,_VALUE:string>>,VersionLocation:array<struct<_LocationID:string>>,DatePeriod:{PERIOD}>>>>>""").where("Profile IS NOT NULL")
    party = durable(party.withColumn("uid", c("_FixedRef")).withColumn("profile_id", c("Profile._ID")), "parties")  # read five times below
    subtype = F.broadcast(ref.where("set = 'PartySubType'").select(F.col("id").alias("sub_id"), F.lower("text").alias("sub"), F.col("parent").alias("ptype")))
    ptype = F.broadcast(ref.where("set = 'PartyType'").select(F.col("id").alias("pt_id"), F.lower("text").alias("pt")))
    kinds = party.select("uid", c("Profile._PartySubTypeID").alias("s")).join(subtype, c("s") == c("sub_id"), "left").join(ptype, c("ptype") == c("pt_id"), "left")
    kind = F.when(c("sub").isin("vessel", "aircraft"), F.upper("sub"))
    for k, v in PARTY_TYPES.items():
        kind = kind.when(c("pt") == k, v)
    kinds = kinds.select("uid", kind.otherwise("UNKNOWN").alias("entity_type"))

    alias = party.select("uid", F.posexplode("Profile.Identity").alias("ipos", "i")).select("uid", "ipos", F.coalesce(c("i._Primary"), F.lit("true")).alias("ip"), F.posexplode("i.Alias").alias("apos", "a")).join(look("AliasType", "atype"), c("a._AliasTypeID") == c("atype_id"), "left")
    alias = alias.select("uid", "ipos", "apos", (c("a._Primary") == "true").alias("p"), "ip", F.lower("atype").alias("atype"), c("a._LowQuality").alias("low"), F.posexplode("a.DocumentedName").alias("dpos", "d"))
    script = F.broadcast(ref.where("set = 'Script'").select(F.col("id").alias("sc_id"), F.col("text").alias("script")))
    alias = alias.withColumn("words", C.texts(F.transform("d.DocumentedNamePart", lambda x: x["NamePartValue"]["_VALUE"]))).withColumn("sid", F.get(F.filter(F.transform("d.DocumentedNamePart", lambda x: x["NamePartValue"]["_ScriptID"]), lambda x: x.isNotNull()), F.lit(0))).join(script, c("sid") == c("sc_id"), "left").where(F.size("words") > 0)
    primary = F.coalesce(c("p"), F.lit(False)) & (c("ip") == "true")
    t = F.when(primary, "PRIMARY")
    for k, v in ALIAS_TYPES.items():
        t = t.when(c("atype") == k, v)
    weak = F.coalesce(c("low") == "true", F.lit(False))
    name = C.fill(C.NAME, name_type=t.otherwise("AKA"), full_name=T.squeeze(F.array_join("words", " ")), parts=F.array(), script=c("script"), quality=F.when(weak & ~primary, "WEAK").otherwise("STRONG"), raw_quality=F.when(weak, "LowQuality"))
    named = alias.groupBy("uid").agg(F.transform(F.array_sort(F.collect_list(F.struct(F.when(primary, 0).otherwise(1).alias("o"), "ipos", "apos", "dpos", name.alias("n")))), lambda x: x["n"]).alias("names"))

    owned = party.select("uid", F.explode("Profile.Identity").alias("i")).select("uid", c("i._ID").alias("identity_id")).join(docs, "identity_id").groupBy("uid").agg(F.flatten(F.collect_list("documents")).alias("documents"))

    feat = party.select("uid", F.posexplode("Profile.Feature").alias("fpos", "f")).select("uid", "fpos", c("f._FeatureTypeID").alias("ft"), F.posexplode("f.FeatureVersion").alias("vpos", "v")).join(look("FeatureType", "feature"), c("ft") == c("feature_id"), "left")
    first = F.get(c("v.VersionDetail"), F.lit(0))
    feat = feat.withColumn("did", first["_DetailReferenceID"]).join(look("DetailReference", "detail"), c("did") == c("detail_id"), "left").withColumn("lid", F.get(c("v.VersionLocation"), F.lit(0))["_LocationID"]).join(F.broadcast(places), c("lid") == c("location_id"), "left")
    fl, value = F.lower(T.strip(F.col("feature"))), F.coalesce(C.text(first["_VALUE"]), c("detail"))
    feat = feat.select("uid", "fpos", "vpos", "feature", fl.alias("fl"), value.alias("value"), "address", period(c("v.DatePeriod")).alias("period"), c("v.DatePeriod").isNotNull().alias("dated"))
    order = lambda cond, x: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("fpos", "vpos", x.alias("x"))))), lambda y: y["x"])
    is_ = lambda *ks: c("fl").isin(*ks)
    last = lambda cond, x=None: F.max_by(x if x is not None else c("value"), F.when(cond & (x if x is not None else c("value")).isNotNull(), F.struct("fpos", "vpos")))
    nation = F.when(c("fl").startswith("citizenship"), "CITIZENSHIP").when(c("fl").contains("registration"), "REGISTRATION_COUNTRY").otherwise("NATIONALITY")
    labelled = (
        F.when(is_("vessel call sign"), C.ident(F.lit("Call Sign"), c("value"), id_type="CALL_SIGN")).when(is_("mmsi"), C.ident(F.lit("MMSI"), c("value"), id_type="MMSI"))
        .when(c("fl").contains("serial number"), C.ident(c("feature"), c("value"), id_type="AIRCRAFT_MSN")).when(is_("aircraft tail number"), C.ident(c("feature"), c("value"), id_type="AIRCRAFT_TAIL"))
        .when(is_("website"), C.ident(c("feature"), c("value"), id_type="WEBSITE")).when(is_("email address"), C.ident(c("feature"), c("value"), id_type="EMAIL"))
    )
    feats = feat.groupBy("uid").agg(
        order(is_("birthdate") & c("dated"), c("period")).alias("birth_dates"),
        order(is_("place of birth"), C.fill(C.PLACE, place=F.coalesce("value", "address.city", "address.full_raw"), country_iso2=F.coalesce(c("address.country_iso2"), iso(c("value"))), raw=F.coalesce("value", "address.full_raw"))).alias("birth_places"),
        order(is_("nationality country", "citizenship country", "nationality of registration"), C.fill(C.COUNTRY, kind=nation, country_iso2=F.coalesce(c("address.country_iso2"), iso(c("value"))), country_raw=F.coalesce("address.country_raw", "value"))).alias("countries"),
        order(is_("location") & c("address").isNotNull(), c("address")).alias("addresses"), order(labelled.isNotNull(), labelled).alias("marks"), order(is_("title") & c("value").isNotNull(), c("value")).alias("titles"),
        order(c("fl").startswith("additional sanctions information") & c("value").isNotNull(), c("value")).alias("notes"), order(is_("other vessel flag", "former vessel flag") & c("value").isNotNull(), c("value")).alias("former_flags"),
        last(is_("gender")).alias("gender"), last(is_("vessel type")).alias("vessel_type"), last(is_("vessel flag")).alias("flag"), last(is_("vessel owner")).alias("owner"), last(is_("vessel tonnage", "vessel gross registered tonnage")).alias("tonnage"),
        last(is_("vessel year of build")).alias("built"), last(is_("aircraft model")).alias("model"), last(is_("aircraft operator")).alias("operator"), last(is_("aircraft manufacture date") & c("dated"), c("period.year")).alias("made"),
    )
    out = party.select("uid", "profile_id").join(kinds, "uid").join(named, "uid", "left").join(owned, "uid", "left").join(feats, "uid", "left").join(rels, "profile_id", "left").join(entry, c("profile_id") == c("entry_profile"), "left")
    arr = lambda n, t: F.coalesce(c(n), F.array().cast(t))
    ids = F.concat(F.array(C.fill(C.IDENT, id_type=F.lit("OFAC_UID"), label=F.lit("OFAC UID"), value=c("uid"), value_norm=c("uid"))), arr("documents", f"array<{C.IDENT}>"), arr("marks", f"array<{C.IDENT}>"))
    remarks = F.nullif(F.array_join(arr("notes", "array<string>"), "; "), F.lit(""))
    linked = F.filter(arr("relationships", f"array<{C.RELATION}>"), lambda r: F.lower(r["rel_type"]).contains("owned") | F.lower(r["rel_type"]).contains("operat"))
    vessel = C.fill(C.VESSEL, vessel_type=c("vessel_type"), flag_raw=c("flag"), flag_iso2=iso(c("flag")), tonnage=c("tonnage"), build_year=F.substring("built", 1, 4).try_cast("int"), owner_operator_raw=F.coalesce(c("owner"), F.concat(F.lit("linked:"), F.get(linked, F.lit(0))["target_source_key"])), former_flags=arr("former_flags", "array<string>"), former_names=F.array())
    return C.canonical(
        out, source_key=c("uid"), entity_type=c("entity_type"), names=arr("names", f"array<{C.NAME}>"), identifiers=ids, addresses=arr("addresses", f"array<{C.ADDRESS}>"), birth_dates=arr("birth_dates", f"array<{D.PARTIAL}>"),
        birth_places=arr("birth_places", f"array<{C.PLACE}>"), countries=arr("countries", f"array<{C.COUNTRY}>"), relationships=arr("relationships", f"array<{C.RELATION}>"), gender=c("gender"), titles=arr("titles", "array<string>"), remarks=remarks,
        listings=F.transform(arr("listings", f"array<{C.LISTING}>"), lambda x: x.withField("remarks", remarks)), vessel=F.when(c("entity_type") == "VESSEL", vessel),
        aircraft=F.when(c("entity_type") == "AIRCRAFT", C.fill(C.AIRCRAFT, model=c("model"), operator_raw=c("operator"), build_year=c("made"))), extra=F.lit("{}"),
    )
