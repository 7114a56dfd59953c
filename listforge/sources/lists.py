"""Readers of the published lists: landed XML and JSON files to canonical records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from . import canonical as C

VALUES = "struct<VALUE:array<string>>"


def _lit(table: dict[str, str], c: Column, default: str | None) -> Column:
    out = None
    for k, v in table.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(F.lit(default))


# How lists say of what kind and how good an alias is.
UN_ALIAS_TYPES, UN_QUALITY = {"f.k.a.": "FKA", "a.k.a.": "AKA"}, {"good": "STRONG", "low": "WEAK"}
EU_QUALITY = {"true": "STRONG", "false": "WEAK"}
UK_QUALITY = {"good quality": "STRONG", "good": "STRONG", "low quality": "WEAK", "low": "WEAK"}


def alias_quality(table: dict[str, str], said: Column) -> Column:
    """Quality of an alias by a list's own words, UNKNOWN for others."""
    return _lit(table, F.lower(T.strip(F.coalesce(said, F.lit("")))), "UNKNOWN")


def un_alias_type(said: Column) -> Column:
    return _lit(UN_ALIAS_TYPES, F.lower(T.strip(F.coalesce(said, F.lit("")))), "AKA")


def un_birth_date(d: Column) -> Column:
    """Birth date of a person: exact, approximate, or between two years."""
    kind, raw = F.upper(F.coalesce(d["TYPE_OF_DATE"], F.lit(""))), F.coalesce(C.text(d["DATE"]), C.text(d["YEAR"]))
    lo, hi = d["FROM_YEAR"].try_cast("int"), d["TO_YEAR"].try_cast("int")
    p = D.parse_partial(raw)
    about = F.when(kind == "APPROXIMATELY", p.withField("raw", F.concat(F.lit("approximately "), raw))).otherwise(p)
    span = C.fill(D.PARTIAL, year_from=lo, year_to=hi, precision=F.lit("RANGE"), raw=F.concat(F.lit("between "), d["FROM_YEAR"], F.lit(" and "), d["TO_YEAR"]))
    return F.when((kind == "BETWEEN") & lo.isNotNull() & hi.isNotNull(), span).otherwise(about)


def un_list(spark: SparkSession, path: str, iso: C.Iso) -> DataFrame:
    """United Nations consolidated list: individuals and entities."""
    addr = "array<struct<STREET:string,CITY:string,STATE_PROVINCE:string,ZIP_CODE:string,COUNTRY:string,NOTE:string>>"
    alias = "array<struct<QUALITY:string,ALIAS_NAME:string>>"
    common = f"DATAID string, VERSIONNUM string, FIRST_NAME string, SECOND_NAME string, THIRD_NAME string, FOURTH_NAME string, UN_LIST_TYPE string, REFERENCE_NUMBER string, LISTED_ON string, NAME_ORIGINAL_SCRIPT string, COMMENTS1 string, GENDER string, TITLE {VALUES}, DESIGNATION {VALUES}, NATIONALITY {VALUES}, LIST_TYPE {VALUES}, LAST_DAY_UPDATED {VALUES}"
    person = f"{common}, INDIVIDUAL_ALIAS {alias}, INDIVIDUAL_ADDRESS {addr}, INDIVIDUAL_DATE_OF_BIRTH array<struct<TYPE_OF_DATE:string,DATE:string,YEAR:string,FROM_YEAR:string,TO_YEAR:string>>, INDIVIDUAL_PLACE_OF_BIRTH array<struct<CITY:string,STATE_PROVINCE:string,COUNTRY:string>>, INDIVIDUAL_DOCUMENT array<struct<TYPE_OF_DOCUMENT:string,TYPE_OF_DOCUMENT2:string,NUMBER:string,ISSUING_COUNTRY:string,COUNTRY_OF_ISSUE:string,DATE_OF_ISSUE:string>>"

    def build(df: DataFrame, kind: str, a: str, ad: str) -> DataFrame:
        c = F.col
        full = T.join_name(c("FIRST_NAME"), c("SECOND_NAME"), c("THIRD_NAME"), c("FOURTH_NAME"))
        first = F.when(full != "", C.fill(C.NAME, name_type=F.lit("PRIMARY"), full_name=full, quality=F.lit("STRONG"), parts=C.parts(name1=c("FIRST_NAME"), name2=c("SECOND_NAME"), name3=c("THIRD_NAME"), name4=c("FOURTH_NAME"))))
        script = F.when(C.text(c("NAME_ORIGINAL_SCRIPT")).isNotNull(), C.fill(C.NAME, name_type=F.lit("OTHER"), full_name=C.text(c("NAME_ORIGINAL_SCRIPT")), quality=F.lit("STRONG"), raw_quality=F.lit("original script"), parts=F.array()))
        aliases = C.items(c(a), lambda x: C.fill(C.NAME, name_type=un_alias_type(x["QUALITY"]), full_name=T.clean(x["ALIAS_NAME"]), quality=alias_quality(UN_QUALITY, x["QUALITY"]), raw_quality=C.text(x["QUALITY"]), parts=F.array()), lambda x: T.clean(x["ALIAS_NAME"]).isNotNull())
        ids = C.present(C.ident(F.lit("UN Reference Number"), c("REFERENCE_NUMBER"), id_type="UN_REF"), C.ident(F.lit("UN DATAID"), c("DATAID"), id_type="OTHER"))
        extra: dict[str, Column] = {}
        if kind == "PERSON":
            docs = C.items(c("INDIVIDUAL_DOCUMENT"), lambda x: C.ident(F.nullif(T.join_name(x["TYPE_OF_DOCUMENT"], x["TYPE_OF_DOCUMENT2"]), F.lit("")), x["NUMBER"], iso, country=F.coalesce(C.text(x["ISSUING_COUNTRY"]), C.text(x["COUNTRY_OF_ISSUE"])), issued=C.text(x["DATE_OF_ISSUE"])), lambda x: C.text(x["NUMBER"]).isNotNull())
            ids = F.concat(ids, docs)
            place = lambda x: F.nullif(T.join_name(x["CITY"], x["STATE_PROVINCE"]), F.lit(""))
            extra = {
                "birth_dates": F.filter(C.items(c("INDIVIDUAL_DATE_OF_BIRTH"), un_birth_date), lambda x: x.isNotNull()),
                "birth_places": C.items(c("INDIVIDUAL_PLACE_OF_BIRTH"), lambda x: C.fill(C.PLACE, place=place(x), country_iso2=iso(x["COUNTRY"]), raw=F.nullif(T.join_name(place(x), x["COUNTRY"]), F.lit(""))), lambda x: F.coalesce(place(x), C.text(x["COUNTRY"])).isNotNull()),
                "countries": C.items(C.texts(c("NATIONALITY.VALUE")), lambda v: C.fill(C.COUNTRY, kind=F.lit("NATIONALITY"), country_iso2=iso(v), country_raw=v)),
                "titles": C.texts(c("TITLE.VALUE")), "positions": C.texts(c("DESIGNATION.VALUE")), "gender": C.text(c("GENDER")),
            }
        listing = C.fill(C.LISTING, authority=F.lit("UN"), list_name=F.coalesce(F.get(C.texts(c("LIST_TYPE.VALUE")), F.lit(0)), F.lit("UN List")), program_code=C.text(c("UN_LIST_TYPE")), listed_on=D.parse_full(C.text(c("LISTED_ON"))), reference_no=C.text(c("REFERENCE_NUMBER")), measures=F.array(), reason=C.text(c("COMMENTS1")))
        return C.canonical(
            df, source_key=C.text(c("REFERENCE_NUMBER")), entity_type=F.lit(kind), names=F.when(full == "", F.array().cast(f"array<{C.NAME}>")).otherwise(F.concat(C.present(first, script), aliases)), identifiers=ids,
            addresses=F.filter(C.items(c(ad), lambda x: C.address(iso, x["COUNTRY"], x["STREET"], x["CITY"], x["STATE_PROVINCE"], x["ZIP_CODE"], x["NOTE"])), lambda x: x.isNotNull()),
            listings=F.array(listing), source_updated_on=F.array_max(F.transform(C.texts(c("LAST_DAY_UPDATED.VALUE")), D.parse_full)), extra=F.to_json(F.struct(C.text(c("DATAID")).alias("dataid"), C.text(c("VERSIONNUM")).alias("versionnum"))), **extra,
        )

    people = build(C.xml(spark, path, "INDIVIDUAL", person), "PERSON", "INDIVIDUAL_ALIAS", "INDIVIDUAL_ADDRESS")
    return people.unionByName(build(C.xml(spark, path, "ENTITY", f"{common}, ENTITY_ALIAS {alias}, ENTITY_ADDRESS {addr}"), "ORGANIZATION", "ENTITY_ALIAS", "ENTITY_ADDRESS"))


# Vocabularies of the European file.
EU_TYPES = {"person": "PERSON", "enterprise": "ORGANIZATION", "vessel": "VESSEL", "aircraft": "AIRCRAFT"}
EU_ID_TYPES = {
    "passport": "PASSPORT", "id": "NATIONAL_ID", "fiscalcode": "TAX", "regnumber": "REGISTRATION", "swiftbic": "SWIFT", "imo": "IMO", "other": "OTHER",
    "ssn": "NATIONAL_ID", "birthcert": "OTHER", "drivinglicence": "OTHER", "tradelicence": "REGISTRATION", "travel": "PASSPORT",
}


def eu_birth_date(b: Column) -> Column:
    """Birth date of the European file: a date, its parts, or a range of years; ``circa`` is kept in the raw text."""
    two = lambda v: F.lpad(v, 2, "0")
    y, m, d = C.text(b["_year"]), C.text(b["_monthOfYear"]), C.text(b["_dayOfMonth"])
    given = F.coalesce(C.text(b["_birthdate"]), F.when(m.isNotNull() & d.isNotNull(), F.concat_ws("-", y, two(m), two(d))).when(m.isNotNull(), F.concat_ws("-", y, two(m))).otherwise(y))
    lo, hi = C.text(b["_yearRangeFrom"]), C.text(b["_yearRangeTo"])
    p = F.when(given.isNotNull(), D.parse_partial(given)).when(lo.isNotNull() & hi.isNotNull(), C.fill(D.PARTIAL, year_from=lo, year_to=hi, precision=F.lit("RANGE"), raw=F.concat(lo, F.lit("-"), hi)))
    return F.when((b["_circa"] == "true") & p.isNotNull(), p.withField("raw", F.concat(F.lit("circa "), p["raw"]))).otherwise(p)


def eu_list(spark: SparkSession, path: str, iso: C.Iso) -> DataFrame:
    """European financial sanctions file."""
    ctry = "_countryIso2Code:string,_countryDescription:string"
    schema = f"""_designationDetails string, _unitedNationId string, _euReferenceNumber string, _logicalId string, remark string, subjectType struct<_code:string>,
      regulation array<struct<_numberTitle:string,_programme:string,_publicationDate:string,publicationUrl:string>>,
      nameAlias array<struct<_wholeName:string,_firstName:string,_middleName:string,_lastName:string,_function:string,_gender:string,_title:string,_nameLanguage:string,_strong:string>>,
      citizenship array<struct<{ctry}>>, birthdate array<struct<_birthdate:string,_year:string,_monthOfYear:string,_dayOfMonth:string,_yearRangeFrom:string,_yearRangeTo:string,_circa:string,_city:string,_place:string,_region:string,{ctry}>>,
      identification array<struct<_number:string,_latinNumber:string,_identificationTypeCode:string,_identificationTypeDescription:string,_knownFalse:string,_knownExpired:string,{ctry}>>,
      address array<struct<_street:string,_city:string,_zipCode:string,_region:string,_place:string,{ctry}>>"""
    df, c = C.xml(spark, path, "sanctionEntity", schema), F.col
    raw = lambda x: C.text(x["_countryDescription"])

    def code(x: Column) -> Column:
        two = F.upper(T.strip(F.coalesce(x["_countryIso2Code"], F.lit(""))))
        return F.when((F.length(two) == 2) & (two != "00"), two).when(F.upper(raw(x)) != "UNKNOWN", iso(raw(x)))

    whole = lambda x: F.coalesce(T.clean(x["_wholeName"]), F.nullif(T.join_name(x["_firstName"], x["_middleName"], x["_lastName"]), F.lit("")))
    strong = lambda x: F.lower(F.coalesce(x["_strong"], F.lit("")))
    names = F.transform(
        F.filter(F.coalesce("nameAlias", F.array()), lambda x: whole(x).isNotNull()),
        lambda x, i: C.fill(C.NAME, name_type=F.when(i == 0, "PRIMARY").otherwise("AKA"), full_name=whole(x), parts=C.parts(given=x["_firstName"], middle=x["_middleName"], family=x["_lastName"], title=x["_title"], function=x["_function"]), language=C.text(x["_nameLanguage"]), quality=alias_quality(EU_QUALITY, x["_strong"]), raw_quality=F.when(strong(x) != "", F.concat(F.lit("strong="), strong(x)))),
    )
    kind = lambda x: F.lower(F.coalesce(x["_identificationTypeCode"], F.lit("")))

    def doc(x: Column) -> Column:
        label = F.coalesce(C.text(x["_identificationTypeDescription"]), C.text(kind(x)))
        one = C.ident(label, F.coalesce(C.text(x["_number"]), C.text(x["_latinNumber"])), id_type=_lit(EU_ID_TYPES, kind(x), None), country=raw(x))
        flagged = (x["_knownFalse"] == "true") | (x["_knownExpired"] == "true")
        mark = F.concat(one["label"], F.lit(" (flagged: knownFalse="), F.coalesce(x["_knownFalse"], F.lit("None")), F.lit(", knownExpired="), F.coalesce(x["_knownExpired"], F.lit("None")), F.lit(")"))
        return F.when(one.isNotNull(), one.withField("country_iso2", code(x)).withField("label", F.when(flagged, mark).otherwise(one["label"])))

    ids = F.concat(
        C.present(C.ident(F.lit("EU reference number"), c("_euReferenceNumber"), id_type="EU_REF"), C.ident(F.lit("UN id"), c("_unitedNationId"), id_type="UN_REF")),
        F.filter(C.items(c("identification"), doc), lambda x: x.isNotNull()),
    )
    place = lambda b: F.nullif(T.join_name(b["_city"], b["_place"], b["_region"]), F.lit(""))
    regs = F.coalesce("regulation", F.array())
    first = F.get(F.array_sort(F.transform(regs, lambda r, i: F.struct(F.coalesce(C.text(r["_publicationDate"]), F.lit("9999")).alias("d"), i.alias("i"), r["_numberTitle"].alias("t"), r["publicationUrl"].alias("u")))), F.lit(0))
    programmes = F.array_sort(F.array_distinct(C.texts(F.transform(regs, lambda r: r["_programme"]))))
    listing = lambda p: C.fill(C.LISTING, authority=F.lit("EU"), list_name=F.lit("EU Financial Sanctions File"), program_code=p, listed_on=F.array_min(F.transform(regs, lambda r: D.parse_full(r["_publicationDate"]))), legal_basis=C.text(first["t"]), reference_no=C.text(c("_euReferenceNumber")), measures=F.array(F.lit("ASSET_FREEZE")), reason=T.clean(c("_designationDetails")), remarks=T.clean(c("remark")), evidence_url=C.text(first["u"]))
    return C.canonical(
        df, source_key=C.text(c("_logicalId")), entity_type=_lit(EU_TYPES, c("subjectType._code"), "UNKNOWN"), names=names, identifiers=ids,
        addresses=F.filter(C.items(c("address"), lambda a: C.address(iso, raw(a), a["_street"], a["_city"], T.join_name(a["_region"], a["_place"]), a["_zipCode"], code=code(a))), lambda x: x.isNotNull()),
        birth_dates=F.filter(C.items(c("birthdate"), eu_birth_date), lambda x: x.isNotNull()),
        birth_places=C.items(c("birthdate"), lambda b: C.fill(C.PLACE, place=place(b), country_iso2=code(b), raw=F.nullif(T.join_name(place(b), raw(b)), F.lit(""))), lambda b: F.coalesce(place(b), raw(b)).isNotNull()),
        countries=C.items(c("citizenship"), lambda x: C.fill(C.COUNTRY, kind=F.lit("CITIZENSHIP"), country_iso2=code(x), country_raw=raw(x)), lambda x: F.coalesce(code(x), raw(x)).isNotNull()),
        listings=F.when(F.size(programmes) > 0, F.transform(programmes, listing)).otherwise(F.array(listing(F.lit(None).cast("string")))),
        gender=F.get(C.texts(F.transform(F.coalesce("nameAlias", F.array()), lambda x: x["_gender"])), F.lit(0)),
        extra=F.to_json(F.struct(regs.alias("regulations"))),
    )


# Vocabularies of the consolidated export list.
CSL_TYPES = {"individual": "PERSON", "entity": "ORGANIZATION", "vessel": "VESSEL", "aircraft": "AIRCRAFT"}
CSL_MEASURES = {"EL": "LICENSE_REQUIREMENT", "MEU": "LICENSE_REQUIREMENT", "UVL": "EXPORT_RESTRICTION", "DPL": "DENIAL_OF_EXPORT_PRIVILEGES", "DTC": "DEBARMENT", "ISN": "PROCUREMENT_BAN"}
CSL_AUTHORITY = {"EL": "BIS", "MEU": "BIS", "UVL": "BIS", "DPL": "BIS", "DTC": "STATE", "ISN": "STATE"}
CSL_ROW = """struct<id:string,source:string,entity_number:bigint,type:string,programs:array<string>,name:string,title:string,addresses:array<struct<address:string,city:string,state:string,postal_code:string,country:string>>,
 federal_register_notice:string,start_date:string,end_date:string,standard_order:string,license_requirement:string,license_policy:string,call_sign:string,vessel_type:string,gross_tonnage:string,gross_registered_tonnage:string,vessel_flag:string,
 vessel_owner:string,remarks:string,source_list_url:string,source_information_url:string,alt_names:array<string>,citizenships:array<string>,nationalities:array<string>,dates_of_birth:array<string>,places_of_birth:array<string>,
 ids:array<struct<type:string,number:string,country:string,issue_date:string,expiration_date:string>>>"""


def csl_list(spark: SparkSession, path: str, iso: C.Iso, include: tuple[str, ...] = tuple(CSL_MEASURES)) -> DataFrame:
    """US consolidated list, as a bare array or under ``results``; only the included list codes."""
    whole = spark.read.text(path, wholetext=True)
    bare = F.from_json("value", f"array<{CSL_ROW}>")
    wrapped = F.from_json("value", f"struct<results:array<{CSL_ROW}>>")["results"]
    rows = whole.select(F.explode(F.when(F.ltrim("value").startswith("["), bare).otherwise(wrapped)).alias("r")).select("r.*")
    code, c = T.list_code(F.col("source")), F.col
    df = rows.withColumn("code", code).where(c("code").isin(*include))
    name = T.clean(c("name"))
    key = F.coalesce(C.text(c("id")), F.sha1(F.concat_ws("|", "code", name, F.coalesce("federal_register_notice", F.lit("None")), F.coalesce("start_date", F.lit("None")))))
    kind = _lit(CSL_TYPES, F.lower(T.strip(c("type"))), "UNKNOWN")
    nm = lambda v, t, q: C.fill(C.NAME, name_type=F.lit(t), full_name=v, quality=F.lit(q), parts=F.array())
    others = F.filter(C.texts(F.transform(F.coalesce("alt_names", F.array().cast("array<string>")), T.squeeze)), lambda x: x != name)
    ship = (kind == "VESSEL") | C.text(c("call_sign")).isNotNull() | C.text(c("vessel_type")).isNotNull()
    ids = C.items(c("ids"), lambda i: C.ident(i["type"], i["number"], iso, country=i["country"], issued=i["issue_date"], expires=i["expiration_date"]), lambda i: C.text(i["number"]).isNotNull())
    places = C.texts(c("places_of_birth"))
    nation = lambda k, col: C.items(c(col), lambda v: C.fill(C.COUNTRY, kind=F.lit(k), country_iso2=iso(v), country_raw=v))
    remarks = F.nullif(T.join_name(F.when(C.text(c("license_requirement")).isNotNull(), F.concat(F.lit("License requirement: "), c("license_requirement"), F.lit("."))), F.when(C.text(c("license_policy")).isNotNull(), F.concat(F.lit("License policy: "), c("license_policy"), F.lit("."))), c("remarks")), F.lit(""))
    listing = C.fill(C.LISTING, authority=_lit(CSL_AUTHORITY, c("code"), "US"), list_name=c("source"), program_code=c("code"), listed_on=D.parse_full(c("start_date")), legal_basis=c("federal_register_notice"), reference_no=c("entity_number").cast("string"), measures=F.array(_lit(CSL_MEASURES, c("code"), "OTHER")), remarks=remarks, evidence_url=F.coalesce(C.text(c("source_information_url")), C.text(c("source_list_url"))))
    vessel = C.fill(C.VESSEL, vessel_type=c("vessel_type"), flag_raw=c("vessel_flag"), flag_iso2=iso(c("vessel_flag")), owner_operator_raw=c("vessel_owner"), tonnage=F.coalesce(C.text(c("gross_tonnage")), C.text(c("gross_registered_tonnage"))), former_flags=F.array(), former_names=F.array())
    return C.canonical(
        df, source_key=key, entity_type=kind, names=F.when(name.isNull(), F.array().cast(f"array<{C.NAME}>")).otherwise(F.concat(F.array(nm(name, "PRIMARY", "STRONG")), F.transform(others, lambda x: nm(x, "AKA", "UNKNOWN")))),
        identifiers=F.concat(ids, C.present(C.ident(F.lit("Call Sign"), c("call_sign"), id_type="CALL_SIGN"))),
        addresses=F.filter(C.items(c("addresses"), lambda a: C.address(iso, a["country"], a["address"], a["city"], a["state"], a["postal_code"])), lambda x: x.isNotNull()),
        birth_dates=F.filter(C.items(c("dates_of_birth"), D.parse_partial), lambda x: x.isNotNull()), birth_places=F.transform(places, lambda p: C.fill(C.PLACE, place=p, raw=p)),
        countries=F.concat(nation("NATIONALITY", "nationalities"), nation("CITIZENSHIP", "citizenships")), listings=F.array(listing), vessel=F.when(ship, vessel),
        titles=F.filter(F.array(C.text(c("title"))), lambda x: x.isNotNull()), extra=F.to_json(F.struct("programs", "end_date", "standard_order")),
    )


# Vocabularies of the UK list.
UK_FLAGS = {
    "AssetFreeze": "ASSET_FREEZE", "TravelBan": "TRAVEL_BAN", "ArmsEmbargo": "ARMS_EMBARGO", "TargetedArmsEmbargo": "ARMS_EMBARGO", "CharteringOfShips": "CHARTERING_BAN",
    "ProhibitionOfPortEntry": "PORT_BAN", "TrustServicesSanctions": "TRUST_SERVICES_BAN", "DirectorDisqualificationSanction": "DIRECTOR_DISQUALIFICATION", "Deflag": "PORT_BAN",
    "CrewServicingOfShipsAndAircraft": "OTHER", "PreventionOfBusinessArrangements": "OTHER", "ClosureOfRepresentativeOffices": "OTHER", "PreventionOfCharteringOfShips": "CHARTERING_BAN",
}
UK_TEXT = (("asset freeze", "ASSET_FREEZE"), ("travel ban", "TRAVEL_BAN"), ("arms embargo", "ARMS_EMBARGO"), ("port", "PORT_BAN"), ("chartering", "CHARTERING_BAN"), ("trust services", "TRUST_SERVICES_BAN"), ("director disqualification", "DIRECTOR_DISQUALIFICATION"))
UK_TYPES = {"individual": "PERSON", "entity": "ORGANIZATION", "ship": "VESSEL", "vessel": "VESSEL"}


def uk_measures(flags: Column, said: Column) -> Column:
    """Measures by the indicators that are set, or by the words of the sentence where none is; sorted."""
    tidy = lambda a: F.array_sort(F.array_distinct(F.filter(a, lambda x: x.isNotNull())))
    low = F.lower(F.coalesce(said, F.lit("")))
    worded = F.array(*[F.when(low.contains(w), m) for w, m in UK_TEXT])
    return F.when(F.size(tidy(flags)) > 0, tidy(flags)).otherwise(tidy(worded))


def uk_list(spark: SparkSession, path: str, iso: C.Iso) -> DataFrame:
    """UK sanctions list."""
    box = lambda outer, inner, item="string": f"{outer}:struct<{inner}:array<{item}>>"
    leaf = lambda *names: ",".join(f"{n}:string" for n in names)
    name_item = f"struct<{leaf(*[f'Name{i}' for i in range(1, 7)], 'NameType', 'AliasStrength')}>"
    schema = f"""UniqueID string, OFSIGroupID string, UNReferenceNumber string, LastUpdated string, DateDesignated string, RegimeName string, IndividualEntityShip string, DesignationSource string, SanctionsImposed string, OtherInformation string, UKStatementofReasons string,
      Names struct<Name:array<{name_item}>>, NonLatinNames struct<NonLatinName:array<struct<{leaf('NameNonLatinScript', 'NonLatinScriptType', 'NonLatinScriptLanguage')}>>>,
      SanctionsImposedIndicators struct<{leaf(*UK_FLAGS)}>, Addresses struct<Address:array<struct<{leaf(*[f'AddressLine{i}' for i in range(1, 7)], 'AddressPostalCode', 'AddressCountry')}>>>, EmailAddresses struct<EmailAddress:array<string>>,
      IndividualDetails struct<Individual:struct<{box('DOBs', 'DOB')},{box('Nationalities', 'Nationality')},{box('Positions', 'Position')},{box('Genders', 'Gender')},
        PassportDetails:struct<PassportDetail:array<struct<PassportNumber:string,PassportAdditionalInformation:string>>>,NationalIdentifierDetails:struct<NationalIdentifierDetail:array<struct<NationalIdentifierNumber:string>>>,BirthDetails:struct<Location:array<struct<TownOfBirth:string,CountryOfBirth:string>>>>>,
      EntityDetails struct<Entity:struct<{box('BusinessRegistrationNumbers', 'BusinessRegistrationNumber')},{box('ParentCompanies', 'ParentCompany')},{box('Subsidiaries', 'Subsidiary')}>>,
      ShipDetails struct<Ship:struct<{box('IMONumbers', 'IMONumber')},{box('CurrentOwnerOperators', 'CurrentOwnerOperator')},{box('CurrentBelievedFlagOfShips', 'CurrentBelievedFlagOfShip')},{box('PreviousFlags', 'PreviousFlag')},{box('TypeOfShips', 'TypeOfShip')},{box('TonnageOfShips', 'TonnageOfShip')},{box('YearBuilts', 'YearBuilt')},{box('HullIdentificationNumbers', 'HullIdentificationNumber')}>>"""
    df, c = C.xml(spark, path, "Designation", schema), F.col
    ind, ent, ship = "IndividualDetails.Individual", "EntityDetails.Entity", "ShipDetails.Ship"
    kind = _lit(UK_TYPES, F.lower(T.strip(F.coalesce("IndividualEntityShip", F.lit("")))), "UNKNOWN")
    full = lambda n: T.join_name(*[n[f"Name{i}"] for i in range(1, 7)])
    main = lambda n: F.lower(F.coalesce(n["NameType"], F.lit(""))).contains("primary")
    latin = C.items(c("Names.Name"), lambda n: C.fill(C.NAME, name_type=F.when(main(n), "PRIMARY").otherwise("AKA"), full_name=full(n), parts=C.parts(**{f"name{i}": n[f"Name{i}"] for i in range(1, 7)}), quality=F.when(main(n), "STRONG").otherwise(alias_quality(UK_QUALITY, n["AliasStrength"])), raw_quality=C.text(n["AliasStrength"])), lambda n: full(n) != "")
    script = C.items(c("NonLatinNames.NonLatinName"), lambda n: C.fill(C.NAME, name_type=F.lit("OTHER"), full_name=C.text(n["NameNonLatinScript"]), script=C.text(n["NonLatinScriptType"]), language=C.text(n["NonLatinScriptLanguage"]), quality=F.lit("STRONG"), parts=F.array()), lambda n: C.text(n["NameNonLatinScript"]).isNotNull())
    every = F.concat(latin, script)
    names = F.concat(F.filter(every, lambda n: n["name_type"] == "PRIMARY"), F.filter(every, lambda n: n["name_type"] != "PRIMARY"))
    many = lambda label, values, t: F.transform(C.texts(c(values)), lambda v: C.ident(F.lit(label), v, id_type=t))
    passports = C.items(c(f"{ind}.PassportDetails.PassportDetail"), lambda p: C.ident(T.join_name(F.lit("Passport"), p["PassportAdditionalInformation"]), p["PassportNumber"], id_type="PASSPORT"), lambda p: C.text(p["PassportNumber"]).isNotNull())
    ids = F.concat(
        C.present(C.ident(F.lit("UK UniqueID"), c("UniqueID"), id_type="OTHER"), C.ident(F.lit("OFSI Group ID"), c("OFSIGroupID"), id_type="OTHER"), C.ident(F.lit("UN Reference Number"), c("UNReferenceNumber"), id_type="UN_REF")),
        passports, many("National ID", f"{ind}.NationalIdentifierDetails.NationalIdentifierDetail.NationalIdentifierNumber", "NATIONAL_ID"), many("Business Registration Number", f"{ent}.BusinessRegistrationNumbers.BusinessRegistrationNumber", "REGISTRATION"),
        many("IMO number", f"{ship}.IMONumbers.IMONumber", "IMO"), many("Hull Identification Number", f"{ship}.HullIdentificationNumbers.HullIdentificationNumber", "OTHER"), many("Email", "EmailAddresses.EmailAddress", "EMAIL"),
    )
    line = lambda a, i: a[f"AddressLine{i}"]
    addresses = C.items(c("Addresses.Address"), lambda a: C.address(iso, a["AddressCountry"], T.join_name(line(a, 1), line(a, 2), line(a, 3)), line(a, 4), T.join_name(line(a, 5), line(a, 6)), a["AddressPostalCode"]))
    flags = F.array(*[F.when(F.lower(T.strip(c(f"SanctionsImposedIndicators.{f}"))) == "true", m) for f, m in UK_FLAGS.items()])
    first = lambda path: F.get(C.texts(c(path)), F.lit(0))
    owners = C.texts(c(f"{ship}.CurrentOwnerOperators.CurrentOwnerOperator"))
    rel = lambda t, values: F.transform(values, lambda v: C.fill(C.RELATION, rel_type=F.lit(t), target_name=v))
    flag = first(f"{ship}.CurrentBelievedFlagOfShips.CurrentBelievedFlagOfShip")
    vessel = C.fill(C.VESSEL, vessel_type=first(f"{ship}.TypeOfShips.TypeOfShip"), flag_raw=flag, flag_iso2=iso(flag), tonnage=first(f"{ship}.TonnageOfShips.TonnageOfShip"), build_year=F.regexp_extract(first(f"{ship}.YearBuilts.YearBuilt"), r"(\d{4})", 1).try_cast("int"), owner_operator_raw=F.nullif(F.array_join(owners, "; "), F.lit("")), former_flags=C.texts(c(f"{ship}.PreviousFlags.PreviousFlag")), former_names=F.array())
    listing = C.fill(C.LISTING, authority=F.lit("UK"), list_name=F.lit("UK Sanctions List"), program_code=C.text(c("RegimeName")), listed_on=D.parse_full(C.text(c("DateDesignated"))), reference_no=C.text(c("UniqueID")), legal_basis=C.text(c("RegimeName")), measures=uk_measures(flags, c("SanctionsImposed")), reason=T.clean(c("UKStatementofReasons")), remarks=T.clean(c("OtherInformation")))
    return C.canonical(
        df, source_key=C.text(c("UniqueID")), entity_type=kind, names=names, identifiers=ids, addresses=F.filter(addresses, lambda x: x.isNotNull()),
        birth_dates=F.transform(C.texts(c(f"{ind}.DOBs.DOB")), D.parse_partial),
        birth_places=C.items(c(f"{ind}.BirthDetails.Location"), lambda p: C.fill(C.PLACE, place=C.text(p["TownOfBirth"]), country_iso2=iso(p["CountryOfBirth"]), raw=F.nullif(T.join_name(p["TownOfBirth"], p["CountryOfBirth"]), F.lit(""))), lambda p: F.coalesce(C.text(p["TownOfBirth"]), C.text(p["CountryOfBirth"])).isNotNull()),
        countries=F.transform(C.texts(c(f"{ind}.Nationalities.Nationality")), lambda v: C.fill(C.COUNTRY, kind=F.lit("NATIONALITY"), country_iso2=iso(v), country_raw=v)),
        listings=F.array(listing), relationships=F.concat(rel("PARENT_COMPANY", C.texts(c(f"{ent}.ParentCompanies.ParentCompany"))), rel("SUBSIDIARY", C.texts(c(f"{ent}.Subsidiaries.Subsidiary"))), rel("OWNER_OPERATOR", owners)),
        vessel=F.when(c(ship).isNotNull() | (kind == "VESSEL"), vessel), gender=first(f"{ind}.Genders.Gender"), positions=C.texts(c(f"{ind}.Positions.Position")), source_updated_on=D.parse_full(C.text(c("LastUpdated"))),
        extra=F.to_json(F.struct(C.text(c("OFSIGroupID")).alias("ofsi_group_id"), C.text(c("DesignationSource")).alias("designation_source"))),
    )
