"""List readers on small files of our own."""

import pytest
from pyspark.sql import functions as F

from listforge.functions import countries as K
from listforge.sources import canonical as C
from listforge.sources import lists as L

UN = """<?xml version="1.0"?><CONSOLIDATED_LIST xmlns="urn:any" dateGenerated="2024-05-01T10:00:00"><INDIVIDUALS>
<INDIVIDUAL><DATAID>11</DATAID><VERSIONNUM>1</VERSIONNUM><FIRST_NAME>ALPHA</FIRST_NAME><SECOND_NAME>Beta </SECOND_NAME><THIRD_NAME/><UN_LIST_TYPE>Zeta</UN_LIST_TYPE><REFERENCE_NUMBER>ZZi.001</REFERENCE_NUMBER><LISTED_ON>2011-02-03</LISTED_ON>
<NAME_ORIGINAL_SCRIPT>алфа</NAME_ORIGINAL_SCRIPT><COMMENTS1>why</COMMENTS1><NATIONALITY><VALUE>Iran (Islamic Republic of)</VALUE><VALUE>Atlantis</VALUE></NATIONALITY><LAST_DAY_UPDATED><VALUE>2012-01-01</VALUE><VALUE>2013-05-06</VALUE></LAST_DAY_UPDATED>
<INDIVIDUAL_ALIAS><QUALITY>Good</QUALITY><ALIAS_NAME>Al Fa</ALIAS_NAME></INDIVIDUAL_ALIAS><INDIVIDUAL_ALIAS><QUALITY>Low</QUALITY><ALIAS_NAME>Affa</ALIAS_NAME></INDIVIDUAL_ALIAS><INDIVIDUAL_ALIAS><QUALITY>f.k.a.</QUALITY><ALIAS_NAME>Old</ALIAS_NAME></INDIVIDUAL_ALIAS><INDIVIDUAL_ALIAS><QUALITY/><ALIAS_NAME/></INDIVIDUAL_ALIAS>
<INDIVIDUAL_ADDRESS><CITY>Teheran</CITY><COUNTRY>Iran</COUNTRY></INDIVIDUAL_ADDRESS><INDIVIDUAL_ADDRESS><COUNTRY/></INDIVIDUAL_ADDRESS>
<INDIVIDUAL_DATE_OF_BIRTH><TYPE_OF_DATE>BETWEEN</TYPE_OF_DATE><FROM_YEAR>1960</FROM_YEAR><TO_YEAR>1962</TO_YEAR></INDIVIDUAL_DATE_OF_BIRTH><INDIVIDUAL_DATE_OF_BIRTH><TYPE_OF_DATE>APPROXIMATELY</TYPE_OF_DATE><YEAR>1961</YEAR></INDIVIDUAL_DATE_OF_BIRTH>
<INDIVIDUAL_DOCUMENT><TYPE_OF_DOCUMENT>Passport</TYPE_OF_DOCUMENT><NUMBER>A 12-3</NUMBER><ISSUING_COUNTRY>France</ISSUING_COUNTRY></INDIVIDUAL_DOCUMENT></INDIVIDUAL>
<INDIVIDUAL><DATAID>12</DATAID><FIRST_NAME>No Key</FIRST_NAME></INDIVIDUAL></INDIVIDUALS>
<ENTITIES><ENTITY><DATAID>13</DATAID><FIRST_NAME>Gamma Co</FIRST_NAME><REFERENCE_NUMBER>ZZe.002</REFERENCE_NUMBER><ENTITY_ALIAS><QUALITY>a.k.a.</QUALITY><ALIAS_NAME>G Co</ALIAS_NAME></ENTITY_ALIAS></ENTITY></ENTITIES></CONSOLIDATED_LIST>"""
EU = """<export generationDate="2024-05-01T00:00:00"><sanctionEntity designationDetails="d" unitedNationId="ZZi.001" euReferenceNumber="EU.9.1" logicalId="9"><remark>r</remark><subjectType code="person"/>
<regulation numberTitle="2020/2" programme="BBB" publicationDate="2020-02-01"><publicationUrl>u2</publicationUrl></regulation><regulation numberTitle="2019/1" programme="AAA" publicationDate="2019-01-01"><publicationUrl>u1</publicationUrl></regulation><regulation numberTitle="x" programme="AAA" publicationDate=""/>
<nameAlias wholeName="Alpha Beta" strong="true" gender="M"/><nameAlias firstName="Al" lastName="Be" strong="false"/><citizenship countryIso2Code="00" countryDescription="UNKNOWN"/><citizenship countryIso2Code="FR" countryDescription="FRANCE"/>
<birthdate year="1970" monthOfYear="5" dayOfMonth="6" circa="true" city="Lyon" countryIso2Code="FR" countryDescription="FRANCE"/><birthdate yearRangeFrom="1960" yearRangeTo="1965" countryIso2Code="00"/>
<identification number="P1" identificationTypeCode="passport" identificationTypeDescription="National passport" knownExpired="true" countryIso2Code="FR" countryDescription="FRANCE"/><address street="S" city="Lyon" countryIso2Code="FR" countryDescription="FRANCE"/></sanctionEntity></export>"""
CSL = """{"total": 3, "results": [{"id": "e1", "source": "Entity List (EL) - Some Bureau", "type": "Entity", "name": "Acme  Parts", "alt_names": ["Acme Parts", "AP"], "addresses": [{"city": "Lyon", "country": "FR"}], "start_date": "2020-01-02", "license_requirement": "All", "ids": [{"type": "Company Number", "number": "12.3", "country": "FR"}]},
{"id": null, "source": "Denied Persons List (DPL)", "type": "Individual", "name": "John", "dates_of_birth": ["1970"]}, {"id": "x", "source": "Other (SDN)", "name": "Out"}]}"""
UK = """<Designations><DateGenerated>2024-05-01T00:00:00</DateGenerated><Designation><UniqueID>AA1</UniqueID><OFSIGroupID>77</OFSIGroupID><UNReferenceNumber>ZZi.001</UNReferenceNumber><RegimeName>R</RegimeName><IndividualEntityShip>Individual</IndividualEntityShip><DateDesignated>01/02/2020</DateDesignated>
<SanctionsImposed>Asset freeze|Travel Ban</SanctionsImposed><Names><Name><Name1>Al</Name1><Name6>Fa</Name6><NameType>Alias</NameType><AliasStrength>Low quality</AliasStrength></Name><Name><Name1>Alpha</Name1><Name6>Beta</Name6><NameType>Primary Name</NameType></Name></Names>
<Addresses><Address><AddressLine1>1 St</AddressLine1><AddressLine4>Town</AddressLine4><AddressCountry>France</AddressCountry></Address></Addresses><IndividualDetails><Individual><DOBs><DOB>dd/mm/1965</DOB></DOBs><Nationalities><Nationality>Iran</Nationality></Nationalities></Individual></IndividualDetails></Designation>
<Designation><UniqueID>AA2</UniqueID><IndividualEntityShip>Ship</IndividualEntityShip><SanctionsImposedIndicators><Deflag>true</Deflag><AssetFreeze>false</AssetFreeze></SanctionsImposedIndicators><Names><Name><Name6>BOAT</Name6><NameType>Primary Name</NameType></Name></Names>
<ShipDetails><Ship><IMONumbers><IMONumber>9074729</IMONumber></IMONumbers><YearBuilts><YearBuilt>built 1999</YearBuilt></YearBuilts><CurrentOwnerOperators><CurrentOwnerOperator>Own Co</CurrentOwnerOperator></CurrentOwnerOperators></Ship></ShipDetails></Designation></Designations>"""


@pytest.fixture(scope="module")
def iso(spark):
    return C.iso_lookup(spark, K.dimension(spark, {"France": "FR"}, {"FRA": "FR"}))


def land(tmp_path, name, body):
    p = tmp_path / name
    p.write_text(body, encoding="utf-8")
    return str(p)


def read(spark, tmp_path, iso, f, name, body):
    good, bad = C.split_rejects(f(spark, land(tmp_path, name, body), iso))
    return {r.source_key: r for r in good.collect()}, {r.reason: r.n for r in bad.collect()}


def test_un(spark, tmp_path, iso):
    rows, bad = read(spark, tmp_path, iso, L.un_list, "un.xml", UN)
    assert set(rows) == {"ZZi.001", "ZZe.002"} and bad == {"missing key": 1}
    r = rows["ZZi.001"]
    assert [(n.name_type, n.full_name, n.quality) for n in r.names] == [("PRIMARY", "ALPHA Beta", "STRONG"), ("OTHER", "алфа", "STRONG"), ("AKA", "Al Fa", "STRONG"), ("AKA", "Affa", "WEAK"), ("FKA", "Old", "UNKNOWN")]
    assert [(c.country_iso2, c.country_raw) for c in r.countries] == [("IR", "Iran (Islamic Republic of)"), (None, "Atlantis")]
    assert [(b.precision, b.year, b.year_from, b.raw) for b in r.birth_dates] == [("RANGE", None, 1960, "between 1960 and 1962"), ("YEAR", 1961, None, "approximately 1961")]
    assert [(i.id_type, i.value_norm, i.country_iso2) for i in r.identifiers] == [("UN_REF", "ZZI001", None), ("OTHER", "11", None), ("PASSPORT", "A123", "FR")]
    assert len(r.addresses) == 1 and r.addresses[0].country_iso2 == "IR" and str(r.source_updated_on) == "2013-05-06" and str(r.listings[0].listed_on) == "2011-02-03"
    assert rows["ZZe.002"].entity_type == "ORGANIZATION"


def test_namespace_does_not_change_hashes(spark, tmp_path, iso):
    cols = list(C.FIELDS)
    h = lambda body, n: sorted(r[0] for r in L.un_list(spark, land(tmp_path, n, body), iso).select(F.sha2(F.to_json(F.struct(*cols)), 256)).collect())
    assert h(UN, "a.xml") == h(UN.replace(' xmlns="urn:any"', ""), "b.xml")


def test_eu(spark, tmp_path, iso):
    rows, _ = read(spark, tmp_path, iso, L.eu_list, "eu.xml", EU)
    r = rows["9"]
    assert [(n.name_type, n.full_name, n.quality) for n in r.names] == [("PRIMARY", "Alpha Beta", "STRONG"), ("AKA", "Al Be", "WEAK")]
    assert [(x.program_code, str(x.listed_on), x.legal_basis, x.evidence_url) for x in r.listings] == [("AAA", "2019-01-01", "2019/1", "u1"), ("BBB", "2019-01-01", "2019/1", "u1")]
    assert [(i.id_type, i.value_norm) for i in r.identifiers] == [("EU_REF", "EU91"), ("UN_REF", "ZZI001"), ("PASSPORT", "P1")] and "knownExpired=true" in r.identifiers[2].label
    assert [(b.precision, b.raw) for b in r.birth_dates] == [("DAY", "circa 1970-05-06"), ("RANGE", "1960-1965")]
    assert [(c.country_iso2, c.country_raw) for c in r.countries] == [(None, "UNKNOWN"), ("FR", "FRANCE")] and r.gender == "M"


def test_csl(spark, tmp_path, iso):
    for body in (CSL, CSL[CSL.index("[") : CSL.rindex("]") + 1]):
        rows, _ = read(spark, tmp_path, iso, L.csl_list, "csl.json", body)
        assert len(rows) == 2 and rows["e1"].entity_type == "ORGANIZATION"
        r = rows["e1"]
        assert [n.full_name for n in r.names] == ["Acme Parts", "AP"] and r.listings[0].authority == "BIS" and r.listings[0].remarks == "License requirement: All."
        assert r.identifiers[0].id_type == "REGISTRATION" and r.identifiers[0].country_iso2 == "FR" and r.addresses[0].country_iso2 == "FR"
        other = next(k for k in rows if k != "e1")
        assert len(other) == 40 and rows[other].birth_dates[0].precision == "YEAR"


def test_uk(spark, tmp_path, iso):
    rows, _ = read(spark, tmp_path, iso, L.uk_list, "uk.xml", UK)
    r = rows["AA1"]
    assert [(n.name_type, n.full_name, n.quality) for n in r.names] == [("PRIMARY", "Alpha Beta", "STRONG"), ("AKA", "Al Fa", "WEAK")]
    assert r.listings[0].measures == ["ASSET_FREEZE", "TRAVEL_BAN"] and str(r.listings[0].listed_on) == "2020-02-01" and r.birth_dates[0].precision == "YEAR"
    assert r.addresses[0].street == "1 St" and r.addresses[0].city == "Town" and r.addresses[0].country_iso2 == "FR"
    s = rows["AA2"]
    assert s.listings[0].measures == ["PORT_BAN"] and s.vessel.build_year == 1999 and s.vessel.owner_operator_raw == "Own Co"
    assert [(i.id_type, i.checksum_valid) for i in s.identifiers] == [("OTHER", None), ("IMO", True)]


def test_header_and_broken_files(spark, tmp_path):
    h = C.header(spark, land(tmp_path, "un.xml", UN), "CONSOLIDATED_LIST", ("_dateGenerated", "DateGenerated")).first()
    assert h.publication_marker == "2024-05-01T10:00:00" and str(h.published_at) == "2024-05-01 10:00:00"
    bad = land(tmp_path, "bad.xml", "<L><R><A>1</A></R><R><A>2</R></L>")
    out = C.well_formed(spark, bad, "R", "A string").first()
    assert out.corrupt >= 1

OFAC = """<Sanctions xmlns="urn:x"><DateOfIssue><Year>2024</Year><Month>5</Month><Day>1</Day></DateOfIssue><ReferenceValueSets>
<AliasTypeValues><AliasType ID="1">A.K.A.</AliasType></AliasTypeValues><FeatureTypeValues><FeatureType ID="8">Birthdate</FeatureType><FeatureType ID="9">Vessel Flag</FeatureType><FeatureType ID="10">Location</FeatureType></FeatureTypeValues>
<CountryValues><Country ID="c1" ISO2="IR">Iran</Country></CountryValues><IDRegDocTypeValues><IDRegDocType ID="d1">Passport</IDRegDocType><IDRegDocType ID="d2">Vessel Registration Identification</IDRegDocType></IDRegDocTypeValues>
<PartySubTypeValues><PartySubType ID="1" PartyTypeID="4">Vessel</PartySubType><PartySubType ID="4" PartyTypeID="1">Unknown</PartySubType></PartySubTypeValues><PartyTypeValues><PartyType ID="1">Individual</PartyType><PartyType ID="4">Transport</PartyType></PartyTypeValues>
<SanctionsTypeValues><SanctionsType ID="s1">Program</SanctionsType><SanctionsType ID="s2">Block</SanctionsType></SanctionsTypeValues><ListValues><List ID="l1">SDN List</List></ListValues><LegalBasisValues><LegalBasis ID="b1" LegalBasisShortRef="EO 1">EO 1</LegalBasis></LegalBasisValues>
<RelationTypeValues><RelationType ID="r1">Owned or Controlled By</RelationType></RelationTypeValues><LocPartTypeValues><LocPartType ID="p1">CITY</LocPartType></LocPartTypeValues></ReferenceValueSets>
<Locations><Location ID="L1"><LocationCountry CountryID="c1"/><LocationPart LocPartTypeID="p1"><LocationPartValue Primary="true"><Value>Bandar</Value></LocationPartValue></LocationPart></Location></Locations>
<IDRegDocuments><IDRegDocument ID="x" IdentityID="i1" IDRegDocTypeID="d1" IssuedBy-CountryID="c1"><IDRegistrationNo>P-9</IDRegistrationNo></IDRegDocument><IDRegDocument ID="y" IdentityID="i2" IDRegDocTypeID="d2"><IDRegistrationNo>IMO 9074729</IDRegistrationNo></IDRegDocument></IDRegDocuments>
<DistinctParties><DistinctParty FixedRef="100"><Profile ID="100" PartySubTypeID="4"><Identity ID="i1" Primary="true"><Alias Primary="true" AliasTypeID="1" LowQuality="false"><DocumentedName><DocumentedNamePart><NamePartValue>Al</NamePartValue></DocumentedNamePart><DocumentedNamePart><NamePartValue>FA</NamePartValue></DocumentedNamePart></DocumentedName></Alias>
<Alias Primary="false" AliasTypeID="1" LowQuality="true"><DocumentedName><DocumentedNamePart><NamePartValue>Weak</NamePartValue></DocumentedNamePart></DocumentedName></Alias></Identity>
<Feature ID="f" FeatureTypeID="8"><FeatureVersion><DatePeriod><Start Approximate="true"><From><Year>1970</Year><Month>1</Month><Day>1</Day></From><To><Year>1970</Year><Month>12</Month><Day>31</Day></To></Start><End><From><Year>1970</Year><Month>1</Month><Day>1</Day></From><To><Year>1970</Year><Month>12</Month><Day>31</Day></To></End></DatePeriod></FeatureVersion></Feature>
<Feature ID="g" FeatureTypeID="10"><FeatureVersion><VersionLocation LocationID="L1"/></FeatureVersion></Feature></Profile></DistinctParty>
<DistinctParty FixedRef="200"><Profile ID="200" PartySubTypeID="1"><Identity ID="i2" Primary="true"><Alias Primary="true" AliasTypeID="1"><DocumentedName><DocumentedNamePart><NamePartValue>BOAT</NamePartValue></DocumentedNamePart></DocumentedName></Alias></Identity><Feature ID="h" FeatureTypeID="9"><FeatureVersion><VersionDetail>Iran</VersionDetail></FeatureVersion></Feature></Profile></DistinctParty></DistinctParties>
<ProfileRelationships><ProfileRelationship ID="q" From-ProfileID="200" To-ProfileID="100" RelationTypeID="r1" Former="false"/></ProfileRelationships>
<SanctionsEntries><SanctionsEntry ID="e1" ProfileID="100" ListID="l1"><EntryEvent LegalBasisID="b1"><Date><Year>2020</Year><Month>3</Month><Day>4</Day></Date></EntryEvent><SanctionsMeasure SanctionsTypeID="s1"><Comment>P1</Comment></SanctionsMeasure><SanctionsMeasure SanctionsTypeID="s1"><Comment>P2</Comment></SanctionsMeasure><SanctionsMeasure SanctionsTypeID="s2"/></SanctionsEntry></SanctionsEntries></Sanctions>"""


def test_normalised_file(spark, tmp_path, iso):
    from listforge.sources.advanced import advanced_list

    rows, _ = read(spark, tmp_path, iso, advanced_list, "ofac.xml", OFAC)
    p, v = rows["100"], rows["200"]
    assert p.entity_type == "PERSON" and [(n.name_type, n.full_name, n.quality) for n in p.names] == [("PRIMARY", "Al FA", "STRONG"), ("AKA", "Weak", "WEAK")]
    assert [(x.program_code, x.measures, str(x.listed_on), x.legal_basis, x.list_name) for x in p.listings] == [("P1", ["ASSET_FREEZE"], "2020-03-04", "EO 1", "SDN List"), ("P2", ["ASSET_FREEZE"], "2020-03-04", "EO 1", "SDN List")]
    assert [(i.id_type, i.value_norm, i.country_iso2) for i in p.identifiers] == [("OFAC_UID", "100", None), ("PASSPORT", "P9", "IR")]
    assert p.birth_dates[0].precision == "YEAR" and p.birth_dates[0].raw.startswith("circa") and p.addresses[0].city == "Bandar" and p.addresses[0].country_iso2 == "IR"
    assert v.entity_type == "VESSEL" and v.vessel.flag_iso2 == "IR" and v.vessel.owner_operator_raw == "linked:100" and v.identifiers[1].value_norm == "9074729" and v.identifiers[1].checksum_valid


def test_feeds(spark, tmp_path):
    from listforge.sources import feeds as FD

    rss = land(tmp_path, "f.xml", "<rss><channel><item><title>T</title><link>u</link><guid>g1</guid><pubDate>Wed, 1 May 2024 10:00:00 +0000</pubDate></item></channel></rss>")
    r = FD.rss(spark, rss).first()
    assert (r.external_id, r.title, str(r.published_at)) == ("g1", "T", "2024-05-01 10:00:00")
    page = land(tmp_path, "n.json", '{"results": [{"id": "1", "t": "Sanctions x", "d": "2024-05-01T00:00", "b": "x"}, {"id": "2", "t": "other", "d": null, "b": null}]}')
    got = FD.notice_pages(spark, page, {"external_id": "id", "title": "t", "published": "d", "text": "b"}, "sanction").collect()
    assert [(g.external_id, str(g.published_on)) for g in got] == [("1", "2024-05-01")]
    html = spark.createDataFrame([('<a href="/recent-actions/20240501">x</a><a href="/recent-actions/20240502_33">y</a><a href="/recent-actions/20240501">x</a>',)], "h string")
    assert sorted(r.external_id for r in FD.action_links(html, "h").collect()) == ["20240501", "20240502"]
    log = spark.createDataFrame([("<p>Intro</p><p>1 May 2024</p><p>added ZZi.001</p><p>2 June 2024</p><p>removed</p>",)], "h string")
    assert sorted((str(r.published_on), r.text) for r in FD.dated_blocks(log, "h").collect()) == [("2024-05-01", "added ZZi.001"), ("2024-06-02", "removed")]


def test_registries_and_curated_files(spark, tmp_path, iso):
    from listforge.sources import feeds as FD
    from listforge.sources import landing

    csv = land(tmp_path, "r.csv", "N-NUMBER , NAME\n 1A , X Y \n2B,\n")
    assert [(r["N-NUMBER"], r["NAME"]) for r in FD.registry_csv(spark, csv).collect()] == [("1A", "X Y"), ("2B", None)]
    cur = FD.curated_csv(spark, land(tmp_path, "c.csv", "Name,IMO,Flag,Aliases\nBOAT,9074729,Iran,A; B\nBAD,1234568,,\n,,,\n"), True)
    rows = cur.collect()
    assert [(r.name, r.ok) for r in rows if r.name] == [("BOAT", True), ("BAD", False)]
    rec = FD.curated_records(cur.where("ok"), iso, True).collect()
    assert [r.source_key for r in rec] == ["9074729"] and len(rec[0].names) == 3 and rec[0].vessel.flag_iso2 == "IR"
    census = {r.path: r.n for r in FD.path_census(spark.createDataFrame([("<a k='1'><b/><b/></a>",)], "x string"), "x").collect()}
    assert census == {"/a": 1, "/a/@k": 1, "/a/b": 2}
    h = landing.file_hashes(spark, csv).first()
    import hashlib
    assert h.sha256 == hashlib.sha256(open(csv, "rb").read()).hexdigest()
    out = str(tmp_path / "staged")
    df = spark.createDataFrame([("S1", 1, "a"), ("S1", 2, "b")], "source_id string, seq int, k string")
    landing.stage(df, out, "source_id", "seq")
    landing.stage(df.where("seq = 2").withColumn("k", F.lit("c")), out, "source_id", "seq")
    assert sorted((r.seq, r.k) for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "c")]
    bad = landing.malformed_share(spark.createDataFrame([(k, "n" if k % 2 else None) for k in range(10)], "pos long, name string"), ["name"], "pos").first()
    assert bad.share == 0.5 and bad.fails
