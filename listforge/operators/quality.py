"""Measures of a candidate version and the gates that decide whether it may replace the published one.

Documents are nested rows (entity_type, names, identifiers, addresses, birth_dates, countries, listings, ...). Every
measure is one pass of aggregates; nothing but one row of the outcome ever needs to reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T


def _some(array: str, test) -> Column:
    return F.coalesce(F.exists(array, test), F.lit(False))


def _filled(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""


def _ids(*types: str) -> Column:
    return _some("identifiers", lambda i: i["id_type"].isin(*types))


def fill_predicates() -> dict[str, dict[str, Column]]:
    """Per entity type (``*``: every type) the named predicates whose share is the fill rate."""
    return {
        "*": {
            "alias": _some("names", lambda n: n["name_type"] != "PRIMARY"),
            "address": F.coalesce(F.size("addresses") > 0, F.lit(False)),
            "address_country": _some("addresses", lambda a: _filled(a["country_iso2"])),
            "street": _some("addresses", lambda a: _filled(a["street"])),
            "listed_on": _some("listings", lambda x: x["listed_on"].isNotNull()),
            "program": _some("listings", lambda x: _filled(x["program_code"])),
            "measures": _some("listings", lambda x: F.size(x["measures"]) > 0),
            "reason": _some("listings", lambda x: _filled(x["reason"])),
            "legal_evidence": _some("listings", lambda x: _filled(x["evidence_url"]) | _filled(x["legal_basis"])),
        },
        "PERSON": {
            "dob": _some("birth_dates", lambda b: F.coalesce(b["precision"] != "UNKNOWN", F.lit(False))),
            "dob_full": _some("birth_dates", lambda b: b["precision"] == "DAY"),
            "birth_place": F.coalesce(F.size("birth_places") > 0, F.lit(False)),
            "nationality": _some("countries", lambda c: c["kind"].isin("NATIONALITY", "CITIZENSHIP")),
            "passport": _ids("PASSPORT"),
            "national_id": _ids("NATIONAL_ID"),
            "gender": _filled(F.col("gender")),
        },
        "ORGANIZATION": {
            "country": _some("countries", lambda c: _filled(c["country_iso2"]) | _filled(c["country_raw"])) | _some("addresses", lambda a: _filled(a["country_iso2"]) | _filled(a["country_raw"])),
            "registration_id": _ids("REGISTRATION", "TAX", "LEI", "SWIFT"),
            "lei": _ids("LEI"),
            "ownership_link": F.coalesce(F.size("relationships") > 0, F.lit(False)),
        },
        "VESSEL": {
            "imo": _ids("IMO"),
            "imo_valid": _some("identifiers", lambda i: (i["id_type"] == "IMO") & F.coalesce(i["checksum_valid"], F.lit(False))),
            "mmsi": _ids("MMSI"),
            "call_sign": _ids("CALL_SIGN"),
            "flag": _filled(F.col("vessel.flag_iso2")) | _filled(F.col("vessel.flag_raw")),
            "former_flag": F.coalesce(F.size("vessel.former_flags") > 0, F.lit(False)),
            "vessel_type": _filled(F.col("vessel.vessel_type")),
            "build_year": F.coalesce(F.col("vessel.build_year") != 0, F.lit(False)),
            "owner_link": _filled(F.col("vessel.owner_operator_raw")) | F.coalesce(F.size("relationships") > 0, F.lit(False)),
        },
        "AIRCRAFT": {
            "msn": _ids("AIRCRAFT_MSN"),
            "tail": _ids("AIRCRAFT_TAIL"),
            "model": _filled(F.col("aircraft.model")),
            "operator": _filled(F.col("aircraft.operator_raw")),
        },
    }


def fill_rates(docs: DataFrame, predicates: dict[str, dict[str, Column]], digits: int | None = 4) -> DataFrame:
    """(entity_type, field, value) in one pass; a type's own fields are given for that type alone."""
    flat = {(t, f): c for t, group in predicates.items() for f, c in group.items()}
    names = {k: f"f{i}" for i, k in enumerate(flat)}
    wide = docs.groupBy("entity_type").agg(*[F.avg(c.cast("int")).alias(names[k]) for k, c in flat.items()])
    pairs = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(f).alias("field"), F.col(names[t, f]).alias("value")) for t, f in flat])
    long = wide.select("entity_type", F.explode(pairs).alias("p")).where("p.t IN ('*', entity_type)")
    value = F.col("p.value") if digits is None else F.round("p.value", digits)
    return long.select("entity_type", "p.field", value.alias("value"))


def counts_by_type(docs: DataFrame) -> DataFrame:
    """(entity_type, n) with the total as ``*``."""
    return docs.rollup("entity_type").agg(F.count("*").alias("n"), F.grouping_id().alias("g")).select(F.when(F.col("g") == 1, "*").otherwise(F.coalesce("entity_type", F.lit("UNKNOWN"))).alias("entity_type"), "n")


def alias_shares(docs: DataFrame) -> DataFrame:
    """Shares of weak and of unknown quality among aliases; no row without aliases."""
    alias = docs.select(F.explode("names").alias("n")).where("n.name_type <> 'PRIMARY'")
    share = lambda q: F.round(F.avg((F.col("n.quality") == q).cast("int")), 4)
    return alias.agg(share("WEAK").alias("weak_alias_share"), share("UNKNOWN").alias("alias_quality_unknown_share")).where("weak_alias_share IS NOT NULL")


def checksum_rates(ids: DataFrame) -> DataFrame:
    """Exploded identifiers -> pass rates by type, for types that have a checksum."""
    return ids.where("id_type IN ('IMO', 'LEI')").groupBy("id_type").agg(F.round(F.avg(F.coalesce("checksum_valid", F.lit(False)).cast("int")), 4).alias("pass_rate"))


def unmapped(values: DataFrame, raw: str = "country_raw", iso: str = "country_iso2", top: int | None = None) -> DataFrame:
    """Country texts without a code and how often they occur; the most frequent ones if ``top`` is given."""
    out = values.where(F.col(iso).isNull() & _filled(F.col(raw)) & ~F.upper(T.strip(F.col(raw))).isin("UNKNOWN", "00")).groupBy(F.substring(raw, 1, 80).alias("value")).agg(F.count("*").alias("n"))
    return out.orderBy(F.col("n").desc(), "value").limit(top) if top else out


def precision_mix(docs: DataFrame, precisions: str) -> DataFrame:
    """Share of each best birth-date precision among the rows."""
    best = F.coalesce(F.get(F.filter(F.array(*[F.lit(p) for p in ("DAY", "MONTH", "YEAR", "RANGE", "UNKNOWN")]), lambda p: F.array_contains(precisions, p)), F.lit(0)), F.lit("NONE"))
    n = docs.groupBy(best.alias("precision")).agg(F.count("*").alias("n"))
    return n.crossJoin(docs.agg(F.count("*").alias("t"))).select("precision", F.round(F.col("n") / F.col("t"), 4).alias("share"))


def with_floors(metrics: DataFrame, floors: DataFrame, previous: DataFrame, keys: Sequence[str], margin: float = 0.05) -> DataFrame:
    """Metric rows with floor, previous value and status; the status looks at the value rounded to 4 places."""
    out = metrics.join(floors, list(keys), "left").join(previous.select(*keys, F.col("value").alias("prev_value")), list(keys), "left")
    v = F.round("value", 4)
    return out.withColumn("status", F.when(v < F.col("floor"), "FAIL").when(v < F.col("floor") + margin, "WARN").otherwise("OK"))


#: Gates in the order in which the first failing one is told.
GATES = ("MIN_RECORDS", "SKIPPED", "DUPLICATES", "PARSER_WARNING", "SCHEMA_DRIFT", "FILL_FLOOR", "CHECKSUM_IMO", "CHECKSUM_LEI", "UNMAPPED_COUNTRY", "UNPARSEABLE_DATE", "LARGE_REMOVAL", "LARGE_ADDITION")


def gates(m: DataFrame, *, min_records: int, max_skip: float = 0.01, removed_abs: int = 50, removed_pct: float = 0.05, added_abs: int = 1500, added_pct: float = 0.30, drift_quarantines: bool = False) -> DataFrame:
    """Measures of versions -> one row a gate that speaks: FAIL, HOLD or WARN.

    m has keys plus records, skipped, duplicates, drift, bad_countries, bad_dates, added, removed, previous, and may have
    bad_imo and bad_lei (identifiers that fail their checksum). Removals hold on the absolute or the relative limit,
    additions only on both, and neither without a previous version.
    """
    c = F.col
    share = c("skipped") / F.greatest(c("records") + c("skipped"), F.lit(1))
    shrunk = (c("previous") > 0) & ((c("removed") > removed_abs) | (c("removed") > removed_pct * c("previous")))
    grown = (c("previous") > 0) & (c("added") > added_abs) & (c("added") > added_pct * c("previous"))
    some = lambda n: F.when(c(n) > 0, "WARN") if n in m.columns else F.lit(None).cast("string")
    rules = {
        "MIN_RECORDS": F.when(c("records") < min_records, "FAIL"),
        "SKIPPED": F.when(share > max_skip, "FAIL").when(c("skipped") > 0, "WARN"),
        "DUPLICATES": some("duplicates"),
        "SCHEMA_DRIFT": F.when(c("drift") > 0, "FAIL" if drift_quarantines else "WARN"),
        "CHECKSUM_IMO": some("bad_imo"),
        "CHECKSUM_LEI": some("bad_lei"),
        "UNMAPPED_COUNTRY": some("bad_countries"),
        "UNPARSEABLE_DATE": some("bad_dates"),
        "LARGE_REMOVAL": F.when(shrunk, "HOLD"),
        "LARGE_ADDITION": F.when(grown, "HOLD"),
    }
    rows = F.array(*[F.struct(F.lit(GATES.index(g)).alias("ord"), F.lit(g).alias("gate"), s.alias("status")) for g, s in rules.items()])
    return m.withColumn("__g", F.explode(rows)).where("__g.status IS NOT NULL").select("*", "__g.*").drop("__g")


def _spoken(gate: str, status: Column) -> list[Column]:
    return [F.lit(GATES.index(gate)).alias("ord"), F.lit(gate).alias("gate"), status.alias("status")]


def floor_gate(rates: DataFrame, floors: DataFrame, keys: Sequence[str], margin: float = 0.05) -> DataFrame:
    """Fill-rate floors: keys, field, ord, gate, status for each rate below its floor (FAIL) or within the margin above (WARN).

    rates(keys, entity_type, field, value) with values as measured, unrounded; floors(entity_type, field, floor). Types
    without records have no rate, so their floors don't speak.
    """
    both = rates.join(F.broadcast(floors), ["entity_type", "field"])  # one row a configured field
    status = F.when(F.col("value") < F.col("floor"), "FAIL").when(F.col("value") < F.col("floor") + margin, "WARN")
    return both.select(*keys, F.concat_ws(".", "entity_type", "field").alias("field"), *_spoken("FILL_FLOOR", status)).where("status IS NOT NULL")


def warning_gate(warnings: DataFrame, keys: Sequence[str], known: Sequence[str]) -> DataFrame:
    """Parser warnings by category: keys, field, ord, gate, status; categories that aren't known go as PARSE_WARNING.

    warnings(keys, category, n). PARSE_WARNING itself is what the share of skipped records speaks of, so it is left out.
    """
    named = F.when(F.col("category").isin(*known), F.col("category")).otherwise("PARSE_WARNING")
    told = warnings.where((F.col("category") != "PARSE_WARNING") & (F.col("n") > 0))
    return told.select(*keys, named.alias("field"), *_spoken("PARSER_WARNING", F.lit("WARN")))


def all_gates(m: DataFrame, rates: DataFrame, floors: DataFrame, warnings: DataFrame, keys: Sequence[str], *, known: Sequence[str] = (), fill_margin: float = 0.05, **limits) -> DataFrame:
    """Every gate of a candidate version: keys, field (null where a gate looks at the whole version), ord, gate, status."""
    cols = [*keys, "field", "ord", "gate", "status"]
    whole = gates(m, **limits).withColumn("field", F.lit(None).cast("string"))
    return whole.select(*cols).unionByName(floor_gate(rates, floors, keys, fill_margin).select(*cols)).unionByName(warning_gate(warnings, keys, known).select(*cols))


def outcome(versions: DataFrame, spoken: DataFrame, key: str) -> DataFrame:
    """Outcome of each version: QUARANTINE over HOLD over PASS, and the first gate that caused it."""
    bad = spoken.where("status IN ('FAIL', 'HOLD')").groupBy(key).agg(
        F.max((F.col("status") == "FAIL").cast("int")).alias("fail"),
        F.min_by("gate", F.struct(F.when(F.col("status") == "FAIL", 0).otherwise(1), "ord")).alias("primary_error"),
    )
    what = F.when(F.col("fail") == 1, "QUARANTINE").when(F.col("fail") == 0, "HOLD").otherwise("PASS")
    return versions.select(key).join(bad, key, "left").select(key, what.alias("outcome"), "primary_error")


def marker_regression(candidates: DataFrame, published: DataFrame) -> DataFrame:
    """Candidates whose publication time is older than the published version's, or missing where one is required."""
    last = published.groupBy("source_id").agg(F.max("published_at").alias("last_at"))
    state = F.when(F.col("published_at").isNull(), "MISSING_MARKER").when(F.col("published_at") < F.col("last_at"), "REGRESSION").otherwise("OK")
    return candidates.join(last, "source_id", "left").withColumn("marker", state)


def drift(paths: DataFrame, known: DataFrame) -> DataFrame:
    """Paths that the reviewed set doesn't hold."""
    return paths.join(known, "path", "left_anti")


def resolved_issues(open_issues: DataFrame, new_issues: DataFrame) -> DataFrame:
    """Open issues of earlier versions whose (category, field) did not come again."""
    norm = lambda d: d.withColumn("__f", F.coalesce("field", F.lit("")))
    return norm(open_issues).join(norm(new_issues).select("source_id", "category", "__f").distinct(), ["source_id", "category", "__f"], "left_anti").drop("__f")


def suggest_floors(metrics: DataFrame, versions: int = 5, margin: float = 0.05, least: float = 0.2) -> DataFrame:
    """Floors from the last versions: the minimum less a margin, for fields that were never nearly empty."""
    w = Window.partitionBy("source_id").orderBy(F.col("seq").desc())
    recent = metrics.withColumn("__r", F.dense_rank().over(w)).where(F.col("__r") <= versions)
    out = recent.groupBy("source_id", "field").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n"))
    return out.where(F.col("lo") >= least).withColumn("floor", F.round(F.greatest(F.col("lo") - margin, F.lit(0.0)), 4))
