"""The canonical record and helpers with which the list readers build it.

Every reader returns rows of ``CANONICAL``. Maps are stored as key-sorted arrays of (k, v) and free extras as JSON text, so
that rows compare and hash. Empty XML elements read as '', so all texts pass through ``text``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import countries as K
from ..functions import dates as D
from ..functions import text as T

NAME = "struct<name_type:string,full_name:string,parts:array<struct<k:string,v:string>>,script:string,language:string,quality:string,raw_quality:string>"
IDENT = "struct<id_type:string,label:string,value:string,value_norm:string,country_iso2:string,country_raw:string,issued_on:string,expires_on:string,checksum_valid:boolean>"
ADDRESS = "struct<street:string,city:string,region:string,postal_code:string,country_iso2:string,country_raw:string,full_raw:string>"
PLACE = "struct<place:string,country_iso2:string,raw:string>"
COUNTRY = "struct<kind:string,country_iso2:string,country_raw:string>"
LISTING = "struct<authority:string,list_name:string,program_code:string,listed_on:date,legal_basis:string,reference_no:string,measures:array<string>,reason:string,remarks:string,evidence_url:string>"
RELATION = "struct<rel_type:string,target_source_key:string,target_name:string,raw:string>"
VESSEL = "struct<vessel_type:string,flag_iso2:string,flag_raw:string,tonnage:string,build_year:int,owner_operator_raw:string,former_flags:array<string>,former_names:array<string>>"
AIRCRAFT = "struct<model:string,manufacturer:string,operator_raw:string,build_year:int>"
FIELDS = {
    "source_key": "string", "entity_type": "string", "names": f"array<{NAME}>", "identifiers": f"array<{IDENT}>", "addresses": f"array<{ADDRESS}>",
    "birth_dates": f"array<{D.PARTIAL}>", "birth_places": f"array<{PLACE}>", "countries": f"array<{COUNTRY}>", "listings": f"array<{LISTING}>",
    "relationships": f"array<{RELATION}>", "vessel": VESSEL, "aircraft": AIRCRAFT, "gender": "string", "titles": "array<string>",
    "positions": "array<string>", "remarks": "string", "source_updated_on": "date", "extra": "string",
}

Iso = Callable[[Column], Column]


def iso_lookup(spark: SparkSession, dim: DataFrame | None = None) -> Iso:
    """The country ladder as an expression over constant maps of some hundred entries (the dimension is that small)."""
    rows = (dim if dim is not None else K.dimension(spark)).collect()
    maps = {}
    for kind in ("iso2", "iso3", "name"):
        pairs = {r["key"]: r["iso2"] for r in rows if r["kind"] == kind}
        maps[kind] = F.from_json(F.lit(json.dumps(pairs, ensure_ascii=False)), "map<string,string>")

    def ladder(x: Column) -> Column:
        s, k = x["s"], x["k"]
        get = lambda kind, key: F.try_element_at(maps[kind], key)
        return F.coalesce(
            F.when(F.length(s) == 2, get("iso2", F.upper(s))),
            F.when(F.length(s) == 3, get("iso3", F.upper(s))),
            get("name", k),
            get("name", F.replace(k, F.lit(","), F.lit(""))),
            get("name", F.nullif(F.regexp_extract(k, r"^(.*?)\s*\((.*)\)$", 1), F.lit(""))),
            F.when(k.contains(","), get("name", F.trim(F.regexp_extract(k, r"([^,]*)$", 1)))),
        )

    return lambda raw: T.bind(F.struct(T.strip(raw).alias("s"), K.key(raw).alias("k")), ladder)


def text(c: Column) -> Column:
    """Trimmed text, null if empty."""
    return F.nullif(T.strip(c), F.lit(""))


def fill(struct_type: str, /, **values: Column) -> Column:
    """A struct of the given type from some of its fields; the others are null."""
    names = [f.split(":", 1) for f in _split(struct_type[len("struct<") : -1])]
    return F.struct(*[(values[n] if n in values else F.lit(None)).cast(t).alias(n) for n, t in names])


def _split(fields: str) -> list[str]:
    out, depth, at = [], 0, 0
    for i, c in enumerate(fields):
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(fields[at:i])
            at = i + 1
    return [*out, fields[at:]]


def items(array: Column, body: Callable[[Column], Column], keep: Callable[[Column], Column] | None = None) -> Column:
    """transform over an array that may be null; entries for which ``keep`` (of the source entry) fails are left out."""
    out = F.transform(F.filter(array, keep) if keep else array, body)
    return F.coalesce(out, F.array())


def present(*cols: Column) -> Column:
    """Array of the columns that aren't null."""
    return F.filter(F.array(*cols), lambda x: x.isNotNull())


def texts(array: Column) -> Column:
    """Trimmed texts of an array that hold something."""
    return F.coalesce(F.filter(F.transform(array, text), lambda x: x.isNotNull()), F.array().cast("array<string>"))


def parts(**values: Column) -> Column:
    """Name parts as a key-sorted array without empty ones."""
    return F.filter(F.array(*[F.struct(F.lit(k).alias("k"), text(values[k]).alias("v")) for k in sorted(values)]), lambda p: p["v"].isNotNull())


def ident(label: Column, value: Column, iso: Iso | None = None, id_type: Column | str | None = None, country: Column | None = None, issued: Column | None = None, expires: Column | None = None) -> Column:
    """Identifier with its type by label, or a given one; null for a blank value."""
    given = F.lit(id_type) if isinstance(id_type, str) else id_type
    kind = T.classify_label(label) if given is None else given if isinstance(id_type, str) else F.coalesce(given, T.classify_label(label))
    raw, text_ = country if country is not None else F.lit(None).cast("string"), value.cast("string")
    parts = F.struct(
        kind.alias("kind"), label.alias("label"), T.strip(F.coalesce(text_, F.lit(""))).alias("v"), T.compact(text_).alias("norm"), T.extract_imo(T.strip(text_)).alias("imo"), raw.alias("raw"),
        (iso(raw) if iso and country is not None else F.lit(None).cast("string")).alias("iso2"),
        *[(c if c is not None else F.lit(None)).cast("string").alias(n) for n, c in (("issued", issued), ("expires", expires))],
    )

    def build(x: Column) -> Column:
        return fill(
            IDENT, id_type=x["kind"], label=x["label"], value=x["v"], value_norm=F.when(x["kind"] == "IMO", F.coalesce(x["imo"], x["norm"])).otherwise(x["norm"]),
            country_iso2=x["iso2"], country_raw=x["raw"], issued_on=x["issued"], expires_on=x["expires"], checksum_valid=T.checksum(x["kind"], x["norm"], x["imo"]),
        )

    return T.bind(parts, lambda x: F.when(x["v"] != "", build(x)))


def address(iso: Iso, raw: Column, street: Column, city: Column, region: Column, postal: Column, *rest: Column, code: Column | None = None) -> Column:
    """Address with its country code; null if nothing is filled."""
    cells = (street, city, region, postal, *rest)
    full = F.nullif(T.join_name(*cells, raw), F.lit(""))
    return F.when(full.isNotNull(), fill(ADDRESS, street=text(street), city=text(city), region=text(region), postal_code=text(postal), country_iso2=F.coalesce(code, iso(raw)) if code is not None else iso(raw), country_raw=text(raw), full_raw=full))


def parse_date_simple(c: Column) -> Column:
    """Full date of a listing, by the general rules."""
    return D.parse_full(c)


def canonical(df: DataFrame, **values: Column) -> DataFrame:
    """Rows of the canonical schema; fields that aren't given are empty arrays or null."""
    def cell(name: str, kind: str) -> Column:
        if name in values:
            return values[name].cast(kind)
        return F.array().cast(kind) if kind.startswith("array") else F.lit(None).cast(kind)

    return df.select(*[cell(n, t).alias(n) for n, t in FIELDS.items()])


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with key and name, counted reasons of the others)."""
    bad = F.when(F.coalesce("source_key", F.lit("")) == "", "missing key").when(F.size("names") == 0, "missing name")
    marked = df.withColumn("__reason", bad)
    return marked.where("__reason IS NULL").drop("__reason"), marked.where("__reason IS NOT NULL").groupBy(F.col("__reason").alias("reason")).agg(F.count("*").alias("n"))


def xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Elements of one local name as rows, whatever their namespace."""
    return spark.read.format("xml").option("rowTag", row_tag).option("ignoreNamespace", "true").option("attributePrefix", "_").option("valueTag", "_VALUE").schema(schema).load(path)


def header(spark: SparkSession, path: str, root: str, leaves: tuple[str, ...], patterns: tuple[str, ...] = ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy")) -> DataFrame:
    """(publication_marker, published_at) of each file's root: the first filled attribute or leaf of the given names."""
    df = xml(spark, path, root, ", ".join(f"`{c}` string" for c in leaves))
    marker = F.coalesce(*[text(F.col(f"`{c}`")) for c in leaves])
    at = F.coalesce(*[F.try_to_timestamp(F.substring(marker, 1, n), F.lit(p)) for p, n in ((p, len(p.replace("'", ""))) for p in patterns)])
    return df.select(marker.alias("publication_marker"), at.alias("published_at"))


def well_formed(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """(good, filled, corrupt) counts of a file's rows; filled: the first column holds something."""
    df = spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("ignoreNamespace", "true").schema(f"{schema}, _corrupt string").load(path)
    first = next(c for c in df.columns if c != "_corrupt")  # the reader refuses to give the corrupt column alone
    return df.select(F.col("_corrupt").isNotNull().alias("c"), F.col(first).isNotNull().alias("f")).agg(F.count_if(~F.col("c")).alias("good"), F.count_if("f").alias("filled"), F.count_if("c").alias("corrupt"))
