"""Country text to ISO 3166-1 alpha-2 by exact steps only; a wrong country is worse than an unmapped one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import squeeze, strip

# Spellings on published lists that the ISO names don't match.
ALIASES = {
    "iran": "IR", "iran islamic republic of": "IR", "islamic republic of iran": "IR", "iran (islamic republic of)": "IR",
    "russia": "RU", "russian federation": "RU", "north korea": "KP", "korea north": "KP", "dprk": "KP",
    "democratic people's republic of korea": "KP", "korea democratic people's republic of": "KP",
    "korea, democratic people's republic of": "KP", "south korea": "KR", "korea south": "KR", "republic of korea": "KR",
    "korea republic of": "KR", "syria": "SY", "syrian arab republic": "SY", "turkey": "TR", "türkiye": "TR", "turkiye": "TR",
    "burma": "MM", "myanmar": "MM", "myanmar (burma)": "MM", "venezuela": "VE", "venezuela bolivarian republic of": "VE",
    "venezuela (bolivarian republic of)": "VE", "bolivia": "BO", "bolivia (plurinational state of)": "BO",
    "united kingdom": "GB", "uk": "GB", "great britain": "GB", "britain": "GB",
    "united kingdom of great britain and northern ireland": "GB", "england": "GB", "scotland": "GB", "united states": "US",
    "usa": "US", "u.s.": "US", "u.s.a.": "US", "united states of america": "US", "viet nam": "VN", "vietnam": "VN",
    "laos": "LA", "lao people's democratic republic": "LA", "lao pdr": "LA", "democratic republic of the congo": "CD",
    "congo democratic republic of the": "CD", "drc": "CD", "congo (democratic republic)": "CD",
    "congo, democratic republic of the": "CD", "republic of the congo": "CG", "congo": "CG", "congo republic of the": "CG",
    "cote d'ivoire": "CI", "côte d'ivoire": "CI", "ivory coast": "CI", "palestine": "PS", "palestinian territory": "PS",
    "occupied palestinian territory": "PS", "state of palestine": "PS", "west bank": "PS", "gaza": "PS", "gaza strip": "PS",
    "kosovo": "XK", "crimea": "UA", "crimea region of ukraine": "UA", "moldova": "MD", "republic of moldova": "MD",
    "moldova republic of": "MD", "tanzania": "TZ", "united republic of tanzania": "TZ", "czech republic": "CZ",
    "czechia": "CZ", "macedonia": "MK", "north macedonia": "MK", "the former yugoslav republic of macedonia": "MK",
    "brunei": "BN", "brunei darussalam": "BN", "cape verde": "CV", "cabo verde": "CV", "eswatini": "SZ", "swaziland": "SZ",
    "hong kong": "HK", "hong kong sar": "HK", "hong kong, china": "HK", "macau": "MO", "macao": "MO", "taiwan": "TW",
    "taiwan province of china": "TW", "chinese taipei": "TW", "vatican": "VA", "holy see": "VA", "micronesia": "FM",
    "micronesia federated states of": "FM", "st kitts and nevis": "KN", "saint kitts and nevis": "KN",
    "st vincent and the grenadines": "VC", "saint vincent and the grenadines": "VC", "st lucia": "LC", "saint lucia": "LC",
    "the bahamas": "BS", "bahamas": "BS", "the gambia": "GM", "gambia": "GM", "uae": "AE", "united arab emirates": "AE",
    "curacao": "CW", "curaçao": "CW", "sudan": "SD", "south sudan": "SS", "libya": "LY", "libyan arab jamahiriya": "LY",
    "yemen": "YE", "afghanistan": "AF", "belarus": "BY", "byelorussia": "BY", "timor-leste": "TL", "east timor": "TL",
}


def key(c: Column) -> Column:
    """Lower case, squeezed, without stops at the ends and a leading article."""
    out = F.btrim(squeeze(F.lower(c)), F.lit(" .;"))
    return F.regexp_replace(out, "^the ", "")


def dimension(spark: SparkSession, names: dict[str, str] | None = None, codes: dict[str, str] | None = None) -> DataFrame:
    """(kind, key, iso2) with kinds iso2, iso3 and name.

    names and codes (alpha-3 to alpha-2) default to the platform's ISO 3166 tables; the aliases are always in.
    """
    if codes is None or names is None:
        loc = spark._jvm.java.util.Locale
        all2 = list(loc.getISOCountries())
        places = {c: loc.Builder().setRegion(c).build() for c in all2}
        codes = codes if codes is not None else {places[c].getISO3Country(): c for c in all2}
        names = names if names is not None else {places[c].getDisplayCountry(loc.ENGLISH): c for c in all2}
    rows = [("iso2", c, c) for c in {*codes.values(), "XK"}] + [("iso3", k, c) for k, c in codes.items()]
    table = spark.createDataFrame([*rows, *[("name", n, c) for n, c in names.items()], *[("name", n, c) for n, c in ALIASES.items()], *[("name", n.replace(",", ""), c) for n, c in ALIASES.items()]], "kind string, raw string, iso2 string")
    return table.select("kind", F.when(F.col("kind") == "name", key(F.col("raw"))).otherwise(F.col("raw")).alias("key"), "iso2").groupBy("kind", "key").agg(F.max("iso2").alias("iso2"))


def to_iso2(df: DataFrame, raw: str, out: str, dim: DataFrame) -> DataFrame:
    """df plus the code of a country text. Distinct texts only meet the dimension, which has some hundred rows."""
    s = strip(F.col("__raw"))
    k = key(F.col("__raw"))
    steps = {
        "a": ("iso2", F.when(F.length(s) == 2, F.upper(s))),
        "b": ("iso3", F.when(F.length(s) == 3, F.upper(s))),
        "c": ("name", k),
        "d": ("name", F.replace(k, F.lit(","), F.lit(""))),
        "e": ("name", F.nullif(F.regexp_extract(k, r"^(.*?)\s*\((.*)\)$", 1), F.lit(""))),
        "f": ("name", F.when(k.contains(","), F.nullif(F.trim(F.regexp_extract(k, r"([^,]*)$", 1)), F.lit("")))),
    }
    found = df.select(F.col(raw).alias("__raw")).distinct()
    for step, (kind, value) in steps.items():
        side = F.broadcast(dim.where(F.col("kind") == kind).select(F.col("key").alias(f"__k{step}"), F.col("iso2").alias(f"__{step}")))
        found = found.withColumn(f"__v{step}", value).join(side, F.col(f"__v{step}") == F.col(f"__k{step}"), "left")
    found = found.select("__raw", F.coalesce(*[F.col(f"__{step}") for step in steps]).alias(out))
    return df.join(found, F.col(raw).eqNullSafe(F.col("__raw")), "left").drop("__raw")
