"""Text and identifier normalisers as Column expressions; raw values always stay beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists that classify notices.
DELIST_WORDS = (
    "de-listing", "delisting", "delisted", "removal", "removed", "deletion", "deleted", "unblock", "revoked",
    "revocation", "no longer",
)
LIST_WORDS = ("designation", "designated", "listing", "added", "addition", "identif")
AMEND_WORDS = ("amendment", "amended", "update", "revision", "correction")

# Legal-form tokens that a core company name drops.
LEGAL_FORMS = (
    "llc", "ltd", "limited", "inc", "incorporated", "corp", "corporation", "co", "company", "plc", "jsc", "pjsc", "ojsc",
    "cjsc", "ooo", "ao", "pao", "zao", "oao", "gmbh", "ag", "sa", "sas", "srl", "spa", "bv", "nv", "fze", "fzco", "fzc",
    "llp", "lp", "pte", "pty", "sdn", "bhd", "kg", "as", "ab", "oy", "sarl", "the", "group", "holding", "holdings",
)

# publisher's identifier labels in order of precedence.
LABEL_RULES = (
    ("imo", "IMO"), ("vessel registration identification", "IMO"), ("mmsi", "MMSI"), ("call sign", "CALL_SIGN"),
    ("legal entity number", "LEI"), ("lei", "LEI"), ("swift", "SWIFT"), ("bic", "SWIFT"), ("passport", "PASSPORT"),
    ("national id", "NATIONAL_ID"), ("national identification", "NATIONAL_ID"), ("identity card", "NATIONAL_ID"),
    ("personal id", "NATIONAL_ID"), ("cedula", "NATIONAL_ID"), ("tax", "TAX"), ("inn", "TAX"), ("kpp", "TAX"), ("vat", "TAX"),
    ("registration", "REGISTRATION"), ("company number", "REGISTRATION"), ("ogrn", "REGISTRATION"),
    ("business number", "REGISTRATION"), ("unified social credit", "REGISTRATION"), ("serial number", "AIRCRAFT_MSN"),
    ("msn", "AIRCRAFT_MSN"), ("tail number", "AIRCRAFT_TAIL"), ("email", "EMAIL"), ("website", "WEBSITE"),
)


#: White space of any script, and the separators among the control characters.
BLANK = r"[\s\x1c-\x1f]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Text without white space at its ends."""
    return F.regexp_replace(c, f"(?U)^{BLANK}+|{BLANK}+$", "")


def squeeze(c: Column) -> Column:
    """White space runs become one blank; the ends are trimmed."""
    return F.trim(F.regexp_replace(c, f"(?U){BLANK}+", " "))


def clean(c: Column) -> Column:
    """Squeezed text, or null if nothing is left."""
    return F.nullif(squeeze(c), F.lit(""))


def join_name(*parts: Column) -> Column:
    """The parts that hold something, in order, one blank between them."""
    return squeeze(F.concat_ws(" ", *[clean(p) for p in parts]))


def compact(c: Column) -> Column:
    """Identifier without white space, hyphens, dots and slashes, in upper case."""
    return F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\s\x1c-\x1f\-./]", ""))


def core_name(norm: Column) -> Column:
    """A normalised company name without legal-form tokens."""
    forms = F.array(*[F.lit(f) for f in LEGAL_FORMS])
    return F.array_join(F.filter(F.split(norm, " "), lambda t: ~F.array_contains(forms, t) & (t != "")), " ")


def extract_imo(raw: Column) -> Column:
    """The first stand-alone run of seven digits; blanks count as nothing behind an IMO mark."""
    text = F.when(F.upper(raw).startswith("IMO"), F.replace(raw, F.lit(" "), F.lit(""))).otherwise(raw)
    return F.nullif(F.regexp_extract(text, r"(?<!\d)(\d{7})(?!\d)", 1), F.lit(""))


def imo_checksum_ok(imo: Column) -> Column:
    """Six digits weighted 7 to 2; the last digit of the sum is the seventh digit."""
    total = sum((F.substring(imo, i + 1, 1).try_cast("int") * (7 - i) for i in range(6)), F.lit(0))
    return F.coalesce(imo.rlike(r"^\d{7}$") & (total % 10 == F.substring(imo, 7, 1).try_cast("int")), F.lit(False))


def lei_checksum_ok(lei: Column) -> Column:
    """ISO 7064 mod 97-10 over digits and letters (A = 10), folded character by character."""
    up = F.upper(lei)
    digits = F.filter(F.split(up, ""), lambda c: c != "")
    rest = F.aggregate(
        digits,
        F.lit(0),
        lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97).otherwise((acc * 100 + F.ascii(c) - 55) % 97),
    )
    return F.coalesce(up.rlike(r"^[0-9A-Z]{18}[0-9]{2}$") & (rest == 1), F.lit(False))


def mmsi_ok(mmsi: Column) -> Column:
    return F.coalesce(mmsi.rlike(r"^\d{9}$"), F.lit(False))


def classify_label(label: Column) -> Column:
    """Type of an identifier by its publisher's label; the first rule whose words stand alone wins."""
    low = F.lower(label)
    some = "|".join(needle for needle, _ in LABEL_RULES)
    out = F.when((F.coalesce(label, F.lit("")) == "") | ~low.rlike(f"(?<![a-z])({some})(?![a-z])|aircraft"), "OTHER").when(low.contains("aircraft") & low.contains("serial"), "AIRCRAFT_MSN")
    for needle, kind in LABEL_RULES:
        out = out.when(low.rlike(rf"(?<![a-z]){needle}(?![a-z])"), kind)
    return out.otherwise("OTHER")


def make_identifier(label: Column, value: Column, country_iso2: Column | None = None, country_raw: Column | None = None) -> Column:
    """Identifier struct: type, normalised value and checksum; null for a blank value."""
    none = F.lit(None).cast("string")

    def build(x: Column) -> Column:
        return F.struct(
            x["kind"].alias("id_type"), x["label"].alias("label"), x["v"].alias("value"), F.when(x["kind"] == "IMO", F.coalesce(x["imo"], x["norm"])).otherwise(x["norm"]).alias("value_norm"),
            x["iso2"].alias("country_iso2"), x["raw"].alias("country_raw"), checksum(x["kind"], x["norm"], x["imo"]).alias("checksum_valid"),
        )

    parts = F.struct(
        classify_label(label).alias("kind"), label.alias("label"), strip(F.coalesce(value, F.lit(""))).alias("v"), compact(value).alias("norm"), extract_imo(strip(value)).alias("imo"),
        (country_iso2 if country_iso2 is not None else none).alias("iso2"), (country_raw if country_raw is not None else none).alias("raw"),
    )
    return bind(parts, lambda x: F.when(x["v"] != "", build(x)))


def checksum(kind: Column, norm: Column, imo: Column) -> Column:
    """Whether a number passes the checksum of its type; null for types without one."""
    return F.when(kind == "IMO", imo_checksum_ok(F.coalesce(imo, F.lit("")))).when(kind == "LEI", lei_checksum_ok(norm)).when(kind == "MMSI", mmsi_ok(norm))


def any_word(text: Column, words: tuple[str, ...]) -> Column:
    """Whether one of the words stands in the text; one pass, in which the text is put in lower case once."""
    return F.lower(text).rlike("|".join(words))


def classify_actions(text: Column) -> Column:
    """Kinds of action that a notice announces, in the order delisting, listing, amendment."""
    kinds = (("DELISTING", DELIST_WORDS), ("LISTING", LIST_WORDS), ("AMENDMENT", AMEND_WORDS))
    return F.filter(F.array(*[F.when(any_word(text, w), k) for k, w in kinds]), lambda x: x.isNotNull())


def link_type_near(text: Column, needle: Column, actions: Column, reach: int = 300) -> Column:
    """Kind of link by the words around the first hit: delisting, amendment, listing; else the only action; else a reference."""

    def near(x: Column) -> Column:
        start = F.greatest(x["at"] - 1 - reach, F.lit(0))
        return F.when(x["at"] > 0, F.substring(x["text"], start + 1, x["at"] - 1 + reach - start)).otherwise("")

    def kind(words: Column) -> Column:
        return (
            F.when(any_word(words, DELIST_WORDS), "DELISTING")
            .when(any_word(words, AMEND_WORDS), "AMENDMENT")
            .when(any_word(words, LIST_WORDS), "LISTING")
            .when(F.size(actions) == 1, F.get(actions, F.lit(0)))
            .otherwise("REFERENCE")
        )

    return bind(bind(F.struct(F.instr(text, needle).alias("at"), text.alias("text")), near), kind)


def quote(text: Column, needle: Column, reach: int = 120) -> Column:
    """Evidence: what stands around the first hit, squeezed; null without a hit."""
    at = F.instr(F.lower(text), F.lower(needle))
    start = F.greatest(at - 1 - reach, F.lit(0))
    return F.when(at > 0, squeeze(F.substring(text, start + 1, at - 1 + F.length(needle) + reach - start)))


def list_code(source: Column) -> Column:
    """Code in parentheses behind a list's name."""
    return F.nullif(F.regexp_extract(source, r"\(([A-Z\-]{2,8})\)", 1), F.lit(""))


def act_from_notice(url: Column, external_id: Column) -> Column:
    """Reference of the legal act: the CELEX number in the address, else the feed's id."""
    return F.coalesce(F.nullif(F.regexp_extract(url, r"(?i)CELEX[:%3A]*([0-9A-Z]+)", 1), F.lit("")), external_id)


def html_to_text(html: Column) -> Column:
    """Visible text: page furniture dropped, block ends as line breaks, entities resolved, blanks squeezed."""
    out = F.regexp_replace(html, r"(?is)<!--.*?-->", "")
    for tag in ("script", "style", "nav", "header", "footer", "noscript"):
        out = F.regexp_replace(out, rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>", "")
    out = F.regexp_replace(out, r"(?i)</(p|div|li|tr|td|th|h[1-6]|section|article|table|ul|ol|dt|dd)\s*>|<br\s*/?>", "\n")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", "")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(char))
    out = F.regexp_replace(out, r"\n\s*\n+", "\n\n")
    return F.btrim(F.regexp_replace(out, r"[ \t\r\f\x0B]+", " "), F.lit(" \t\n\r "))


def primary_name(names: Column) -> Column:
    """The first PRIMARY name, else the first name, else empty."""
    first = F.get(F.filter(names, lambda n: n["name_type"] == "PRIMARY"), F.lit(0))["full_name"]
    return F.coalesce(first, F.get(names, F.lit(0))["full_name"], F.lit(""))


def canonical_json(*cols: str) -> Column:
    """JSON of the columns in fixed order, nulls kept; maps must come as key-sorted arrays."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def content_hash(*cols: str) -> Column:
    return F.sha2(canonical_json(*cols), 256)
