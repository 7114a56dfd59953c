"""Removals, cross-list keys, curated entries and reviews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import durable
from . import versioning as V

#: Identifier types that say nothing about identity.
WEAK_TYPES = ("OTHER", "EMAIL", "WEBSITE")


def identifier_rows(rows: DataFrame, label: str, value: str) -> DataFrame:
    """rows plus id_type, value_norm and checksum_valid."""
    ident = T.make_identifier(F.col(label), F.col(value))
    return rows.withColumn("__i", ident).withColumns({c: F.col(f"__i.{c}") for c in ("id_type", "value_norm", "checksum_valid")}).drop("__i")


def crosslist_keys(ids: DataFrame, keys: Sequence[str], plain: Sequence[str] = ("UN_REF", "LEI", "OFAC_UID"), checked: Sequence[str] = ("IMO",), with_country: Sequence[str] = ("REGISTRATION", "PASSPORT")) -> DataFrame:
    """Strong keys of current records: as they are, only with a valid checksum, or together with the country."""
    country = F.coalesce(F.col("country_iso2"), F.lit("")) if "country_iso2" in ids.columns else F.lit("")
    value = (
        F.when(F.col("id_type").isin(*plain) if plain else F.lit(False), F.col("value_norm"))
        .when(F.col("id_type").isin(*checked) & F.col("checksum_valid"), F.col("value_norm"))
        .when(F.col("id_type").isin(*with_country), F.concat("value_norm", F.lit("|"), country))
    )
    return ids.select(*keys, F.col("id_type").alias("key_type"), value.alias("key_value")).where("key_value IS NOT NULL").distinct()


def crosslist_hits(cands: DataFrame, keys: DataFrame, by: Sequence[str], most: int = 8, largest: int = 18) -> DataFrame:
    """How many records of another key share a strong key with each candidate; candidates without any are left out.

    keys has distinct rows. No pairs of records are made: a candidate's holders are the union of the holders of its keys, and
    the size of a union follows by inclusion and exclusion from the numbers of records that hold each subset of keys. Records of more than
    ``most`` shared keys are only met one by one where they have more subsets than their keys have holders, or over ``largest`` keys.
    """
    label = F.concat_ws("\u001f", "key_type", "key_value")
    shared = keys.groupBy("key_type", "key_value").agg(F.count("*").alias("n")).where("n > 1").select(label.alias("__k"), "n")
    held = keys.select(*by, label.alias("k")).join(shared, F.col("k") == F.col("__k")).drop("__k")
    listed = held.groupBy(*by).agg(F.array_sort(F.collect_set("k")).alias("ks"), F.sum("n").alias("holders"))
    few = (F.size("ks") <= most) | ((F.size("ks") <= largest) & (F.pow(F.lit(2.0), F.size("ks")) <= F.col("holders")))
    sets = durable(listed.select(*by, "ks", few.alias("few")), "key-sets")  # read five times below
    small, large = sets.where("few").drop("few"), sets.where("NOT few").drop("few")
    # a subset is a number whose bits say which keys are in it, so a record's subsets never stand in one row
    subsets = small.withColumn("bits", F.explode(F.expr("sequence(1L, shiftleft(1L, size(ks)) - 1)")))
    parts = subsets.select(*by, (F.bit_count("bits") % 2 == 1).alias("odd"), F.expr("array_join(filter(ks, (k, i) -> getbit(bits, i) = 1), '\u001e')").alias("p"))
    count = parts.groupBy("p").agg(F.count("*").alias("n")).withColumnRenamed("p", "__p")
    mine = parts.join(cands.select(*by).distinct(), list(by), "left_semi")
    alike = mine.join(count, F.col("p") == F.col("__p")).groupBy(*by).agg((F.sum(F.when(F.col("odd"), F.col("n")).otherwise(-F.col("n"))) - 1).alias("n"))

    def direct(a: DataFrame, b: DataFrame) -> DataFrame:
        left = a.join(cands.select(*by).distinct(), list(by), "left_semi").select(*by, F.explode("ks").alias("k"))
        right = b.select(*[F.col(c).alias(f"__x_{c}") for c in by], F.explode("ks").alias("k"))
        same = reduce(lambda x, y: x & y, [F.col(c) == F.col(f"__x_{c}") for c in by])
        return left.join(right, "k").where(~same).select(*by, *[f"__x_{c}" for c in by]).distinct().groupBy(*by).agg(F.count("*").alias("n"))

    every_one = alike.union(direct(small, large)).union(direct(large, sets.drop("few")))
    return every_one.groupBy(*by).agg(F.sum("n").alias("n_hits")).where("n_hits > 0")


def listed_elsewhere(cands: DataFrame, keys: DataFrame) -> DataFrame:
    """(source_id, source_key, sources): the lists on which each candidate's strong keys stand with other records, sorted.

    Holders are counted by key and list first, so a key gives a row for each list and not for each record.
    """
    by = ["source_id", "source_key"]
    lists = keys.groupBy("key_type", "key_value", F.col("source_id").alias("other")).agg(F.count_distinct("source_key").alias("n"))
    lists = lists.select(F.concat_ws("\u001f", "key_type", "key_value").alias("__k"), "other", "n")
    mine = cands.select(*by).distinct().join(keys, by).select(*by, F.concat_ws("\u001f", "key_type", "key_value").alias("k"))
    near = mine.join(lists, F.col("k") == F.col("__k")).where((F.col("other") != F.col("source_id")) | (F.col("n") > 1))
    return near.groupBy(*by).agg(F.array_sort(F.collect_set("other")).alias("sources"))


def id_change_suspects(cands: DataFrame, ids: DataFrame, names: DataFrame) -> DataFrame:
    """(source_id, source_key, reason, value, candidate, first_key, n_others): all records of a list that carry a strong identifier or normalised
    primary name which a candidate and at least one other record carry.

    The records of one value are a class, all of whose members are listed; first_key, its smallest key, names it. A candidate suspects every other
    member of its classes, for SHARED_IDENTIFIER where they have such a class, else for SAME_NAME: every pair follows from the rows, which grow with
    the records' values and not with the pairs of a value.
    """
    by = ["source_id", "source_key"]
    strong = ids.where(~F.col("id_type").isin(*WEAK_TYPES))
    value = lambda *c: F.concat_ws(":", *c)
    marks = strong.select(*by, F.lit("SHARED_IDENTIFIER").alias("reason"), value("id_type", "value_norm").alias("value"))
    marks = marks.union(names.select(*by, F.lit("SAME_NAME"), "name_norm")).where("value IS NOT NULL").distinct()
    marks = marks.join(cands.select(*by, F.lit(True).alias("candidate")).distinct(), by, "left").fillna(False, ["candidate"])
    shared = marks.groupBy("source_id", "reason", "value").agg(F.min("source_key").alias("first_key"), (F.count("*") - 1).alias("n_others"), F.bool_or("candidate").alias("__any")).where("n_others > 0 AND __any")
    # another expression than the grouping's, so that both sides get plain exchanges and a hot value can be split
    shared = shared.select(F.col("source_id").alias("__s"), F.col("reason").alias("__r"), F.concat("value", F.lit("")).alias("__v"), "first_key", "n_others")
    return marks.join(shared, (F.col("source_id") == F.col("__s")) & (F.col("reason") == F.col("__r")) & (F.col("value") == F.col("__v"))).drop("__s", "__r", "__v")


def id_change_reasons(cands: DataFrame, ids: DataFrame, names: DataFrame) -> DataFrame:
    """(source_id, source_key, reason, other_key): candidates whose list has another record of the same strong identifier, or
    else of the same normalised primary name, with the smallest such key. Each value is reduced to its two smallest keys
    first, of which one is another's."""
    by = ["source_id", "source_key"]
    strong = ids.where(~F.col("id_type").isin(*WEAK_TYPES))
    marks = strong.select(*by, F.lit(1).alias("p"), F.concat_ws("\u001f", F.lit("i"), "id_type", "value_norm").alias("mark"))
    marks = marks.union(names.select(*by, F.lit(2), F.concat_ws("\u001f", F.lit("n"), "name_norm")))
    least = marks.groupBy("source_id", "mark").agg(F.min("source_key").alias("k1"), F.max("source_key").alias("top"))
    least = least.where("k1 <> top").select(F.col("source_id").alias("__s"), F.upper(F.lit("")).alias("__e"), F.col("mark").alias("__m"), "k1")
    mine = cands.select(*by).distinct().join(marks, by).distinct()
    some = mine.join(least, (F.concat("mark", F.lit("")) == F.concat("__m", "__e")) & (F.col("source_id") == F.col("__s"))).drop("__s", "__m", "__e")
    # only holders of a value's smallest key need its second smallest
    firsts = some.where("k1 = source_key").select("source_id", "mark").distinct()
    second = marks.join(least.select(F.col("__s").alias("source_id"), F.col("__m").alias("mark"), "k1"), ["source_id", "mark"]).where("source_key > k1").join(firsts, ["source_id", "mark"], "left_semi")
    second = second.groupBy("source_id", "mark").agg(F.min("source_key").alias("k2"))
    found = some.join(second, ["source_id", "mark"], "left").withColumn("other", F.when(F.col("k1") == F.col("source_key"), F.col("k2")).otherwise(F.col("k1")))
    best = found.groupBy(*by).agg(F.min(F.struct("p", "other")).alias("b"))
    return best.select(*by, F.when(F.col("b.p") == 1, "SHARED_IDENTIFIER").otherwise("SAME_NAME").alias("reason"), F.col("b.other").alias("other_key"))


def delisting_evidence(cands: DataFrame, links: DataFrame, days: int = 60) -> DataFrame:
    """The best delisting link of each candidate: not rejected, published at most ``days`` before or undated."""
    ok = links.where("link_type = 'DELISTING' AND status <> 'REJECTED'").select("source_id", "source_key", "link_id", "confidence", "published_on")
    near = cands.select("candidate_id", "source_id", "source_key", "created_at").join(ok, ["source_id", "source_key"])
    near = near.where(F.col("published_on").isNull() | (F.col("published_on") >= F.date_sub(F.to_date("created_at"), days)))
    best = F.max_by(F.struct("link_id", "confidence"), F.struct("confidence", F.coalesce("published_on", F.to_date(F.lit("0001-01-01"))), -F.col("link_id")))
    return near.groupBy("candidate_id").agg(best.alias("b"), F.count("*").alias("n_evidence")).select("candidate_id", "b.link_id", "b.confidence", "n_evidence")


def assess(cands: DataFrame, evidence: DataFrame, elsewhere: DataFrame, suspects: DataFrame) -> DataFrame:
    """Status and recommendation of each candidate that still holds its record; nothing is freed here.

    elsewhere and suspects hold (source_id, source_key); decided candidates stay as they are, without a recommendation.
    """
    by = ["source_id", "source_key"]
    out = (
        cands.join(evidence.select("candidate_id", F.lit(True).alias("has_evidence")), "candidate_id", "left")
        .join(elsewhere.select(*by, F.lit(True).alias("elsewhere")).distinct(), by, "left")
        .join(suspects.select(*by, F.lit(True).alias("suspect")).distinct(), by, "left")
        .fillna({"has_evidence": False, "elsewhere": False, "suspect": False})
    )
    holds = F.col("status").isin(*V.HOLDING)
    advice = F.when(F.col("suspect") & ~F.col("has_evidence"), "REJECTED_ID_CHANGE").when(F.col("has_evidence") & F.col("elsewhere"), "STILL_LISTED_ELSEWHERE").when(F.col("has_evidence"), "CONFIRMED")
    status = F.when(F.col("has_evidence") & holds, "EVIDENCE_FOUND").otherwise(F.col("status"))
    return out.withColumns({"recommendation": F.when(holds, advice), "status": status})


def removal_proposals(assessed: DataFrame, elsewhere: DataFrame, open_ones: DataFrame) -> DataFrame:
    """One proposal for each candidate with a recommendation, unless one is open under its dedupe key.

    assessed has candidate_id, source_id, source_key, primary_name and recommendation; elsewhere (source_id, source_key, sources).
    """
    name, source = F.coalesce("primary_name", F.lit("")), F.col("source_id")
    title = (
        F.when(F.col("recommendation") == "CONFIRMED", F.concat(F.lit("Confirm delisting of "), name, F.lit(" from "), source))
        .when(F.col("recommendation") == "STILL_LISTED_ELSEWHERE", F.concat(F.lit("Release the listing of "), name, F.lit(" on "), source, F.lit(", still listed on "), F.array_join("sources", ", ")))
        .otherwise(F.concat(F.lit("Confirm the change of key of "), name, F.lit(" on "), source))
    )
    rows = assessed.where("recommendation IS NOT NULL").join(elsewhere, ["source_id", "source_key"], "left")
    rows = rows.select(
        "candidate_id", F.lit("REMOVAL_CONFIRMATION").alias("kind"), "source_id", F.concat_ws(":", "source_id", "source_key").alias("subject_ref"), title.alias("title"), "recommendation",
        F.concat(F.lit("removal:"), F.col("candidate_id").cast("string")).alias("dedupe_key"),
    )
    return rows.join(open_ones.select("dedupe_key").distinct(), "dedupe_key", "left_anti")


def resolve(cands: DataFrame, decisions: DataFrame) -> DataFrame:
    """Candidates after the last decision on each; REJECTED_PARSER goes on holding."""
    last = decisions.groupBy("candidate_id").agg(F.max_by("resolution", "decision_id").alias("resolution"))
    out = cands.join(last, "candidate_id", "left").withColumn("status", F.coalesce("resolution", "status")).drop("resolution")
    return out.withColumn("held", F.col("status").isin(*V.HOLDING))


def release_held(current: DataFrame, staged: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Diff of retained staging against the current state, with the row-count guard of a release."""
    d = V.promote_relisted(V.diff(current, staged, keys), history, keys)
    n = lambda *k: F.count_if(F.col("change_type").isin(*k))
    return staged.agg(F.count("*").alias("staged")).crossJoin(d.agg(n("ADD", "CHANGE", "SAME", "RELIST").alias("seen"), n("RELIST").alias("relisted"), n("REMOVE").alias("removed")))


def apply_curated(events: DataFrame) -> DataFrame:
    """Active curated entries: the last event of a key counts, leads don't, REMOVE deactivates."""
    return V.latest(events.where("op <> 'LEAD'"), ["entry_key"], F.col("change_id").desc()).where("op <> 'REMOVE'")


def lead_comparison(pages: DataFrame, text: str, ours: DataFrame, key: str) -> DataFrame:
    """Valid ship numbers of outside pages against curated keys: missing here, or extra here."""
    seen = pages.select(F.explode(F.regexp_extract_all(text, F.lit(r"(?<!\d)(\d{7})(?!\d)"), F.lit(1))).alias("imo")).where(T.imo_checksum_ok(F.col("imo"))).distinct()
    mine = ours.select(F.col(key).alias("imo")).distinct()
    return seen.join(mine, "imo", "left_anti").withColumn("side", F.lit("missing")).union(mine.join(seen, "imo", "left_anti").withColumn("side", F.lit("extra")))


def verify_extraction(entries: DataFrame, texts: DataFrame, norm_name: str, norm_text: str) -> DataFrame:
    """Entries checked against their text: quote, name and identifiers must stand there.

    entries(doc_id, entry_no, quote, identifiers array<string>, norm_name); texts(doc_id, text, norm_text).
    """
    both = entries.join(texts, "doc_id", "left")
    squeezed = T.squeeze(F.coalesce("text", F.lit("")))
    packed = T.compact(F.coalesce("text", F.lit("")))
    problems: list[tuple[str, Column]] = [
        ("QUOTE_NOT_FOUND", ~squeezed.contains(T.squeeze(F.col("quote")))),
        ("NAME_NOT_FOUND", ~F.concat(F.lit(" "), F.coalesce(norm_text, F.lit("")), F.lit(" ")).contains(F.concat(F.lit(" "), F.col(norm_name), F.lit(" ")))),
        ("IDENTIFIER_NOT_FOUND", F.exists("identifiers", lambda i: ~packed.contains(T.compact(i)))),
    ]
    found = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(k)) for k, c in problems]), lambda x: x.isNotNull())
    return both.withColumn("problems", found).withColumn("verified", F.size("problems") == 0)


def decide(proposals: DataFrame, decisions: DataFrame, effects: dict[str, str]) -> DataFrame:
    """First valid decision on each pending proposal (maker and checker differ) with the effect of an approval."""
    ok = decisions.join(proposals.where("status = 'PENDING'").select("change_id", "maker", "kind"), "change_id").where("maker <> checker")
    one = V.latest(ok, ["change_id"], F.col("decision_no"), F.col("checker"), F.col("decision"))
    effect = F.lit(None).cast("string")
    for kind, what in effects.items():
        effect = F.when((F.col("decision") == "APPROVED") & (F.col("kind") == kind), what).otherwise(effect)
    return one.select("change_id", "kind", "checker", F.col("decision").alias("status"), effect.alias("effect"))


def new_proposals(batch: DataFrame, open_ones: DataFrame) -> DataFrame:
    """One proposal a dedupe key, none where one is open."""
    one = V.latest(batch, ["dedupe_key"], F.col("change_id"))
    return one.join(open_ones.select("dedupe_key").distinct(), "dedupe_key", "left_anti")

