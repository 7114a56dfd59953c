"""Records matched to landed registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import names as N
from ..functions import text as T
from .fuzzy import pairs
from .versioning import latest


def subjects(current: DataFrame, results: DataFrame, as_of: Column, refresh_days: int, n: int, types: tuple[str, ...]) -> DataFrame:
    """Newest current records of the wanted types that have no live result younger than the refresh time."""
    young = results.where((F.col("superseded_by").isNull()) & (F.to_date("fetched_at") > F.date_sub(F.to_date(as_of), refresh_days))).select("source_id", "source_key").distinct()
    return current.where(F.col("entity_type").isin(*types)).join(young, ["source_id", "source_key"], "left_anti").orderBy(F.col("created_at").desc(), "source_key").limit(n)


def near_names(names: DataFrame, registered: DataFrame) -> DataFrame:
    """(core, r_core, score) of the distinct core names on both sides that share a rare token; names(core), registered(r_core).

    A name of n tokens is looked up by the n - ceil(n / 2) + 1 of them that are rarest in the register, so every pair that
    shares half of the tokens of both meets, and common tokens (which are looked up last) make few pairs. Both sides of
    the join are plain, so that the tasks of a hot token can be split.
    """
    tokens = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda t: t != ""))
    registered = registered.select("r_core").distinct()
    often = registered.select(F.explode(tokens("r_core")).alias("t")).groupBy("t").agg(F.count("*").alias("n")).select(F.col("t").alias("__t"), "n")

    def rare(df: DataFrame, core: str) -> DataFrame:
        one = df.select(core, F.explode(tokens(core)).alias("t"))
        seen = one.join(often, F.col("t") == F.col("__t"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
        listed = seen.groupBy(core).agg(F.array_sort(F.collect_list(F.struct("n", "t"))).alias("ts"))
        n = F.size("ts")
        return listed.select(core, F.explode(F.slice("ts", F.lit(1), n - F.ceil(n / 2).cast("int") + 1)).alias("x")).select(core, F.col("x.t").alias("t"))

    met = rare(names.select("core").distinct(), "core").join(rare(registered, "r_core"), "t").select("core", "r_core").distinct()
    return met.withColumn("score", N.name_score(F.col("core"), F.col("r_core")))


def legal_entities(subj: DataFrame, registry: DataFrame, review: float = 0.85) -> DataFrame:
    """Ladder: valid LEI, then a registration number that is unique in its country, then the best name.

    subj(subject_id, lei, lei_valid, reg_norm, country, core); registry(lei, reg_norm, country, core). Names are compared
    within the subject's country, or in all countries for a subject without one. Where that leaves a subject below the
    review score, names of every country are compared, and one of another country costs 0.15. Of equal scores the smallest
    LEI counts. Only scores that reach the review score are looked for, all of them (``fuzzy.pairs``); a subject without one is NO_MATCH
    with score 0.
    """
    r = registry.select(F.col("lei").alias("r_key"), F.col("reg_norm").alias("r_reg"), F.col("country").alias("r_country"), F.col("core").alias("r_core"))
    hit = lambda df, method, score, tier: df.select("subject_id", "r_key", F.lit(method).alias("match_method"), score.alias("score"), F.lit(tier).alias("tier"))
    by_lei = hit(subj.where("lei_valid").join(r, F.col("lei") == F.col("r_key")), "LEI", F.lit(1.0), 1)
    alone = r.withColumn("__n", F.count("*").over(Window.partitionBy("r_reg", "r_country"))).where("__n = 1 AND r_reg <> ''")
    by_reg = hit(subj.join(alone, (F.col("reg_norm") == F.col("r_reg")) & (F.col("country") == F.col("r_country"))), "REGISTRATION_NUMBER", F.lit(1.0), 2)
    left = subj.join(by_lei.union(by_reg).select("subject_id").distinct(), "subject_id", "left_anti").select("subject_id", "country", "core")

    alike = pairs(left, r, review)
    at_home = r.groupBy("r_core", "r_country").agg(F.min("r_key").alias("r_key"))
    anywhere = r.groupBy("r_core").agg(F.min("r_key").alias("r_key"))
    wanted = left.select("core", "country").distinct().join(alike, "core")
    top = lambda df: df.groupBy("core", "country").agg(F.min(F.struct((-F.col("score")).alias("s"), "r_key")).alias("m")).select("core", "country", (-F.col("m.s")).alias("score"), "m.r_key")
    own = wanted.join(at_home.withColumnRenamed("r_country", "country"), ["r_core", "country"]).select("core", "country", "score", "r_key")
    own = top(own.union(wanted.where("country IS NULL").join(anywhere, "r_core").select("core", "country", "score", "r_key")))
    reached = own.where(F.col("score") >= review).select("core", F.col("country").alias("__c")).distinct()
    short = wanted.where("country IS NOT NULL").join(reached.withColumnRenamed("core", "__core"), (F.col("core") == F.col("__core")) & (F.col("country") == F.col("__c")), "left_anti")
    # an entity of the subject's own country stands among ``own`` with more, so it needs no exception here
    other = short.join(anywhere, "r_core").select("core", "country", F.round(F.col("score") - 0.15, 4).alias("score"), "r_key").where(F.col("score") >= review)
    best_name = top(own.union(other)).select(F.col("core").alias("__core"), F.col("country").alias("__c"), "score", "r_key")
    by_name = hit(left.join(best_name, (F.col("core") == F.col("__core")) & F.col("country").eqNullSafe(F.col("__c"))), "NAME_COUNTRY", F.col("score"), 3)
    best = latest(by_lei.union(by_reg).union(by_name), ["subject_id"], F.col("tier"), F.col("score").desc(), F.col("r_key"))
    out = subj.select("subject_id").join(best, "subject_id", "left").fillna({"score": 0.0, "match_method": "NAME_COUNTRY"})
    state = F.when(F.col("tier") < 3, "AUTO_ACCEPTED").otherwise(N.decision(F.col("score"), review=review))
    return out.withColumn("status", state).withColumn("provider_key", F.when(state != "NO_MATCH", F.col("r_key"))).drop("r_key", "tier")


def parents(accepted: DataFrame, links: DataFrame) -> DataFrame:
    """Direct and ultimate parents of accepted entities. links(lei, parent, kind)."""
    side = lambda k: links.where(F.col("kind") == k).select(F.col("lei").alias("provider_key"), F.col("parent").alias(f"{k.lower()}_parent"))
    return accepted.join(side("DIRECT"), "provider_key", "left").join(side("ULTIMATE"), "provider_key", "left")


def companies(subj: DataFrame, registry: DataFrame, review: float = 0.85) -> DataFrame:
    """Company register: registration numbers of 6 to 8 characters, home country or unknown, exactly; else the best name.

    subj(subject_id, country, reg_norm, core); registry(number, core). Every wanted subject (home country or unknown) gets a
    row; all names that reach the review score are found (``fuzzy.pairs``), of equal scores the smallest number counts, and a subject
    without one is NO_MATCH with score 0 and no key. Its ``near_score`` is the best among the names that share a rare token with it
    (``near_names``), 0 without any; for all others it is the score.
    """
    wanted = subj.where(F.col("country").isNull() | (F.col("country") == "GB")).select("subject_id", "reg_norm", "core")
    r = registry.select(F.col("number").alias("r_key"), F.col("core").alias("r_core"))
    exact = wanted.where(F.length("reg_norm").between(6, 8)).join(r, F.col("reg_norm") == F.col("r_key")).select("subject_id", "r_key", F.lit("REGISTRATION_NUMBER").alias("match_method"), F.lit(1.0).alias("score"), F.lit(1).alias("tier"))
    left = wanted.join(exact.select("subject_id").distinct(), "subject_id", "left_anti").select("subject_id", "core")
    first = r.groupBy("r_core").agg(F.min("r_key").alias("r_key"))
    top = pairs(left, r, review).join(first, "r_core").groupBy("core").agg(F.min(F.struct((-F.col("score")).alias("s"), "r_key")).alias("m"))
    named = left.join(top.select(F.col("core").alias("__core"), "m"), F.col("core") == F.col("__core")).select("subject_id", "m.r_key", F.lit("NAME").alias("match_method"), (-F.col("m.s")).alias("score"), F.lit(2).alias("tier"))
    best = latest(exact.union(named), ["subject_id"], F.col("tier"), F.col("score").desc(), F.col("r_key"))
    out = wanted.select("subject_id", "core").join(best, "subject_id", "left").fillna({"score": 0.0, "match_method": "NAME"})
    none = left.join(named.select("subject_id").distinct(), "subject_id", "left_anti").where("core IS NOT NULL")
    near = near_names(none, r).groupBy(F.col("core").alias("__core")).agg(F.max("score").alias("__near"))
    out = out.join(near, (F.col("core") == F.col("__core")) & F.col("tier").isNull(), "left").withColumn("near_score", F.greatest("score", F.coalesce("__near", F.lit(0.0)))).drop("core", "__core", "__near")
    state = F.when(F.col("tier") == 1, "AUTO_ACCEPTED").otherwise(N.decision(F.col("score"), review=review))
    return out.withColumn("status", state).withColumn("provider_key", F.when(state != "NO_MATCH", F.col("r_key"))).drop("r_key", "tier")


def aircraft(subj: DataFrame, master: DataFrame, models: DataFrame) -> DataFrame:
    """Tail number exactly; else serial number, accepted outright only if the models contain one another.

    subj(subject_id, tail, serial, model); master(n_number, serial, code, pos); models(code, model).
    """
    m = master.join(models.select("code", F.upper("model").alias("r_model")), "code", "left").select(F.regexp_replace(T.compact(F.col("n_number")), "^N", "").alias("n"), T.compact(F.col("serial")).alias("s"), "r_model", "pos")
    # of the records of a number only the first by position can win, so only that one meets the subjects
    first = lambda key: m.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("pos", "n", "r_model") if key == "s" else F.struct("pos")).alias("m"))
    tail = subj.select("subject_id", T.compact(F.col("tail")).alias("t")).where(F.col("t").startswith("N")).select("subject_id", F.regexp_replace("t", "^N", "").alias("n"))
    by_tail = tail.join(first("n"), "n").select("subject_id", "n", F.lit("TAIL_NUMBER").alias("match_method"), F.lit(1.0).alias("score"), F.lit(1).alias("tier"), "m.pos")
    ser = subj.select("subject_id", T.compact(F.col("serial")).alias("s"), F.upper(F.coalesce("model", F.lit(""))).alias("model")).where("s <> ''")
    same = (F.col("model") != "") & F.col("r_model").isNotNull() & (F.contains("model", "r_model") | F.contains("r_model", "model"))
    by_serial = ser.join(first("s"), "s").select("subject_id", "model", "m.*").select("subject_id", "n", F.lit("SERIAL_NUMBER").alias("match_method"), F.when(same, 1.0).otherwise(0.9).alias("score"), F.lit(2).alias("tier"), "pos")
    best = latest(by_tail.union(by_serial), ["subject_id"], F.col("tier"), F.col("pos"))
    return best.select("subject_id", F.concat(F.lit("N"), "n").alias("provider_key"), "match_method", "score", F.when(F.col("score") >= 1, "AUTO_ACCEPTED").otherwise("NEEDS_REVIEW").alias("status"))


def leads(subj: DataFrame, registry: DataFrame, least: int = 6) -> DataFrame:
    """Same core name in a leaks register: the first hit by position and how many more; never accepted by itself."""
    nodes = registry.where(F.length("core") >= least).groupBy("core").agg(F.min_by("node_id", F.struct("pos", "node_id")).alias("provider_key"), (F.count("*") - 1).alias("others"))
    return subj.join(nodes, "core").select("subject_id", "provider_key", "others", F.lit("NEEDS_REVIEW").alias("status"))


def fold(rows: DataFrame) -> DataFrame:
    """Triples of an entity folded to one row: owners as a sorted set, the last filled flag, the first label.

    rows(key_type, key, pos, label, flag, owner).
    """
    return rows.groupBy("key_type", "key").agg(
        F.array_sort(F.collect_set("owner")).alias("owners"),
        F.max_by("flag", F.when(F.col("flag").isNotNull(), F.col("pos"))).alias("flag"),
        F.min_by("label", F.when(F.col("label").isNotNull(), F.col("pos"))).alias("label"),
    )


def graph(subj: DataFrame, folded: DataFrame) -> DataFrame:
    """Valid ship number first, then legal-entity number. subj(subject_id, key_type, key)."""
    order = F.when(F.col("key_type") == "IMO", 0).otherwise(1)
    return latest(subj.join(folded, ["key_type", "key"]), ["subject_id"], order, F.col("key"))


def newest_results(results: DataFrame) -> DataFrame:
    """Live results: the newest of each (subject, provider)."""
    return latest(results, ["subject_id", "provider"], F.col("result_id").desc())


def review_proposals(results: DataFrame, open_keys: DataFrame, cap: int = 50) -> DataFrame:
    """Proposals for results that need review: deduped, best scores first, at most ``cap`` a run."""
    need = results.where("status = 'NEEDS_REVIEW'").withColumn("dedupe_key", F.concat_ws("|", "provider", "subject_id"))
    need = need.dropDuplicates(["dedupe_key"]).join(open_keys.select("dedupe_key"), "dedupe_key", "left_anti")
    return need.orderBy(F.col("score").desc(), "dedupe_key").limit(cap)
