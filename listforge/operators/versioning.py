"""Diff, append-only versions, snapshots and as-of reads.

A list's history is a log (source_id, seq, source_key, change_type, ...), partitioned by source and sequence and never
updated. Validity intervals, current rows and as-of reads are derived from it by one window over the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.names import normalize_name

#: Removal candidates in these states keep their record in screening.
HOLDING = ("PENDING", "EVIDENCE_FOUND", "REJECTED_PARSER")


def diff(old: DataFrame, new: DataFrame, keys: Sequence[str], hash_col: str = "content_hash", keep: Sequence[str] = ()) -> DataFrame:
    """keys, change_type (ADD, REMOVE, CHANGE, SAME), both hashes and ``keep`` columns (new value first, else old).

    Only keys, hashes and kept columns are shuffled; documents are joined later for changed keys alone.
    """
    o = old.select(*keys, F.col(hash_col).alias("old_hash"), *[F.col(c).alias(f"__o_{c}") for c in keep])
    n = new.select(*keys, F.col(hash_col).alias("new_hash"), *[F.col(c).alias(f"__n_{c}") for c in keep])
    kind = (
        F.when(F.col("old_hash").isNull(), "ADD").when(F.col("new_hash").isNull(), "REMOVE").when(F.col("old_hash") != F.col("new_hash"), "CHANGE").otherwise("SAME")
    )
    return o.join(n, list(keys), "full_outer").select(
        *keys, kind.alias("change_type"), "old_hash", "new_hash", *[F.coalesce(f"__n_{c}", f"__o_{c}").alias(c) for c in keep]
    )


def preview(changes: DataFrame) -> DataFrame:
    """One row of counts: added, removed, changed, unchanged, previous."""
    n = lambda *kinds: F.count_if(F.col("change_type").isin(*kinds))
    return changes.agg(n("ADD", "RELIST").alias("added"), n("REMOVE").alias("removed"), n("CHANGE").alias("changed"), n("SAME").alias("unchanged"), n("REMOVE", "CHANGE", "SAME").alias("previous"))


def promote_relisted(changes: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ADD becomes RELIST where the key was in any earlier version."""
    seen = history.select(*keys).distinct().withColumn("__seen", F.lit(True))
    kind = F.when((F.col("change_type") == "ADD") & F.col("__seen"), "RELIST").otherwise(F.col("change_type"))
    return changes.join(seen, list(keys), "left").withColumn("change_type", kind).drop("__seen")


def log_rows(changes: DataFrame, seq: int) -> DataFrame:
    """What a publish appends: everything but SAME, under its sequence."""
    return changes.where("change_type <> 'SAME'").withColumn("seq", F.lit(seq))


def validity(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Log -> versions valid in [valid_from_seq, valid_to_seq); REMOVE rows only close the one before."""
    w = Window.partitionBy(*keys).orderBy("seq")
    return log.withColumn("valid_to_seq", F.lead("seq").over(w)).where("change_type <> 'REMOVE'").withColumnRenamed("seq", "valid_from_seq")


def version_id(*cols: str) -> Column:
    """Surrogate key that a rerun gives again."""
    return F.sha2(F.concat_ws("|", *cols), 256)


def as_of(versions: DataFrame, pins: DataFrame) -> DataFrame:
    """Versions valid at the sequence that a snapshot pins for their source. pins(source_id, pin) has a row a source."""
    valid = (F.col("valid_from_seq") <= F.col("pin")) & (F.col("valid_to_seq").isNull() | (F.col("valid_to_seq") > F.col("pin")))
    return versions.join(pins, "source_id").where(valid)


def as_of_with_holds(versions: DataFrame, pins: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """As-of rows plus the last version of every held removal, which stays in screening."""
    live = as_of(versions, pins).drop("pin")
    w = Window.partitionBy(*keys).orderBy(F.col("valid_from_seq").desc())
    last = versions.join(held.select(*keys).distinct(), list(keys), "left_semi").withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
    return live.withColumn("held", F.lit(False)).unionByName(last.withColumn("held", F.lit(True)))


def latest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def field_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], fields: Sequence[str], arrays: Sequence[str] = (), limit: int = 20) -> DataFrame:
    """Changed fields, and for array fields the values that came and went (sorted, at most ``limit``)."""
    o = old.select(*keys, *[F.col(c).alias(f"__o_{c}") for c in (*fields, *arrays)])
    both = new.join(o, list(keys))
    changed = F.filter(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__o_{c}")), F.lit(c)) for c in (*fields, *arrays)]), lambda x: x.isNotNull())
    sides = {}
    for c in arrays:
        sides[f"{c}_added"] = F.slice(F.array_sort(F.array_except(c, f"__o_{c}")), 1, limit)
        sides[f"{c}_removed"] = F.slice(F.array_sort(F.array_except(f"__o_{c}", c)), 1, limit)
    return both.select(*keys, changed.alias("changed_fields"), *[v.alias(k) for k, v in sides.items()]).where(F.size("changed_fields") > 0)


def children(docs: DataFrame, keys: Sequence[str], array: str, offset: Column | None = None) -> DataFrame:
    """An array of structs as a child table with its order."""
    out = docs.select(*keys, (offset if offset is not None else F.lit(0)).alias("__off"), F.posexplode(array).alias("ord", "__c"))
    return out.select(*keys, (F.col("ord") + F.col("__off")).alias("ord"), "__c.*")


def child_tables(records: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """The nine child tables of canonical records, each with keys and ``ord``, the place in the record.

    Country codes that don't have two characters are null. Birth dates and birth places are one table under one numbering,
    dates first. Vessel and aircraft have one row for records that carry them.
    """
    def iso2(row: DataFrame) -> DataFrame:
        return row.withColumns({c: F.when(F.length(c) == 2, F.col(c)) for c in row.columns if c.endswith("_iso2")})

    def single(name: str, drop: Sequence[str] = ()) -> DataFrame:
        return iso2(records.where(F.col(name).isNotNull()).select(*keys, F.lit(0).alias("ord"), f"{name}.*").drop(*drop))

    many = {"name": "names", "identifier": "identifiers", "address": "addresses", "nationality": "countries", "listing": "listings", "relationship": "relationships"}
    out = {table: iso2(children(records, keys, column)) for table, column in many.items()}
    out["name"] = out["name"].withColumns({"quality": F.coalesce("quality", F.lit("UNKNOWN")), "normalized_name": normalize_name(F.col("full_name"))})
    born = children(records, keys, "birth_dates").withColumn("kind", F.lit("DOB"))
    places = children(records, keys, "birth_places", F.coalesce(F.size("birth_dates"), F.lit(0))).withColumn("kind", F.lit("POB"))
    out["birth"] = born.unionByName(iso2(places), allowMissingColumns=True)
    out["vessel"], out["aircraft"] = single("vessel", ("former_flags", "former_names")), single("aircraft")
    return out


def open_removals(changes: DataFrame, open_candidates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New removal candidates: removed keys without an open candidate."""
    return changes.where("change_type = 'REMOVE'").select(*keys).join(open_candidates.select(*keys), list(keys), "left_anti")


def close_relisted(candidates: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates whose key is back, as RELISTED events."""
    back = changes.where("change_type IN ('ADD', 'RELIST')").select(*keys)
    return candidates.join(back, list(keys), "left_semi").withColumn("status", F.lit("RELISTED"))


def supersede(versions: DataFrame) -> DataFrame:
    """Status of each version once a newer one is published: older PUBLISHED and HELD ones are SUPERSEDED."""
    w = Window.partitionBy("source_id")
    top = F.max(F.when(F.col("status") == "PUBLISHED", F.col("seq"))).over(w)
    return versions.withColumn("status", F.when(F.col("status").isin("PUBLISHED", "HELD") & (F.col("seq") < top), "SUPERSEDED").otherwise(F.col("status")))


def snapshot(versions: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: the published sequence of each source and the ids of all held removals, both sorted."""
    pins = versions.where("status = 'PUBLISHED'").groupBy("source_id").agg(F.max("seq").alias("seq"))
    held = candidates.where(F.col("status").isin(*HOLDING)).agg(F.array_sort(F.collect_list("candidate_id")).alias("held_removal_ids"))
    return pins.agg(F.array_sort(F.collect_list(F.struct("source_id", "seq"))).alias("pins")).crossJoin(held)


def json_paths(df: DataFrame, keys: Sequence[str], path: str, value: str, version: str, sensitive: Sequence[str]) -> DataFrame:
    """Paths whose value differs from the version before, with a mark on sensitive ones."""
    before = df.select(*keys, (F.col(version) + 1).alias(version), path, F.col(value).alias("old_value"), F.lit(True).alias("__old"))
    first = df.groupBy(*keys).agg(F.min(version).alias("__first"), F.max(version).alias("__last"))
    both = df.withColumn("__new", F.lit(True)).join(before, [*keys, version, path], "full_outer").join(first, list(keys))
    marks = F.array(*[F.lit(s) for s in sensitive])
    return (
        both.where((F.col(version) > F.col("__first")) & (F.col(version) <= F.col("__last")) & ~F.col(value).eqNullSafe(F.col("old_value")))
        .select(*keys, version, path, "old_value", F.col(value).alias("new_value"), F.arrays_overlap(F.split(path, r"\."), marks).alias("sensitive"))
    )


def audit(old: DataFrame, new: DataFrame, key: str, cols: Sequence[str], actor: str) -> DataFrame:
    """Append-only audit rows: operation, old and new row as JSON."""
    pack = lambda: F.to_json(F.struct(*cols))
    o, n = old.select(key, pack().alias("old_row")), new.select(key, pack().alias("new_row"))
    op = F.when(F.col("old_row").isNull(), "INSERT").when(F.col("new_row").isNull(), "DELETE").otherwise("UPDATE")
    both = o.join(n, key, "full_outer").where(~F.col("old_row").eqNullSafe(F.col("new_row")))
    return both.select(key, op.alias("op"), "old_row", "new_row", F.lit(actor).alias("actor"))
