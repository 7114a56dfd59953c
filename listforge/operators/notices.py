"""Legal notices matched to records, set-wise for all notices at once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

UN_REF = r"\b([A-Z]{2}[ie]\.\d{3})\b"


def new_notices(batch: DataFrame, known: DataFrame) -> DataFrame:
    """First of each (provider, external_id) that isn't stored yet, texts cut to their stored lengths."""
    w = Window.partitionBy("provider", "external_id").orderBy("position")
    one = batch.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
    fresh = one.join(known.select("provider", "external_id"), ["provider", "external_id"], "left_anti")
    return fresh.withColumns({"title": F.left("title", F.lit(1000)), "excerpt": F.left("text", F.lit(4000))})


def references(notices: DataFrame, pattern: str = UN_REF) -> DataFrame:
    """(notice_id, ref, norm): distinct references in title and text."""
    full = F.concat_ws("\n", "title", "text")
    return notices.select("notice_id", F.explode(F.array_distinct(F.regexp_extract_all(full, F.lit(pattern), F.lit(1)))).alias("ref")).withColumn("norm", T.compact(F.col("ref")))


def id_links(notices: DataFrame, refs: DataFrame, keys: DataFrame, key_type: str = "UN_REF") -> DataFrame:
    """Links of records that carry a reference, typed by the words around it, with a quote. keys(key_type, key_value, source_id, source_key)."""
    own = keys.where(F.col("key_type") == key_type).select(F.col("key_value").alias("norm"), "source_id", "source_key").distinct()
    full = F.concat_ws("\n", "title", "text")
    # a key may stand for many records: the words around a reference are read once for each (notice, reference), before its records are joined
    known = refs.join(own.select("norm").distinct(), "norm", "left_semi").join(notices.select("notice_id", full.alias("full"), "action_types"), "notice_id")
    read = known.select("notice_id", "norm", T.link_type_near(F.col("full"), F.col("ref"), F.col("action_types")).alias("link_type"), T.quote(F.col("full"), F.col("ref")).alias("verbatim_quote"))
    return read.join(own, "norm").select("notice_id", "source_id", "source_key", "link_type", F.lit("ID_MATCH").alias("method"), F.lit(1.0).alias("confidence"), "verbatim_quote")


def removed_id_links(refs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Open removal candidates whose own key is the raw reference; always delistings."""
    open_ones = candidates.where("status IN ('PENDING', 'EVIDENCE_FOUND')").select(F.col("source_key").alias("ref"), "source_id").distinct()
    return refs.join(open_ones, "ref").select("notice_id", "source_id", F.col("ref").alias("source_key"), F.lit("DELISTING").alias("link_type"), F.lit("ID_MATCH").alias("method"), F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("verbatim_quote"))


#: Characters of distinct names in one automaton, which takes some sixty bytes for each in every task.
SHARD_CHARS = 4 << 20


def names_in_texts(texts: DataFrame, names: DataFrame, least_chars: int = 6, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """(notice_id, name_id): normalised names that stand whole inside normalised texts.

    texts(notice_id, norm), names(name_id, name). Names of one token or few characters are too common to count. The distinct names form
    an Aho-Corasick automaton, which each batch of texts passes once; only hits are shuffled, to find the ids of their names.
    Names are dealt to as many automata as their characters need, each with a pass of its own; nothing larger than one of them
    comes to the driver or a task.
    """
    wanted = names.where((F.length("name") >= least_chars) & F.contains("name", F.lit(" "))).select("name_id", "name")
    distinct = wanted.select("name").distinct()
    chars = distinct.agg(F.sum(F.length("name") + 2)).first()[0] or 0
    shards = max(1, -(-chars // shard_chars))
    hits = [_hits(texts, [r["name"] for r in distinct.where(F.pmod(F.xxhash64("name"), F.lit(shards)) == k).collect()]) for k in range(shards)]
    found = reduce(DataFrame.union, hits).withColumnRenamed("name", "__name")
    return found.join(wanted, F.col("__name") == F.col("name")).select("notice_id", "name_id")


def _hits(texts: DataFrame, names: list[str]) -> DataFrame:
    """(notice_id, name): each name of a list that stands in a text, once a text."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for name in names:
        automaton.add_word(f" {name} ", name)
    automaton.make_automaton()
    held = texts.sparkSession.sparkContext.broadcast(automaton if names else None)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = held.value
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(1).to_pylist() if find else []):
                here = {name for _, name in find.iter(f" {text} ")} if text else ()
                rows += [row] * len(here)
                found += here
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, pa.string())], names=["notice_id", "name"])

    pair = texts.select("notice_id", "norm")
    return pair.mapInArrow(search, f"notice_id {pair.dtypes[0][1]}, name string")


def name_links(hits: DataFrame, notices: DataFrame, events: DataFrame, as_of: Column, days: int = 45) -> DataFrame:
    """Hits on records that changed near the notice's date, if the notice announces that kind of action.

    events(name_id, source_id, source_key, change_type, created_at).
    """
    both = hits.join(events.where("change_type IN ('ADD', 'REMOVE', 'RELIST')"), "name_id").join(notices.select("notice_id", "published_on", "action_types"), "notice_id")
    published, kind = F.coalesce("published_on", F.to_date(as_of)), F.when(F.col("change_type") == "REMOVE", "DELISTING").otherwise("LISTING")
    near = F.abs(F.datediff(F.to_date("created_at"), published)) <= days
    said = (F.size("action_types") == 0) | F.array_contains("action_types", kind)
    return both.where(near & said).select("notice_id", "source_id", "source_key", kind.alias("link_type"), F.lit("NAME_MATCH").alias("method"), F.lit(0.9).alias("confidence"))


def dedupe_links(links: DataFrame) -> DataFrame:
    """One link for (notice, source, key, type); a match by id wins over one by name."""
    w = Window.partitionBy("notice_id", "source_id", "source_key", "link_type").orderBy(F.when(F.col("method") == "ID_MATCH", 0).otherwise(1), F.col("confidence").desc())
    return links.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def statuses(notices: DataFrame, links: DataFrame, pending: int) -> DataFrame:
    """MATCHED with links; else NEEDS_AGENT for delistings while removals are pending; else NO_MATCH."""
    n = links.groupBy("notice_id").agg(F.count("*").alias("links"))
    state = F.when(F.col("links") > 0, "MATCHED").when(F.array_contains("action_types", "DELISTING") & F.lit(pending > 0), "NEEDS_AGENT").otherwise("NO_MATCH")
    return notices.join(n, "notice_id", "left").fillna(0, ["links"]).withColumn("extraction_status", state)


def signals(notices: DataFrame, sources: DataFrame, as_of: Column, days: int = 2) -> DataFrame:
    """One signal for each existing target of a fresh or undated notice."""
    fresh = notices.where(F.col("published_on").isNull() | (F.col("published_on") >= F.date_sub(F.to_date(as_of), days)))
    out = fresh.select("notice_id", "external_id", F.explode("signal_for").alias("target_source_id"))
    out = out.join(sources.select(F.col("source_id").alias("target_source_id")).distinct(), "target_source_id", "left_semi")
    return out.withColumn("signal_id", F.concat("external_id", F.lit("->"), "target_source_id")).dropDuplicates(["signal_id"])


def consumed(sigs: DataFrame, publishes: DataFrame) -> DataFrame:
    """Each signal with the first publish of its target behind it, if any.

    No signal meets all publishes of its target: those of its own hour are searched in time order, and the first of the later hours
    comes from a table of a row for each target and hour.
    """
    by = ["target_source_id", "__hour"]
    hour = lambda df, at: df.withColumn("__hour", F.date_trunc("hour", at))
    pub = hour(publishes.select(F.col("source_id").alias("target_source_id"), F.col("published_at").alias("__at")).where("target_source_id IS NOT NULL AND __at IS NOT NULL").distinct(), "__at")
    asked = hour(sigs.withColumn("__at", F.col("observed_at")), "__at").withColumns({"__asks": F.lit(True), "__pub": F.lit(None).cast(pub.schema["__at"].dataType)})
    back = Window.partitionBy(*by).orderBy(F.col("__at").desc())
    same = asked.unionByName(pub.withColumns({"__asks": F.lit(False), "__pub": F.col("__at")}), allowMissingColumns=True).withColumn("__same", F.min("__pub").over(back)).where("__asks")
    hours = asked.select(*by, "__pub").union(pub.select(*by, F.col("__at"))).groupBy(*by).agg(F.min("__pub").alias("__first"))
    after = Window.partitionBy("target_source_id").orderBy(F.col("__hour").desc()).rowsBetween(Window.unboundedPreceding, -1)
    later = hours.select(F.col("target_source_id").alias("__t"), F.col("__hour").alias("__h"), F.min("__first").over(after).alias("__later"))
    out = same.join(later, (F.col("target_source_id") == F.col("__t")) & (F.col("__hour") == F.col("__h")), "left")
    return out.select(*sigs.columns, F.coalesce("__same", "__later").alias("consumed_at"))
