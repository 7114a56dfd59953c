"""Delta-maintained token-count rollups with idempotent batch commits.

State is a folder of immutable batches. A committed batch holds
* ``current``: the current entries (doc_id, tokenizer, source, lang, n_tokens) of every bucket of doc_ids that it touched, and what
  each changed entry was before, and
* ``delta``: signed sums (n_docs, n_tokens) by (source, lang, tokenizer).
The totals are the sum of all deltas. An insert adds; a delete retracts the current entry; a revision retracts it and adds
the new count. Insert and revise both say what an entry is from now on: inserting an entry that is there revises it, revising one
that isn't there inserts it. A bucket's current entries are those of the last committed batch that has it, so a batch reads and writes the
buckets that it touches and no history. The number of buckets follows the number of entries (``BUCKET_ENTRIES``); a batch that makes
them more than twice as large deals all of them anew. Each batch's folder names the number. A batch is written under its id and becomes visible by its ``delta/_SUCCESS`` marker,
which is written last; a batch that already has one is left alone, so delivering it again changes nothing, and a job that
died half-way is simply run again.

Defined results: a null text has no tokens; null source or lang form groups of their own; rows without doc_id are refused
by the filter in ``apply`` (they can't be retracted). Within a batch, of several changes to one (doc_id, tokenizer) the
deletion wins, else the largest count. Deleting what isn't there changes nothing. Empty batches commit and change nothing;
without batches there are no totals. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable, new_path
from . import kernel
from .tokens import default_path, word_ids

ENTRY = "doc_id long, tokenizer string, source string, lang string, n_tokens long, live boolean, changed boolean, had boolean, o_source string, o_lang string, o_tokens long"
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
KEYS = ("source", "lang", "tokenizer")
#: Entries of a bucket.
BUCKET_ENTRIES = 100_000


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """docs' doc_id, source, lang and n_tokens by a tokenizer file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(tokenizer)
        for b in batches:
            data, off = kernel.utf8(b.column("text"))
            n = [len(ids.text(data[off[i] : off[i + 1]].tobytes())) // 4 for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", "source", "lang")] + [pa.array(np.array(n, dtype=np.int64))], ["doc_id", "source", "lang", "n_tokens"])

    picked = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("lang").cast("string"), "text")
    return picked.mapInArrow(run, "doc_id long, source string, lang string, n_tokens long")


class Rollup:
    """The state under ``path``; batches are numbered in commit order, entries lie in buckets by doc_id, of a number that is given or follows their size."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, bucket_entries: int = BUCKET_ENTRIES):
        self.spark, self.path, self.buckets, self.bucket_entries = spark, path or new_path(spark, "rollup"), buckets, bucket_entries

    def _fs(self):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def _names(self, path: str) -> list[str]:
        fs, make = self._fs()
        return [s.getPath().getName() for s in fs.listStatus(make(path))] if fs.exists(make(path)) else []

    def committed(self) -> list[str]:
        fs, make = self._fs()
        return sorted(n for n in self._names(self.path) if fs.exists(make(f"{self.path}/{n}/delta/_SUCCESS")))

    def _places(self) -> tuple[int, dict[int, str]]:
        """(number of buckets, folder of each bucket's current entries)."""
        buckets, last = 0, {}
        for batch in self.committed():
            number = next(int(n.removeprefix("buckets=")) for n in self._names(f"{self.path}/{batch}") if n.startswith("buckets="))
            if number != buckets:  # all buckets were dealt anew
                buckets, last = number, {}
            last |= {int(n.removeprefix("bucket=")): f"{self.path}/{batch}/current/{n}" for n in self._names(f"{self.path}/{batch}/current") if n.startswith("bucket=")}
        return buckets, last

    def entries(self, wanted: set[int] | None = None) -> DataFrame:
        """The current entries, of all buckets or the wanted ones."""
        paths = [p for b, p in sorted(self._places()[1].items()) if wanted is None or b in wanted]
        rows = self.spark.read.schema(ENTRY).parquet(*paths) if paths else self.spark.createDataFrame([], ENTRY)
        return rows.where("live").select("doc_id", "tokenizer", "source", "lang", "n_tokens")

    def apply(self, batch_id: str, changes: DataFrame) -> bool:
        """Commit changes(doc_id, tokenizer, op, source, lang, n_tokens), op insert, revise or delete. False: known already.

        ``batch_id`` must sort behind the committed ones.
        """
        done = self.committed()
        if batch_id in done:
            return False
        if done and batch_id < done[-1]:
            raise ValueError(f"{batch_id} comes before {done[-1]}")
        one = durable(
            changes.where(F.col("doc_id").isNotNull())
            .groupBy("doc_id", "tokenizer")
            .agg(F.max(F.struct((F.col("op") == "delete").alias("gone"), "n_tokens", "source", "lang")).alias("c"))
            .select("doc_id", "tokenizer", "c.*"),
            "changes",
        )
        buckets = was = self._places()[0]
        if self.buckets:
            buckets = self.buckets
        else:
            most = (self.totals().agg(F.sum("n_docs")).first()[0] or 0) + one.count()
            if most > 2 * buckets * self.bucket_entries or not buckets:
                buckets = 1 << (max(1, -(-most // self.bucket_entries)) - 1).bit_length()
        dealt_anew = buckets != was
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")
        # as many rows as there are buckets at most
        touched = None if dealt_anew else {r[0] for r in one.select(bucket.alias("b")).distinct().collect()}
        old = self.entries(touched).withColumnsRenamed({"source": "o_source", "lang": "o_lang", "n_tokens": "o_tokens"}).withColumn("had", F.lit(True))
        both = one.withColumn("changed", F.lit(True)).join(old, ["doc_id", "tokenizer"], "full_outer").fillna(False, ["had", "changed"])
        now = lambda new, was: F.when(F.col("changed"), F.col(new)).otherwise(F.col(was)).alias(new)
        at = f"{self.path}/{batch_id}"
        current = f"{at}/current"
        fs, make = self._fs()
        for name in self._names(at):  # of a batch that died before its marker
            if name.startswith("buckets="):
                fs.delete(make(f"{at}/{name}"), True)
        fs.mkdirs(make(f"{at}/buckets={buckets}"))
        both.select(
            "doc_id", "tokenizer", now("source", "o_source"), now("lang", "o_lang"), now("n_tokens", "o_tokens"), (~F.col("changed") | ~F.col("gone")).alias("live"), "changed", "had", "o_source", "o_lang", "o_tokens",
            bucket.alias("bucket"),
        ).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(current)
        said = self.spark.read.schema(ENTRY).parquet(current).where("changed")
        add = said.where("live").select(*KEYS, F.lit(1).alias("d"), F.col("n_tokens").alias("t"))
        take = said.where("had").select(F.col("o_source").alias("source"), F.col("o_lang").alias("lang"), "tokenizer", F.lit(-1).alias("d"), (-F.col("o_tokens")).alias("t"))
        delta = add.union(take).groupBy(*KEYS).agg(F.sum("d").cast("long").alias("n_docs"), F.sum("t").cast("long").alias("n_tokens"))
        delta.write.mode("overwrite").parquet(f"{at}/delta")
        return True

    def totals(self) -> DataFrame:
        paths = [f"{self.path}/{n}/delta" for n in self.committed()]
        rows = self.spark.read.schema(DELTA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 OR n_tokens <> 0")


def copies(docs: DataFrame) -> DataFrame:
    """doc_ids whose text another document with a smaller doc_id has too."""
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"))
    first = rows.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select(F.lower("h").alias("__h"), "first")  # dealt anew: a join on a text of many copies can then be split
    return rows.join(first, F.col("h") == F.col("__h")).where(F.col("doc_id") > F.col("first")).select("doc_id").distinct()


def maintain(docs: DataFrame, old: DataFrame, new: DataFrame, estimate: Column, old_name: str, new_name: str) -> DataFrame:
    """The life of a corpus in five deliveries: load the counts of one tokenizer, with estimates for another; delete exact copies;
    revise the estimates of what is left by true counts; and the deletions and the load once more, which changes nothing.

    ``old`` and ``new`` hold doc_id, source, lang, n_tokens; ``estimate`` is an expression over docs.
    """
    state = Rollup(docs.sparkSession)
    shape = ("doc_id", "tokenizer", "op", "source", "lang", "n_tokens")
    none = {c: F.lit(None).cast(t) for c, t in (("source", "string"), ("lang", "string"), ("n_tokens", "long"))}
    gone = durable(copies(docs), "copies")
    guess = docs.select("doc_id", "source", "lang", F.coalesce(estimate, F.lit(0)).cast("long").alias("n_tokens"))
    load = old.withColumn("tokenizer", F.lit(old_name)).unionByName(guess.withColumn("tokenizer", F.lit(new_name))).withColumn("op", F.lit("insert")).select(*shape)
    deletions = gone.withColumns({"tokenizer": F.explode(F.array(F.lit(old_name), F.lit(new_name))), "op": F.lit("delete"), **none}).select(*shape)
    state.apply("0001", load)
    state.apply("0002", deletions)
    counted = new.join(gone, "doc_id", "left_anti").withColumns({"tokenizer": F.lit(new_name), "op": F.lit("revise")}).select(*shape)
    state.apply("0003", counted)
    state.apply("0002", deletions)
    state.apply("0001", load)
    return state.totals()


def word_counts(docs: DataFrame) -> DataFrame:
    """Counts of white-space words: a tokenizer that needs no file."""
    from .common import word_array

    return docs.select("doc_id", "source", "lang", F.size(word_array(F.col("text"))).cast("long").alias("n_tokens"))


def op10(spark: SparkSession, docs: DataFrame) -> DataFrame:
    docs = docs.select("doc_id", "source", "lang", "text")
    return maintain(docs, word_counts(docs), count_tokens(docs, default_path()), F.floor(F.octet_length("text") / 4), "words-1", "word_bpe_49k-1")


def word_rollups(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The same maintenance with two word rules that SQL can count."""
    docs = docs.select("doc_id", "source", "lang", "text")
    lines = docs.select("doc_id", "source", "lang", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_tokens"))
    return maintain(docs, word_counts(docs), lines, F.floor(F.length("text") / 60), "words-1", "lines-1")


WORD_ORACLE = r"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t, doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS copy FROM documents)
SELECT source, lang, 'words-1' AS tokenizer, count(*)::BIGINT AS n_docs,
       sum(len(list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '')))::BIGINT AS n_tokens
FROM d WHERE NOT copy GROUP BY ALL
UNION ALL
SELECT source, lang, 'lines-1', count(*)::BIGINT, sum(len(string_split(t, chr(10))))::BIGINT FROM d WHERE NOT copy GROUP BY ALL
"""
