"""Line dedup over levelled sorted runs of line hashes (DataFrame functions only).

A run is a table of (k1, k2, first_doc), one row per line key, bucketed and sorted by key. Documents arrive in batches of
ascending ``doc_id``. A batch is reduced to one row per key, merge-anti-joined with the runs, and what is new becomes a
run of level 0. As soon as a level holds ``fanout`` runs they are merged into one run of the next level, so n batches
leave O(log n) runs and each key is rewritten O(log n) times. All runs have the batch's number of buckets, so neither
anti-joins nor merges deal a run's rows out again: only the batch's own keys are shuffled.

Defined results: a null text is one empty line. Rows without ``doc_id`` lose no line and own none. Rows that repeat a
``doc_id`` count as one document, and each loses its own lines. Texts of any length are split whole. An empty table gives an
empty result. Further columns stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import drop_path, new_path
from .common import BLANKS, ascii_lower, fresh

RUN_SCHEMA = "k1 long, k2 long, first_doc long"


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def key_hashes(key: Column) -> tuple[Column, Column]:
    """128 bits: XXH64 of the key under two seeds."""
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, th, line_no, k1, k2) of every line whose key has at least min_chars code points; th: hash of the text."""
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), line_key)).alias("line_no", "key")
    )
    k1, k2 = key_hashes(F.col("key"))
    return lines.where(F.length("key") >= min_chars).select("doc_id", "th", "line_no", k1.alias("k1"), k2.alias("k2"))


@dataclass
class LineRuns:
    """The levels of runs; ``levels[i]`` lists the tables of the runs of level i."""

    spark: SparkSession
    fanout: int = 2
    levels: list[list[str]] = field(default_factory=list)
    paths: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def all(self) -> DataFrame:
        """All keys so far, as plain files; the runs hold disjoint keys."""
        frames = [self.spark.read.schema(RUN_SCHEMA).parquet(self.paths[name]) for name in self.runs()]
        return reduce(DataFrame.union, frames) if frames else self.spark.createDataFrame([], RUN_SCHEMA)

    def _write(self, df: DataFrame) -> str:
        path = new_path(self.spark, "line-run")
        name = path.rpartition("/")[2].replace("-", "_")
        df.write.format("parquet").option("path", path).bucketBy(self.buckets, "k1", "k2").sortBy("k1", "k2").saveAsTable(name)
        self.paths[name] = path
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        drop_path(self.spark, self.paths.pop(name))

    def close(self, files: bool = False) -> None:
        """Forget the tables; their files stay unless they aren't needed either."""
        for name in self.runs():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            if files:
                drop_path(self.spark, self.paths[name])

    def add(self, keys: DataFrame, level: int = 0) -> None:
        """Append the keys as a run; merge the runs of full levels."""
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._write(keys))
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self.add(reduce(self.merge, [self.spark.table(name) for name in old]), level + 1)
            for name in old:
                self._drop(name)

    @staticmethod
    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        """Two runs of disjoint keys as one, by a merge join of their buckets."""
        return a.hint("merge").join(b.withColumnRenamed("first_doc", "__other"), ["k1", "k2"], "full_outer").select("k1", "k2", F.coalesce("first_doc", "__other").alias("first_doc"))

    def add_batch(self, lines: DataFrame) -> None:
        """Merge-anti-join a batch's keys with each run and add the rest. Batches come in ascending doc_id."""
        keys = lines.groupBy("k1", "k2").agg(F.min("doc_id").alias("first_doc"))
        for name in self.runs():
            keys = keys.join(self.spark.table(name).hint("merge"), ["k1", "k2"], "left_anti")
        self.add(keys)


def dropped_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """(doc_id, th, dropped array<int>): the numbers of the lines that each document loses."""
    spark = docs.sparkSession
    cuts = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000)).first()[0] or []
    batch = sum(((F.col("doc_id") > c).cast("int") for c in cuts), F.lit(0))
    path = new_path(spark, "line-keys")
    line_keys(docs, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc_id long, th long, line_no int, k1 long, k2 long, batch int").parquet(path)
    runs = LineRuns(spark, fanout)
    for b in range(len(cuts) + 1):
        runs.add_batch(lines.where(F.col("batch") == b))
    runs.close()
    return (
        lines.join(runs.all().hint("merge"), ["k1", "k2"])
        .where(F.col("doc_id") > F.col("first_doc"))
        .groupBy("doc_id", "th")
        .agg(F.collect_set("line_no").alias("dropped"))
    )


def dedup_lines(docs: DataFrame, min_chars: int = 10, batches: int = 4, fanout: int = 2) -> DataFrame:
    """docs with ``text`` replaced by the lines that stay, plus n_lines and n_dropped (columns of these names are replaced)."""
    drops = dropped_lines(docs, min_chars, batches, fanout)
    docs = docs.drop("n_lines", "n_dropped")
    names = docs.columns
    id_, th, drop, split, keep = fresh(docs, "__id", "__th", "__drop", "__lines", "__keep")
    lines = (
        docs.join(
            drops.select(F.col("doc_id").alias(id_), F.col("th").alias(th), F.col("dropped").alias(drop)),
            (docs["doc_id"] == F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(th)), "left",
        )
        .withColumn(split, F.split(F.coalesce("text", F.lit("")), "\n"))
        .withColumn(keep, F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.coalesce(drop, F.array().cast("array<int>"))))
    )
    kept = F.when(F.col(drop).isNull(), F.coalesce("text", F.lit(""))).otherwise(
        F.array_join(F.transform(keep, lambda i: F.get(F.col(split), i)), "\n")
    )
    return lines.select(
        *[kept.alias("text") if c == "text" else F.col(f"`{c}`") for c in names],
        F.size(split).cast("long").alias("n_lines"),
        (F.size(split) - F.size(keep)).cast("long").alias("n_dropped"),
    )


def op6(spark: SparkSession, docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, i AS line_no, l AS line,
         translate(trim(l, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
firsts AS (SELECT key, min(doc_id) AS first_doc FROM lines WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT l.*, coalesce(l.doc_id > f.first_doc, false) AS dropped FROM lines l LEFT JOIN firsts f ON l.key = f.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
