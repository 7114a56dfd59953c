"""Quality rules with cross-document line frequency (DataFrame functions only).

Texts are read once: base statistics and the hashes of all normalised lines of a document go into one table. The
documents that hold a line are counted per host (``source``), and lines above the host's limit are taken as boilerplate.
A document whose remaining words are under ``min_left`` of its words is depleted and rejected; the others lose their
boilerplate lines (``clean``). Documents of equal text count once in a line's frequency, so copies of a good document don't
condemn it.

The limit means the same at every size: ``LINE_SHARE`` of a host's documents, but ``FEW_DOCS`` at least, so that chance doesn't
condemn a line of a small host, and ``LINE_DOCS`` at most, beyond which no line is a document's own however large the host.

Defined results: a null text has no words; an empty or null text fails the base rules (under ``min_words``). A null
host is a host of its own. Rows that repeat a ``doc_id`` are judged one by one. Texts of any length are judged whole. An empty
table gives an empty result. Further columns stay as they are in ``clean`` and are ignored otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable
from .common import fresh, let, word_array
from .line_dedup import key_hashes, line_key

MIN_WORDS, MAX_REPEAT_PCT, WINDOW = 10, 20, 5
#: A line is boilerplate in a host beyond max(FEW_DOCS, min(LINE_DOCS, LINE_SHARE of the host's distinct documents)).
FEW_DOCS, LINE_DOCS, LINE_SHARE, MIN_LINE_CHARS, MIN_LEFT = 5, 50, 0.05, 10, 0.3
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
HAS_WORD = r"[^\x20\x09-\x0D]"


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that occur twice or more in the row's text."""

    def covered(h: Column) -> Column:
        def twice(s: Column) -> Column:
            keep = F.filter(
                F.transform(
                    s,
                    lambda x, i: F.when(
                        F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)), x["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            )
            start = F.struct(F.lit(-width).alias("last"), F.lit(0).cast("long").alias("n"))
            return F.aggregate(
                F.sort_array(keep),
                start,
                lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(width), p - a["last"])).alias("n")),
                lambda a: a["n"],
            )

        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(pairs, twice))

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - width),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]),
    )
    return F.when(F.size(words) <= width, F.lit(0).cast("long")).otherwise(let(windows, covered))


def base_stats(docs: DataFrame) -> DataFrame:
    """docs plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    wordy = F.filter(F.split(text, "\n"), lambda l: l.rlike(HAS_WORD))
    stats = let(
        word_array(F.col("text")),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    out = docs.withColumn("__s", stats).withColumn("__d", let(wordy, lambda l: (F.size(l) - F.size(F.array_distinct(l))).cast("long")))
    out = out.withColumns(
        {
            "n_words": F.col("__s.n_words"),
            "word_chars": F.col("__s.word_chars"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
            "n_dup_lines": F.col("__d"),
            "n_repeat_words": F.col("__s.n_repeat_words"),
        }
    ).drop("__s", "__d")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))


def _rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """docs(doc_id, text, source) as a written table of base statistics and lines: no text is read again.

    ``th``, the hash of the text, tells rows apart that repeat a doc_id. ``lines`` has number, hashes and words of the lines that count.
    """
    def line(l: Column, i: Column) -> Column:
        k1, k2 = key_hashes(line_key(l))
        return F.struct(i.alias("no"), k1.alias("k1"), k2.alias("k2"), F.size(word_array(l)).alias("n"))

    split = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda l, i: F.when(l.rlike(HAS_WORD) & (F.length(line_key(l)) >= min_chars), line(l, i)))
    marked = base_stats(docs.select("doc_id", "text", "source")).withColumns({"th": F.xxhash64("text"), "lines": F.filter(split, lambda x: x.isNotNull())})
    return durable(marked.select("doc_id", "th", F.col("source").alias("host"), *STATS, "lines"), "stats")


def boilerplate(rows: DataFrame, few: int = FEW_DOCS, line_docs: int = LINE_DOCS, line_share: float = LINE_SHARE) -> DataFrame:
    """(doc_id, th, host, n_boiler, cut): words and numbers of the lines above their host's limit; rows without any are absent."""
    lines = rows.select("doc_id", "th", "host", F.explode("lines").alias("l")).select("doc_id", "th", "host", "l.*")
    hosts = rows.groupBy("host").agg(F.count_distinct("th").alias("host_docs"))
    limit = F.greatest(F.lit(float(few)), F.least(F.lit(float(line_docs)), F.lit(line_share) * F.col("host_docs")))
    held = lines.groupBy("host", "k1", "k2").agg(F.count_distinct("th").alias("docs")).where(F.col("docs") > few)
    common = held.alias("c").join(hosts.alias("h"), F.col("c.host").eqNullSafe(F.col("h.host"))).where(F.col("docs") > limit)
    # under another expression than the grouping's key: a line of very many documents can then be split between tasks
    common = common.select(F.col("c.host").alias("chost"), F.col("k1").bitwiseXOR(F.lit(0)).alias("c1"), F.col("k2").alias("c2"))
    found = lines.join(common, F.col("host").eqNullSafe(F.col("chost")) & (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")), "left_semi")
    once = found.groupBy("doc_id", "th", "host", "no").agg(F.max("n").alias("n"))
    return once.groupBy("doc_id", "th", "host").agg(F.sum("n").alias("n_boiler"), F.collect_list("no").alias("cut"))


def judged(docs: DataFrame, min_left: float = MIN_LEFT, **limits) -> DataFrame:
    """doc_id, th, host, base statistics, n_boiler, kept, and cut, the numbers of the boilerplate lines (null without any)."""
    rows = _rows(docs, MIN_LINE_CHARS)
    boiler = boilerplate(rows, **limits).select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("host").alias("__host"), "n_boiler", "cut")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("th") == F.col("__th")) & F.col("host").eqNullSafe(F.col("__host"))
    out = rows.drop("lines").join(boiler, same, "left").drop("__id", "__th", "__host").withColumn("n_boiler", F.coalesce("n_boiler", F.lit(0)))
    depleted = (F.col("n_words") - F.col("n_boiler")) < min_left * F.col("n_words")
    return out.withColumn("kept", ~F.col("base_failed") & ~depleted)


def clean(docs: DataFrame, min_left: float = MIN_LEFT, **limits) -> DataFrame:
    """docs without the rows that the rules reject, and without the boilerplate lines of the others; columns as they are."""
    verdict = judged(docs, min_left, **limits).where(~F.col("kept") | F.col("cut").isNotNull())
    id_, th, host, kept, cut = fresh(docs, "__id", "__th", "__host", "__kept", "__cut")
    verdict = verdict.groupBy(F.col("doc_id").alias(id_), F.col("th").alias(th), F.col("host").alias(host)).agg(F.first("kept").alias(kept), F.first("cut").alias(cut))
    same = docs["doc_id"].eqNullSafe(F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(th)) & docs["source"].eqNullSafe(F.col(host))
    left = F.filter(F.split(docs["text"], "\n"), lambda l, i: ~F.array_contains(cut, i))
    out = docs.join(verdict, same, "left").where(F.coalesce(kept, F.lit(True)))
    text = F.when(F.col(cut).isNull(), docs["text"]).otherwise(F.array_join(left, "\n"))
    return out.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def op9(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_boiler"
    )


ORACLE = r"""
WITH docs AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
word_lists AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM docs),
wins AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c
  FROM (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS g
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM word_lists WHERE len(ws) >= 5))),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS p FROM wins WHERE c > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, t, l,
         translate(trim(l, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
dups AS (SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM lines GROUP BY doc_id),
hosts AS (SELECT source, count(DISTINCT t) AS host_docs FROM docs GROUP BY source),
common AS (
  SELECT c.source, c.key FROM (SELECT source, key, count(DISTINCT t) AS n FROM lines WHERE length(key) >= 10 GROUP BY source, key) c
  JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source WHERE c.n > greatest(5, least(50, 0.05 * h.host_docs))),
boiler AS (
  SELECT doc_id, sum(len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda w: w <> '')))::BIGINT AS n
  FROM lines SEMI JOIN common ON lines.source IS NOT DISTINCT FROM common.source AND lines.key = common.key GROUP BY doc_id),
stats AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(d.n, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(b.n, 0)::BIGINT AS n_boiler
  FROM word_lists w LEFT JOIN dups d USING (doc_id) LEFT JOIN rep r USING (doc_id) LEFT JOIN boiler b USING (doc_id)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM stats)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ((n_words - n_boiler) < 0.3 * n_words) AS kept, n_boiler
FROM judged
"""
