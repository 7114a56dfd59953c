"""Phrase collocation mining by Rabin-Karp fingerprints.

Prefix polynomials over the bytes of many texts at once give each word a fingerprint, prefix polynomials over the words give
each n-gram one. Passes over the texts count fingerprints, by task and then by shuffle:

1. words; 2. pairs of frequent words; 3. phrases of 3 to 5 words all of whose pairs are frequent, and the words of such pairs. A fingerprint that falls short of the least count can't belong to a frequent phrase, and neither can a phrase that holds
such a part, so nothing is lost. What the next pass needs to know of a pass is a bitmap of fixed size: two fingerprints that share a bit
only make more rows, never fewer.
4. In each chunk a group of equal frequent fingerprints keeps the pointer of one occurrence. The others are verified against its text, word by word
and byte by byte; those that differ become groups of their own. Only these groups are materialised as text, which the task and the
last shuffle count with a pointer (doc_id) each, so equal fingerprints of different phrases don't matter.

Words and pieces are found in numpy, in chunks of ``CHUNK`` bytes that end between pieces, so a task holds a chunk, not a batch's or a text's whole arrays.

Defined cases: a null or empty text has no words; a null lang is ``und``, and so counts with rows of that lang; null and repeated doc_ids
and repeated rows count like any other, as doc_id is only the pointer; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import durable

LEAST, LONGEST, FIRST, SHARE = 100, 5, 2000, 100
#: Bytes of text whose arrays are held at once; fingerprints gathered before they are counted; bits of the bitmap between passes.
CHUNK, GATHER, BITS = 1 << 20, 2 << 20, 1 << 26
#: Tasks of the last pass for each of the cluster's cores. What a task holds is bounded by ``GATHER``, whatever it reads.
WAVES = 2
#: The part of a fingerprint that passes count by; parts that fall together make the counts larger, never smaller.
KEY = np.uint64((1 << 44) - 1)

COUNTS = "fp long, c long"
PHRASES = "lang string, n int, phrase string, c long, doc_id long"

_BLANK, _BREAK = 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?\x0a\x0b\x0c\x0d"]] = _BREAK
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


#: Values of the bytes, and the odd bases of the two polynomials.
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, extended as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = np.uint64(base), np.uint64(pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            both = []
            for b in (self.base, self.inverse):
                steps = np.full(n, b)
                steps[0] = 1
                both.append(np.multiply.accumulate(steps))
            self.up, self.down = both
        return self.up[:n], self.down[:n]


_POWERS = [Powers(b) for b in _BASES]


def prefix(values: np.ndarray, which: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix polynomial of the values, and what a difference of it is multiplied by to start at place 0."""
    up, down = _POWERS[which].upto(max(len(values), 1))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return sums, down


def chunks(texts: list[bytes], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(lower-cased bytes, first byte of each text) of consecutive texts; texts are parted by a break, long ones cut at one."""
    held, size = [], 0
    for i, raw in enumerate(texts):
        low, at = raw.translate(_LOWER), 0
        while len(low) - at > limit:
            stop = np.flatnonzero(_KIND[np.frombuffer(low, np.uint8, min(limit, len(low) - at), at)] == _BREAK)
            if len(stop):
                end = at + int(stop[-1]) + 1
            else:  # a piece longer than a chunk stays whole
                rest = np.flatnonzero(_KIND[np.frombuffer(low, np.uint8, offset=at)] == _BREAK)
                end = at + int(rest[0]) + 1 if len(rest) else len(low)
            yield np.frombuffer(low, np.uint8, end - at, at), np.array([[0, i]])
            at = end
        if size and size + len(low) - at > limit:
            yield _joined(held)
            held, size = [], 0
        held.append((i, low[at:]))
        size += len(low) - at + 1
    if held:
        yield _joined(held)


def _joined(held: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    starts = np.cumsum([0, *[len(t) + 1 for _, t in held[:-1]]])
    return np.frombuffer(b"\n".join(t for _, t in held), np.uint8), np.stack([starts, np.array([i for i, _ in held])], axis=1)


class Words:
    """The words of a chunk: first and last byte, piece and fingerprint."""

    def __init__(self, data: np.ndarray, salt: np.uint64):
        kind = _KIND[data]
        inside = np.concatenate([[False], kind == 0, [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        self.data, self.start, self.end, self.salt = data, edge[::2], edge[1::2], salt
        self.piece = np.cumsum(kind == _BREAK, dtype=np.int32)[self.start] if len(self.start) else np.zeros(0, np.int32)
        sums, down = prefix(_BYTE[data], 0)
        self.word = mix((sums[self.end] - sums[self.start]) * down[self.start] if len(self.start) else np.zeros(0, np.uint64))
        self.sums, self.down = prefix(self.word, 1)

    def whole(self, n: int) -> np.ndarray:
        """First words of the n-grams that lie in one piece."""
        return np.flatnonzero(self.piece[n - 1 :] == self.piece[: len(self.piece) - n + 1]) if len(self.piece) >= n else np.zeros(0, np.int64)

    def fingerprints(self, at: np.ndarray, n: int) -> np.ndarray:
        return mix((self.sums[at + n] - self.sums[at]) * self.down[at] + self.salt + np.uint64(n)) if len(at) else np.zeros(0, np.uint64)

    def equal(self, a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
        """Whether the n-grams at a and at b have the same bytes, word by word."""
        same = np.ones(len(a), bool)
        for k in range(n):
            s, t = self.start[a + k], self.start[b + k]
            size = self.end[a + k] - s
            same &= size == self.end[b + k] - t
            alive = np.flatnonzero(same & (s != t))
            byte = 0
            while len(alive):  # as often as the longest word has bytes, on ever fewer words
                alive = alive[size[alive] > byte]
                differ = self.data[s[alive] + byte] != self.data[t[alive] + byte]
                same[alive[differ]] = False
                alive, byte = alive[~differ], byte + 1
        return same


def _salt(lang: str) -> np.uint64:
    sums, _ = prefix(_BYTE[np.frombuffer(lang.encode(), np.uint8)], 0)
    return mix(sums[-1:] + np.uint64(0x2545F4914F6CDD1D))[0]


def marked(bitmap: np.ndarray, fp: np.ndarray) -> np.ndarray:
    bit = fp & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], list]]:
    """The texts of a batch by language."""
    by: dict[str, tuple[list[bytes], list]] = {}
    for lang, raw, doc_id in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2).to_pylist(), strict=True):
        if raw.is_valid:
            texts, ids = by.setdefault("und" if lang is None else lang, ([], []))
            texts.append(raw.as_py())
            ids.append(doc_id)
    return ((lang, *both) for lang, both in by.items())


def _each_chunk(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[str, Words, np.ndarray, list]]:
    for batch in batches:
        for lang, texts, ids in _texts(batch):
            salt = _salt(lang)
            for data, starts in chunks(texts, limit):
                yield lang, Words(data, salt), starts, ids


def _pointer(words: Words, at: np.ndarray, starts: np.ndarray, ids: list) -> list:
    """The documents of some occurrences."""
    return [ids[k] for k in starts[np.searchsorted(starts[:, 0], words.start[at], "right") - 1, 1]]


def candidates(words: Words, n: int, of_words: np.ndarray | None, of_pairs: np.ndarray | None) -> np.ndarray:
    """First words of the n-grams that may be frequent by what earlier passes left."""
    at = words.whole(n)
    if of_words is not None and n == 2:
        ok = marked(of_words, words.fingerprints(np.arange(len(words.word)), 1))
        at = at[ok[at] & ok[at + 1]]
    if of_pairs is not None and n > 2:
        pair = np.zeros(len(words.word) + 1, bool)
        first = words.whole(2)
        pair[first] = marked(of_pairs, words.fingerprints(first, 2))
        for k in range(n - 1):
            at = at[pair[at + k]]
    return at


def _count(sizes: tuple[int, ...], of_words, of_pairs, limit: int, gather: int):
    """Fingerprints of the n-grams of some sizes with their counts, and the words of a language under size 0."""

    def rows(fps: list[np.ndarray]) -> pa.RecordBatch:
        fp, count = np.unique(np.concatenate(fps), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(count.astype(np.int64))], names=["fp", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, p = of_words and of_words.value, of_pairs and of_pairs.value
        held, size = [], 0
        for _, words, _, _ in _each_chunk(batches, limit):
            for n in sizes:
                held.append(words.fingerprints(candidates(words, n, w, p), n) & KEY)
                size += len(held[-1])
            if p is not None:  # the words of frequent pairs, the only ones whose counts matter
                pair = candidates(words, 2, None, None)
                pair = pair[marked(p, words.fingerprints(pair, 2))]
                held.append(words.fingerprints(np.union1d(pair, pair + 1), 1) & KEY)
                size += len(held[-1])
            if size >= gather:
                yield rows(held)
                held, size = [], 0
        if size:
            yield rows(held)

    return run


def phrases_of(words: Words, at: np.ndarray, n: int) -> pa.Array:
    """The n-grams at some places as text, words joined by single blanks."""
    each = (at[:, None] + np.arange(n)).ravel()
    size = words.end[each] - words.start[each]
    to = np.zeros(len(each) + 1, np.int64)
    np.cumsum(size + 1, out=to[1:])
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out = np.full(max(int(to[-1]) - 1, 0), 0x20, np.uint8)
    out[np.repeat(to[:-1], size) + step] = words.data[np.repeat(words.start[each], size) + step]
    # the blank behind each phrase but the last is cut out
    keep = np.ones(len(out), bool)
    keep[to[n:-1:n] - 1] = False
    ends = to[n::n] - np.arange(1, len(at) + 1)
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(out[keep]))


def _materialise(longest: int, frequent, limit: int, gather: int):
    """Frequent phrases as text, with verified counts and one document; size 0 counts a language's words."""
    names = ["lang", "n", "phrase", "c", "doc_id"]

    def table(lang: str, n: int, phrases: pa.Array, count: np.ndarray, docs: list) -> pa.Table:
        k = len(phrases)
        return pa.Table.from_arrays([pa.repeat(pa.scalar(lang), k), pa.repeat(pa.scalar(n, pa.int32()), k), phrases, pa.array(count, pa.int64()), pa.array(docs, pa.int64())], names=names)

    def merged(tables: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(tables).group_by(["lang", "n", "phrase"]).aggregate([("c", "sum"), ("doc_id", "min")])
        return out.select(["lang", "n", "phrase", "c_sum", "doc_id_min"]).rename_columns(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_words, of_pairs, of_rest = (b.value for b in frequent)
        held, size = [], 0
        for lang, words, starts, ids in _each_chunk(batches, limit):
            held.append(table(lang, 0, pa.array([""]), np.array([len(words.word)]), [None]))
            for n in range(1, longest + 1):
                at = candidates(words, n, of_words, of_pairs)
                fp = words.fingerprints(at, n)
                hit = marked(of_pairs if n == 2 else of_rest, fp)
                at, fp = at[hit], fp[hit]
                while len(at):
                    _, first, group = np.unique(fp, return_index=True, return_inverse=True)
                    good = words.equal(at, at[first][group], n)
                    held.append(table(lang, n, phrases_of(words, at[first], n), np.bincount(group[good], minlength=len(first)), _pointer(words, at[first], starts, ids)))
                    size += len(first)
                    at, fp = at[~good], fp[~good]  # another phrase of the same fingerprint
            if size >= gather // 8:
                held = [merged(held)]
                size = held[0].num_rows
                if size >= gather // 16:
                    yield from held[0].to_batches()
                    held, size = [], 0
        if held:
            yield from merged(held).combine_chunks().to_batches()

    return run


def bitmap(fps: DataFrame, bits: int) -> np.ndarray:
    """The fingerprints as a bitmap; at most bits / 64 rows come to the driver, whatever their number."""
    bit = F.col("fp").bitwiseAND(bits - 1)
    words = fps.groupBy(F.shiftright(bit, 6).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(fp & 63 AS INT))")).alias("b")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    return out


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, bits: int = BITS, chunk: int = CHUNK, gather: int = GATHER) -> DataFrame:
    """(lang, n, phrase, c, doc_id): all phrases of 2 to ``longest`` words that occur ``least`` times in a language and the words they are
    made of, with one document that holds them, and under n = 0 the number of the language's words. A written table."""
    spark = docs.sparkSession
    texts = docs.select(F.col("lang").cast("string"), F.col("text").cast("string"), F.col("doc_id").cast("long").alias("doc_id"))
    maps = []
    for sizes in ((1,), (2,), tuple(range(3, longest + 1))):
        counted = texts.mapInArrow(_count(sizes, *[*maps, None, None][:2], chunk, gather), COUNTS)
        kept = counted.groupBy("fp").agg(F.sum("c").alias("c")).where(F.col("c") >= least)
        maps.append(spark.sparkContext.broadcast(bitmap(kept, bits)))
    # a task gives a row for each frequent phrase that it meets, so these tasks are few: a row then stands for more occurrences
    said = texts.coalesce(WAVES * spark.sparkContext.defaultParallelism).mapInArrow(_materialise(longest, maps, chunk, gather), PHRASES)
    counts = said.groupBy("lang", "n", "phrase").agg(F.sum("c").alias("c"), F.min("doc_id").alias("doc_id"))
    return durable(counts.where((F.col("c") >= least) | (F.col("n") == 0)), "phrases")


def wide(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST, share: int = SHARE, **sizes: int) -> DataFrame:
    """Each language's ``first`` phrases by score: (lang, rank, phrase, a, l, r, n, score, doc_id)."""
    found = frequent_phrases(docs, least, longest, **sizes)
    totals = found.where("n = 0").select(F.col("lang").alias("of"), F.col("c").alias("total"))
    spoken = found.where("n > 0").select("lang", "phrase", "c")
    phrases = found.where("n > 1").select("lang", "phrase", F.col("n").alias("size"), F.col("c").alias("a"), "doc_id", F.split("phrase", " ").alias("ws"))

    def part(first_word: Column, n: Column) -> Column:
        return F.array_join(F.slice("ws", first_word, n), " ")

    k = F.col("k")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "doc_id", "k", part(F.lit(1), k).alias("left"), part(k + 1, F.col("size") - k).alias("right"))
    cuts = cuts.join(spoken.select(F.col("lang").alias("l1"), F.col("phrase").alias("p1"), F.col("c").alias("l")), (F.col("lang") == F.col("l1")) & (F.col("left") == F.col("p1")))
    cuts = cuts.join(spoken.select(F.col("lang").alias("l2"), F.col("phrase").alias("p2"), F.col("c").alias("r")), (F.col("lang") == F.col("l2")) & (F.col("right") == F.col("p2")))
    cuts = cuts.join(F.broadcast(totals), F.col("lang") == F.col("of"))  # a row a language
    cuts = cuts.withColumn("product", wide(F.col("a") * 1000) * wide(F.col("total"))).withColumn("score", F.expr("product div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"))
    low = F.min(F.struct("score", "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase").agg(low.alias("low"), F.first("a").alias("a"), F.first("total").alias("n"), F.first("doc_id").alias("doc_id"))
    # spans of a longer phrase, with the count of the most frequent phrase that holds them
    spans = phrases.where("size > 2").withColumn("k", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("k") + 1)))
    spans = spans.select(F.col("lang").alias("sl"), part(F.col("at"), k).alias("sp"), F.col("a").alias("longer")).groupBy("sl", "sp").agg(F.max("longer").alias("longer"))
    left = scored.join(spans, (F.col("lang") == F.col("sl")) & (F.col("phrase") == F.col("sp")), "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))
    left = left.select("lang", "phrase", "a", F.col("low.l").alias("l"), F.col("low.r").alias("r"), "n", F.col("low.score").alias("score"), "doc_id")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return left.withColumn("rank", rank.cast("long")).where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "doc_id")


def op13(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return collocations(docs).drop("doc_id")


ORACLE = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS pid, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS ws
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i : i + size - 1], ' '))) AS phrase FROM pieces, (SELECT unnest(range(1, 6)) AS size)),
f AS (SELECT lang, CAST(size AS INT) AS size, phrase, count(*) AS c FROM grams GROUP BY lang, size, phrase HAVING count(*) >= 100),
cand AS (SELECT lang, size, phrase, c AS a, string_split(phrase, ' ') AS ws FROM f WHERE size > 1),
cuts AS (
  SELECT x.lang, x.phrase, x.a, x.k, l.c AS l, r.c AS r, t.n, (CAST(1000 AS HUGEINT) * x.a * t.n) // (CAST(l.c AS HUGEINT) * r.c) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM cand) x
  JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(x.ws[1 : x.k], ' ')
  JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(x.ws[x.k + 1 : x.size], ' ')
  JOIN totals t ON t.lang = x.lang),
scored AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM cuts) WHERE o = 1),
spans AS (
  SELECT lang, phrase, max(c) AS longer FROM (
    SELECT lang, a AS c, unnest(list_transform(range(1, size - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) AS phrase
    FROM (SELECT *, unnest(range(2, size)) AS k FROM cand WHERE size > 2)) GROUP BY lang, phrase),
kept AS (SELECT s.* FROM scored s LEFT JOIN spans p ON p.lang = s.lang AND p.phrase = s.phrase WHERE p.longer IS NULL OR 100 * p.longer < 100 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 2000
"""
