"""Substring dedup by recompression.

Rounds name token runs and pairs: first every maximal run of one symbol gets the name of (symbol, length), then every
adjacent pair of a left-class and a right-class symbol (the class is a bit of the symbol's name) gets the name of the pair.
A name is a function of what it stands for, so all documents and all tasks agree on it without asking each other, and equal
substrings get equal symbols except near their ends. ``context`` is the span of words that a symbol's making looked at:
wherever those words occur, the symbol occurs.

1. Spark rounds, from the top: ``symbols`` emits the symbols of ``LEVELS`` rounds and, on top, a document as one symbol, each
   with a second fingerprint of its words that has to agree as well. For each level the smallest doc_id of every symbol
   that several documents hold is found; the others lose the symbol's words at one stroke, and a document that is lost
   whole leaves the rounds below. So long repeats and copies never reach the windows.
2. Every window of ``WIDTH`` words takes as key the name of the context of one symbol of the first round that lies inside it
   with its context (the least by hash; a window without any takes its own words). Higher symbols don't fit a window of 13
   words. Windows under one key in a row are one Spark row.
3. Keys shared by several documents are found by a partial aggregation and a skew-splittable join.
4. Only runs of such keys are cut from the texts again, less those inside the symbols of step 1; their windows are named word
   for word and meet the other windows of their key under a name and a route that are independent hashes, and the
   smallest doc_id of each window is found. Hot keys are dealt out window by window, and a task only sends the smallest
   document of each window that it has.
5. Documents drop the words that such windows and symbols cover.

Defined results: a null or empty text has no words. Rows without doc_id lose nothing and hold nothing. Rows that repeat a
doc_id are one document as holders, and each loses its own repeats. An empty table gives an empty result. Further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable
from . import kernel
from .repeats import HOT, candidates, keyed, pack_runs, short_keys, unpack_hits, with_spans

WIDTH, FAR = 13, 1 << 40
#: Rounds after which symbols are compared across documents; the symbols of round 16 have 96 words on average (measured on the
#: check tables). WHOLE is the level of the document as one symbol.
LEVELS, WHOLE = (16,), 99


def name_round(sym: np.ndarray, start: np.ndarray, lo: np.ndarray, hi: np.ndarray, doc: np.ndarray, salt: int) -> tuple[np.ndarray, ...]:
    """One round over symbols in text order: (symbols, first words, context starts, context ends, documents)."""
    n = len(sym)
    if not n:
        return sym, start, lo, hi, doc
    head = np.ones(n, bool)
    head[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(head)
    count = np.diff(np.append(at, n)).astype(np.uint64)
    with np.errstate(over="ignore"):
        name = np.where(count > 1, kernel.mix(sym[at] + count * kernel.BASE, salt), sym[at])
    doc_, start_ = doc[at], start[at]
    last = np.append(at[1:], n) - 1
    low, high = lo[at].copy(), hi[last].copy()
    same = doc_[1:] == doc_[:-1]
    before = np.full(len(at), -FAR)
    before[1:] = np.where(same, lo[last[:-1]], -FAR)
    after = np.full(len(at), FAR)
    after[:-1] = np.where(same, hi[at[1:]], FAR)
    low, high = np.minimum(low, before), np.maximum(high, after)  # a run ends where its neighbours differ

    left = (kernel.mix(name, salt + 1) >> np.uint64(63)).astype(bool)
    joint = np.zeros(len(at), bool)  # starts a pair
    joint[:-1] = left[:-1] & ~left[1:] & same
    second = np.zeros(len(at), bool)
    second[1:] = joint[:-1]
    prev_low = np.full(len(at), -FAR)
    prev_low[1:] = np.where(same, low[:-1], -FAR)
    next_high = np.full(len(at), FAR)
    next_high[:-1] = np.where(same, high[1:], FAR)
    follow = np.append(name[1:], np.uint64(0))
    with np.errstate(over="ignore"):
        pair = kernel.mix(name * kernel.BASE + follow, salt + 2)
    out = np.where(joint, pair, name)
    out_low = np.where(~joint & ~left, np.minimum(low, prev_low), low)
    out_high = np.where(joint | left, np.maximum(high, next_high), high)
    keep = ~second
    return out[keep], start_[keep], out_low[keep], out_high[keep], doc_[keep]


def rounds(word: np.ndarray, by_doc: np.ndarray, levels: tuple[int, ...] = LEVELS) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(level, names, first words, words, documents) of the symbols after each of the given numbers of rounds."""
    doc = np.repeat(np.arange(len(by_doc) - 1), np.diff(by_doc))
    place = np.arange(len(word))
    state = (word, place, place, place + 1, doc)
    for r in range(max(levels, default=0)):
        state = name_round(*state, 100 + 10 * r)
        if r + 1 in levels and len(state[0]):
            sym, start, _, _, d = state
            yield r + 1, sym, start, np.minimum(np.append(start[1:], len(word)), by_doc[d + 1]) - start, d


#: BASE ** -1 modulo 2 ** 64.
_INVERSE = np.uint64(pow(int(kernel.BASE), -1, 2**64))


def fingerprints(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers): (sums[hi] - sums[lo]) * inverse[lo] is a polynomial hash of the words lo to hi, wherever they stand."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(kernel.mix(word, 7) * kernel.powers(len(word)), dtype=np.uint64)]) if len(word) else np.zeros(1, np.uint64)
        back = np.full(len(word) + 1, _INVERSE, np.uint64)
        back[0] = 1
        return sums, np.multiply.accumulate(back)


SYMBOL = "level int, s1 long, s2 long, doc_id long, th int, span long"


def symbols(docs: DataFrame, width: int = WIDTH, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """Symbols of at least ``width`` words: level, name, fingerprint, owner, and first word << 24 | words (cut below 2**24)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, th = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "th"))
            for i, _, d, o in kernel.chunks(*kernel.utf8(b.column("text"))):
                starts, ends, by_doc = kernel.words(d, o)
                word = kernel.hash_spans(d, starts, ends)
                sums, back = fingerprints(word)
                whole = np.arange(len(by_doc) - 1)
                with np.errstate(over="ignore"):
                    plain = np.concatenate([np.zeros(1, np.uint64), np.cumsum(word * kernel.powers(len(word)), dtype=np.uint64)]) if len(word) else sums
                    top = kernel.mix((plain[by_doc[1:]] - plain[by_doc[:-1]]) * back[by_doc[:-1]], 5)
                for level, name, start, n, doc in (*rounds(word, by_doc, levels), (WHOLE, top, by_doc[:-1], np.diff(by_doc), whole)):
                    long = np.flatnonzero((n >= width) & (n < 1 << 24))
                    if not len(long):
                        continue
                    name, start, n, doc = name[long], start[long], n[long], doc[long]
                    with np.errstate(over="ignore"):
                        second = kernel.mix((sums[start + n] - sums[start]) * back[start] + n.astype(np.uint64) * kernel.BASE, 6)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(long), level, np.int32)), pa.array(name.view(np.int64)), pa.array(second.view(np.int64)), pa.array(ids[i + doc]), pa.array(th[i + doc]),
                            pa.array((start - by_doc[doc]).astype(np.int64) << 24 | n),
                        ],
                        ["level", "s1", "s2", "doc_id", "th", "span"],
                    )

    return docs.mapInArrow(run, SYMBOL)


def shared_symbols(docs: DataFrame, width: int = WIDTH, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(doc_id, th, span): the symbols that a smaller document holds too, of the highest level for each document's words."""
    every = durable(symbols(docs, width, levels), "symbols")
    found, gone = None, None
    for level in sorted((WHOLE, *levels), reverse=True):
        rows = every.where(F.col("level") == level)
        rows = rows if gone is None else rows.join(gone, ["doc_id", "th"], "left_anti")
        first = rows.groupBy("s1", "s2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
        first = first.select(F.col("s1").bitwiseXOR(F.lit(0)).alias("__s1"), F.col("s2").alias("__s2"), "lo")  # plain exchanges, so that a hot symbol can be split
        mine = rows.join(first, (F.col("s1") == F.col("__s1")) & (F.col("s2") == F.col("__s2"))).where("doc_id > lo").select("doc_id", "th", "span")
        mine = durable(mine, f"shared-{level}")
        gone = mine.select("doc_id", "th") if level == WHOLE else gone
        found = mine if found is None else found.union(mine)
    return found


def window_keys(word: np.ndarray, by_doc: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, keys, names word for word, second names, documents) of all windows of a chunk; places count from the chunk's start."""
    doc = np.repeat(np.arange(len(by_doc) - 1), np.diff(by_doc))
    full = kernel.mix(kernel.rolling(word, width), 11)
    other = kernel.mix(kernel.rolling(kernel.mix(word, 7), width), 13)
    at = np.flatnonzero(doc[width - 1 :] == doc[: len(full)]) if len(full) else np.zeros(0, np.int64)
    full, other = full[at], other[at]
    if not len(at):
        return at, full, full, other, at
    place = np.arange(len(word))
    sym, _, lo, hi, _ = name_round(word, place, place, place + 1, doc, 100)
    usable = (hi - lo <= width) & (lo >= 0) & (hi < FAR)
    sym, lo, hi = sym[usable], lo[usable], hi[usable]
    if not len(sym):
        return at, other, full, other, doc[at]
    power = kernel.powers(width + 1)
    with np.errstate(over="ignore"):  # name of the context: its words, by rolling hashes of each length
        key = np.zeros(len(sym), np.uint64)
        for n in np.unique(hi - lo):
            pick = hi - lo == n
            key[pick] = kernel.mix(kernel.rolling(word, int(n))[lo[pick]] + np.uint64(n) * power[1], 12)
    # contexts ascend at both ends, so a window's symbols are a range; the least hash of the range is its key
    order = np.argsort(lo, kind="stable")
    lo, hi, key = lo[order], hi[order], key[order]
    first = np.searchsorted(lo, at)
    best = np.full(len(at), np.iinfo(np.uint64).max, np.uint64)
    none = np.ones(len(at), bool)
    for k in range(width):
        i = np.minimum(first + k, len(lo) - 1)
        inside = (first + k < len(lo)) & (lo[i] >= at) & (hi[i] <= at + width)
        none &= ~inside
        best = np.where(inside & (key[i] < best), key[i], best)
    return at, np.where(none, other, best), full, other, doc[at]


def _runs(key: np.ndarray, at: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of the runs of consecutive windows under one key, ``width`` windows at most."""
    head = np.ones(len(at), bool)
    head[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(head)
    n = np.diff(np.append(first, len(at)))
    if len(n) and n.max() > width:  # inside long runs of one word: every window is alike
        parts = (n - 1) // width + 1
        first = np.repeat(first, parts) + width * (np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts))
        n = np.diff(np.append(first, len(at)))
    return first, n


RUN = "key long, doc_id long, run long"


def window_runs(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, th = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "th"))
            for i, _, d, o in kernel.chunks(*kernel.utf8(b.column("text"))):
                starts, ends, by_doc = kernel.words(d, o)
                at, key, _, _, doc = window_keys(kernel.hash_spans(d, starts, ends), by_doc, width)
                first, n = _runs(key, at, doc, width)
                if len(first):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(short_keys(key[first])), pa.array(ids[i + doc[first]]), pa.array(pack_runs(at[first] - by_doc[doc[first]], n, th[i + doc[first]]))],
                        ["key", "doc_id", "run"],
                    )

    return docs.mapInArrow(run, RUN)


PIECE = "route long, doc_id long, th int, piece long, names array<long>"


def _within(spans: pa.Array, owner: np.ndarray, begin: np.ndarray, end: np.ndarray, rows: int) -> np.ndarray:
    """Whether the stretch of words [begin, end) of row ``owner`` lies inside one of its row's spans, given as lists of packed spans."""
    count = pa.compute.fill_null(pa.compute.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    if not count.sum():
        return np.zeros(len(owner), bool)
    packed = spans.flatten().to_numpy()
    row = np.repeat(np.arange(rows), count)
    far = np.int64(1) << 39
    lo = row * far + (packed >> 24)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], (row * far + (packed >> 24) + (packed & (1 << 24) - 1))[order]
    hi = np.maximum.accumulate(hi)  # spans of several levels may lie in one another
    at = np.searchsorted(lo, owner * far + begin, "right") - 1
    return (at >= 0) & (hi[np.maximum(at, 0)] >= owner * far + end) & (lo[np.maximum(at, 0)] // far == owner)


def pieces(chosen: DataFrame, width: int = WIDTH) -> DataFrame:
    """chosen(doc_id, th, text, hits, spans) -> the candidate runs, less those inside the spans, with the names of their windows.

    ``piece`` packs the first window, the number of windows and a bit for each window that a smaller document of the same
    batch holds too; those carry no names, as the smaller document speaks for them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, th = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "th"))
            hits, known_spans = b.column("hits"), b.column("spans")
            got: list[tuple[np.ndarray, ...]] = []
            for i, j, d, o in kernel.chunks(*kernel.utf8(b.column("text"))):
                starts, ends, by_doc = kernel.words(d, o)
                at, key, full, other, doc = window_keys(kernel.hash_spans(d, starts, ends), by_doc, width)
                if not len(at):
                    continue
                per = hits.slice(i, j - i)
                owner = np.repeat(np.arange(j - i), pa.compute.list_value_length(per).to_numpy(zero_copy_only=False))
                begin, n, hot = unpack_hits(per.flatten().to_numpy())
                open_ = ~_within(known_spans.slice(i, j - i), owner, begin, begin + n - 1 + width, j - i)
                owner, begin, n, hot = owner[open_], begin[open_] + by_doc[owner[open_]], n[open_], hot[open_]
                times = np.where(hot, n, 1)  # hot runs become runs of one window
                step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                begin, n, hot = np.repeat(begin, times) + step, np.repeat(np.where(hot, 1, n), times), np.repeat(hot, times)
                first = np.searchsorted(at, begin)
                fits = (first + n <= len(at)) & (at[np.minimum(first, len(at) - 1)] == begin)
                fits &= doc[np.minimum(first, len(at) - 1)] == doc[np.minimum(first + n, len(at)) - 1]
                first, n, hot = first[fits], n[fits], hot[fits]  # the others are of another text whose hash has the same bits
                route = np.where(hot, kernel.mix(other[first], 3), key[first])
                window = np.repeat(first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                got.append((route, ids[i + doc[first]], th[i + doc[first]], at[first] - by_doc[doc[first]], n, full[window]))
            if not got:
                continue
            route, who, text, start, n, name = map(np.concatenate, zip(*got, strict=True))
            lane = np.repeat(np.arange(len(n)), n)
            bit = np.arange(len(lane)) - np.repeat(np.cumsum(n) - n, n)
            seen = _later(name, route[lane], who[lane])
            known = np.zeros(len(n), np.int64)
            np.bitwise_or.at(known, lane, seen.astype(np.int64) << bit)
            silent = known == (np.int64(1) << n) - 1
            route = np.where(silent, kernel.mix(np.arange(len(n), dtype=np.uint64), 4), route)  # anywhere
            lengths = n - np.bitwise_count(known)
            piece = start.astype(np.int64) << 24 | n << 16 | known
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(route.view(np.int64)), pa.array(who), pa.array(text), pa.array(piece),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(name[~seen].view(np.int64))),
                ],
                ["route", "doc_id", "th", "piece", "names"],
            )

    return chosen.mapInArrow(run, PIECE)


def _later(name: np.ndarray, key: np.ndarray, holder: np.ndarray) -> np.ndarray:
    """Of windows, whether another of the same name and key has a smaller holder."""
    if not len(name):
        return np.zeros(0, bool)
    order = np.argsort(name, kind="stable")
    n, k = name[order], key[order]
    head = np.ones(len(n), bool)
    head[1:] = (n[1:] != n[:-1]) | (k[1:] != k[:-1])
    first = np.flatnonzero(head)
    least = np.minimum.reduceat(holder[order], first)
    out = np.zeros(len(n), bool)
    out[order] = holder[order] > np.repeat(least, np.diff(np.append(first, len(n))))
    return out


def marks(found: DataFrame, parts: int) -> DataFrame:
    """Pieces -> (doc_id, th, start, mask): the windows of each piece that a smaller document holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = [b for b in batches if b.num_rows]
        if not full:
            return
        t = pa.Table.from_batches(full).combine_chunks()
        names = t.column("names").combine_chunks()
        holder, key, piece = t.column("doc_id").to_numpy(), t.column("route").to_numpy(), t.column("piece").to_numpy()
        mask, windows = piece & 0xFFFF, start_bits(((np.int64(1) << (piece >> 16 & 255)) - 1) & ~(piece & 0xFFFF))
        lane, bit = np.nonzero(windows[:, :16])
        seen = _later(names.flatten().to_numpy().view(np.uint64), key[lane], holder[lane])
        np.bitwise_or.at(mask, lane, seen.astype(np.int64) << bit)
        hit = mask != 0
        yield pa.RecordBatch.from_arrays([pa.array(holder[hit]), pa.array(t.column("th").to_numpy()[hit]), pa.array(piece[hit] >> 24), pa.array(mask[hit])], ["doc_id", "th", "start", "mask"])

    return found.repartition(parts, "route").mapInArrow(run, "doc_id long, th int, start long, mask long")


def removed_spans(docs: DataFrame, width: int = WIDTH, hot: int = HOT, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """(doc_id, th, spans binary): pairs of little-endian 64-bit word numbers [from, to), ascending and apart."""
    if width > 16:
        raise ValueError("a piece has 16 bits for its windows")
    docs = keyed(docs)
    shared = shared_symbols(docs, width, levels)
    by_row = shared.groupBy("doc_id", "th").agg(F.collect_list("span").alias("spans")).select(F.col("doc_id").alias("__sid"), F.col("th").alias("__sth"), "spans")
    hits = candidates(window_runs(docs, width), across=True, hot=hot)
    hits = hits.join(by_row, (F.col("doc_id") == F.col("__sid")) & (F.col("th") == F.col("__sth")), "left").select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "hits", "spans")
    chosen = docs.join(hits, (F.col("doc_id") == F.col("__id")) & (F.col("th") == F.col("__th"))).select("doc_id", "th", "text", "hits", "spans")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    single = marks(pieces(chosen, width), parts).select("doc_id", "th", "start", "mask", F.lit(None).cast("long").alias("span"))
    every = single.union(shared.select("doc_id", "th", F.lit(None).cast("long"), F.lit(None).cast("long"), "span"))
    by_doc = every.groupBy("doc_id", "th").agg(*[F.collect_list(c).alias(c) for c in ("start", "mask", "span")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for start, mask, span in zip(b.column("start"), b.column("mask"), b.column("span"), strict=True):
                s, m, packed = (np.array(x.values.to_numpy(), np.int64) for x in (start, mask, span))
                at = (s[:, None] + np.arange(width))[start_bits(m)[:, :width]] if len(s) else s
                lo, hi = np.append(at, packed >> 24), np.append(at + width, (packed >> 24) + (packed & (1 << 24) - 1))
                order = np.argsort(lo, kind="stable")
                lo, hi = lo[order], np.maximum.accumulate(hi[order])
                first = np.append(True, lo[1:] > hi[:-1])
                rows.append(np.stack([lo[first], hi[np.append(first[1:], True)]], 1).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(rows, pa.binary())], ["doc_id", "th", "spans"])

    return by_doc.mapInArrow(run, "doc_id long, th int, spans binary")


def start_bits(mask: np.ndarray) -> np.ndarray:
    """Bits of 64-bit masks, lowest first."""
    return np.unpackbits(np.ascontiguousarray(mask).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(bool)


def dedup(docs: DataFrame, width: int = WIDTH, hot: int = HOT) -> DataFrame:
    """doc_id, kept (words that stay, joined by one space), n_words, n_removed."""
    spans = durable(removed_spans(docs, width, hot), "word-spans").withColumn("size", F.length("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = kernel.utf8(b.column("text"))
            texts, total, gone = [], [], []
            for i, s in enumerate(b.column("spans")):
                ws = data[off[i] : off[i + 1]].tobytes().split()
                n = len(ws)
                if s.is_valid:
                    pairs = np.frombuffer(s.as_py(), "<i8").reshape(-1, 2)
                    at, kept = 0, []
                    for lo, hi in pairs.tolist():
                        kept += ws[at:lo]
                        at = hi
                    ws = kept + ws[at:]
                texts.append(b" ".join(ws))
                total.append(n)
                gone.append(n - len(ws))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())], ["doc_id", "kept", "n_words", "n_removed"])

    rows = with_spans(docs.select(F.col("doc_id").cast("long"), "text"), spans, "size")
    return rows.select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, kept string, n_words long, n_removed long")


def op3(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
