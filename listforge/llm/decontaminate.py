"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: words without punctuation, in lower case, with numbers, names and units
replaced by typed placeholders; a number in words counts as its figure, a unit glued to a number as a token of its own. Windows of ``WIDTH`` template tokens are hashed; windows of documents are hash-joined with
windows of benchmark items. Windows that lie on one diagonal (same shift between document and item) form a match. A match
counts if it covers enough of the item, its slots are consistent (within each type, equal values in the item are equal
values in the document and different ones differ), and there is evidence beside the mould of placeholders: ``LITERALS``
different words of the item stand in it, or all its slots hold the item's own values. So a question with other numbers or
names is found, while texts that share a mould like *add n and n and n* are found only where they are the item itself.

A capital that opens a sentence may be a name or not, so a window is hashed with its openers as words, as names, and by turns
(``forms``): that is each way for two openers in a window. Windows with hardly any word in them (under ``MIN_LITERAL``), which
any list of numbers or names would share, are matched on their words and values as they are.

The hashes of the benchmark are sent to the tasks that scan the documents, in blocks of ``BLOCK`` hashes at most, a scan a
block; only document windows that meet one of the benchmark reach the join.

Defined results: null and empty texts match nothing. Items under ``MIN_TOKENS`` template tokens are too short to be
evidence and match nothing; items under ``WIDTH`` tokens match as a whole. Texts of any length are scanned whole. Rows that
repeat a doc_id give one pair; a null doc_id gives pairs with a null doc_id. An empty table on either side gives no pairs.
Further columns, of whatever name, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable
from . import kernel
from .common import fresh, table

WIDTH, MIN_TOKENS, RUN, MIN_LITERAL, LITERALS = 8, 3, 13, 0.25, 3
BLOCK = 4_000_000
#: The number of the way that keeps all words, behind the forms.
EXACT = 4
#: Words that are a unit behind a number.
UNITS = """
mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers
mg g kg lb lbs oz ton tons tonne tonnes gram grams kilogram kilograms pound pounds ounce ounces
ml l cl litre litres liter liters gallon gallons pint pints cup cups
s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years
percent pct usd eur gbp dollar dollars euro euros cent cents mph kph kmh degrees degree watts watt volts volt
""".split()
#: Numbers in words, by their value; compounds like *twenty-five* follow from them.
ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
NUM, NAME, UNIT = np.uint64(0x11), np.uint64(0x22), np.uint64(0x33)

_CORE = np.zeros(256, dtype=bool)  # letters, digits and all of non-ASCII
_CORE[48:58] = _CORE[65:91] = _CORE[97:123] = _CORE[128:] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:;"]] = True


def _hash_words(ws: list[str]) -> np.ndarray:
    raw = [w.encode() for w in ws]
    ends = np.cumsum([len(w) for w in raw])
    return kernel.hash_spans(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends)


_UNITS = np.sort(_hash_words(UNITS))
_SPELT = {w: n for n, w in enumerate(ONES)} | {t + (ONES[k] if k else ""): 20 + 10 * i + k for i, t in enumerate(TENS) for k in range(10)}
_SPELT_HASHES, _SPELT_VALUES = _hash_words(list(_SPELT)), _hash_words([str(n) for n in _SPELT.values()])
_SPELT_VALUES, _SPELT_HASHES = _SPELT_VALUES[np.argsort(_SPELT_HASHES)], np.sort(_SPELT_HASHES)


def _unit_starts(raw: np.ndarray, low: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words that are a number with a unit glued to it, where the unit starts)."""
    digit = (raw >= 48) & (raw <= 57)
    other = np.append(np.flatnonzero(~digit), len(raw))
    mid = np.minimum(other[np.searchsorted(other, lo)], hi)
    digits = np.concatenate([[0], np.cumsum(digit)])
    glued = np.flatnonzero((mid > lo) & (mid < hi) & (digits[hi] - digits[lo] == mid - lo))
    if not len(glued):
        return glued, mid[glued]
    suffix = kernel.hash_spans(low, mid[glued], hi[glued])
    glued = glued[_UNITS[np.minimum(np.searchsorted(_UNITS, suffix), len(_UNITS) - 1)] == suffix]
    return glued, mid[glued]


def template(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, values, is slot, offsets by document, is opener): a literal's code is its hash, a slot's code its type."""
    starts, ends, _ = kernel.words(data, offsets)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none, none.astype(bool), np.zeros(len(offsets), np.int64), none.astype(bool)
    keep = _CORE[data]
    counts = np.add.reduceat(keep, starts, dtype=np.int64)
    first_word = np.zeros(len(starts) + 1, bool)
    first_word[np.searchsorted(starts, offsets)] = True
    line = np.cumsum(data == 10)
    opens = first_word[:-1].copy()
    opens[1:] |= _STOP[data[ends[:-1] - 1]] | (line[starts[1:]] != line[ends[:-1] - 1])
    has = counts > 0
    after = np.zeros(len(starts), bool)  # a stop may also be a word of its own: what stands behind it opens a sentence
    after[1:] = ~has[:-1] & opens[1:]
    starts, counts, opens = starts[has], counts[has], (opens | after)[has]
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none, none.astype(bool), np.zeros(len(offsets), np.int64), none.astype(bool)
    raw = data[keep]
    hi = np.cumsum(counts)
    lo = hi - counts
    low = kernel.ASCII_LOWER[raw]
    latin = np.zeros(len(raw), bool)
    latin[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    low[latin] += 32
    glued, mid = _unit_starts(raw, low, lo, hi)
    if len(glued):  # *5kg* becomes *5* and *kg*
        ends_at = hi[glued]
        hi[glued] = mid
        lo, hi = np.insert(lo, glued + 1, mid), np.insert(hi, glued + 1, ends_at)
        starts, counts, opens = np.insert(starts, glued + 1, starts[glued]), hi - lo, np.insert(opens, glued + 1, False)
    values = kernel.hash_spans(low, lo, hi)
    digit = np.logical_or.reduceat((raw >= 48) & (raw <= 57), lo)
    at = np.minimum(np.searchsorted(_SPELT_HASHES, values), len(_SPELT_HASHES) - 1)
    spelt = _SPELT_HASHES[at] == values
    values, digit = np.where(spelt, _SPELT_VALUES[at], values), digit | spelt
    second = np.minimum(lo + 1, len(raw) - 1)
    upper = ((raw[lo] >= 65) & (raw[lo] <= 90)) | (latin[second] & (counts > 1) & (raw[lo] == 0xC3))
    name = upper & ~opens & ~digit
    at = np.searchsorted(_UNITS, values)
    unit = np.zeros(len(values), bool)
    unit[1:] = digit[:-1] & (_UNITS[np.minimum(at, len(_UNITS) - 1)] == values)[1:] & ~digit[1:]
    codes = np.where(digit, NUM, np.where(unit, UNIT, np.where(name, NAME, values)))
    return codes, values, digit | unit | name, np.searchsorted(starts, offsets), upper & opens & ~digit & ~unit


def forms(codes: np.ndarray, slot: np.ndarray, opener: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(codes, is slot) with no opener as a name, with all, and with every second one from either side."""
    odd = (np.cumsum(opener) & 1).astype(bool)
    masks = (np.zeros(len(codes), bool), opener, opener & odd, opener & ~odd)
    return [(np.where(m, NAME, codes), slot | m) for m in masks]


def windows(codes: np.ndarray, slot: np.ndarray, offsets: np.ndarray, width: int, heavy: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the windows of one width that stay in a document and hold enough literals; heavy: too few."""
    h = kernel.mix(kernel.rolling(codes, width), width + 100 * heavy)
    if not len(h):
        return np.zeros(0, np.int64), h
    at = np.arange(len(h))
    doc_end = np.repeat(offsets[1:], np.diff(offsets))[: len(h)]
    slots = np.concatenate([[0], np.cumsum(slot)])
    ok = (at + width <= doc_end) & ((width - (slots[width:] - slots[:-width]) >= MIN_LITERAL * width) != heavy)
    return np.flatnonzero(ok), h[ok]


def _touched(opener: np.ndarray, pos: np.ndarray, width: int) -> np.ndarray:
    """Whether the windows hold an opener."""
    n = np.concatenate([[0], np.cumsum(opener)])
    return n[pos + width] > n[pos]


WINDOW = "id long, pos int, n int, width int, form int, h long, slots array<struct<t:int,v:long>>, words array<long>"


def _lists(mask: np.ndarray, *values: np.ndarray) -> tuple[pa.Array, list[np.ndarray]]:
    """(list offsets, flat values) of the cells that are set in each row of a matrix."""
    return pa.array(np.append(0, np.cumsum(mask.sum(axis=1))).astype(np.int32)), [v[mask] for v in values]


def _scan(key: str, widths, wanted, items: bool = False):
    """wanted: sorted hashes of which a window must have one. items: only windows of the item's own width, with their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wanted.value if wanted is not None else None
        for b in batches:
            data, off = kernel.utf8(b.column("text"))
            ids = b.column(key)
            for i, j, d, o in kernel.chunks(data, off):
                first, values, plain, by_doc, opener = template(d, o)
                length = np.diff(by_doc)
                ways = forms(first, plain, opener)
                # the last way: all words as they are, where the form of most slots is too heavy; it holds no slots
                ways.append((values, ways[1][1]))
                for width, form in product(widths, range(len(ways))):
                    codes, slot = ways[form]
                    pos, h = windows(codes, slot, by_doc, width, form == EXACT)
                    if 0 < form < EXACT:
                        own = _touched(opener, pos, width)
                        pos, h = pos[own], h[own]
                    doc = np.searchsorted(by_doc, pos, "right") - 1
                    if known is not None and len(h):
                        at = np.searchsorted(known, h)
                        take = known[np.minimum(at, len(known) - 1)] == h
                        pos, h, doc = pos[take], h[take], doc[take]
                    if items:
                        take = np.minimum(length[doc], WIDTH) == width
                        pos, h, doc = pos[take], h[take], doc[take]
                    if not len(pos):
                        continue
                    cells = pos[:, None] + np.arange(width)
                    held = slot[cells] if form != EXACT else np.zeros(cells.shape, bool)
                    to, (t, v) = _lists(held, codes[cells], values[cells])
                    slots = pa.ListArray.from_arrays(to, pa.StructArray.from_arrays([pa.array(t.astype(np.int32)), pa.array(v.view(np.int64))], ["t", "v"]))
                    to, (w,) = _lists(~held if items else np.zeros(cells.shape, bool), values[cells])
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(doc + i)), pa.array((pos - by_doc[doc]).astype(np.int32)), pa.array(length[doc].astype(np.int32)),
                            pa.array(np.full(len(pos), width, np.int32)), pa.array(np.full(len(pos), form, np.int32)), pa.array(h.view(np.int64)), slots, pa.ListArray.from_arrays(to, pa.array(w.view(np.int64))),
                        ],
                        ["id", "pos", "n", "width", "form", "h", "slots", "words"],
                    )

    return run


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of the items; an item shorter than WIDTH is one window of its own width."""
    scan = _scan("item_id", list(range(MIN_TOKENS, WIDTH + 1)), None, True)
    return benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(scan, WINDOW)


def document_windows(docs: DataFrame, items: DataFrame, block: int = BLOCK) -> DataFrame:
    """Windows of the documents that have the hash of one of the items' windows."""
    spark = docs.sparkSession
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # WIDTH - MIN_TOKENS + 1 values at most
    blocks = max(1, -(-items.count() // block))
    texts, out = docs.select(F.col("doc_id").cast("long"), "text"), None
    for k in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("h"), F.lit(blocks)) == k).select("h").distinct()
        hashes = np.sort(np.array([r[0] for r in mine.collect()], dtype=np.int64).view(np.uint64))
        sent = spark.sparkContext.broadcast(hashes if len(hashes) else np.zeros(1, np.uint64))
        found = durable(texts.mapInArrow(_scan("doc_id", widths, sent), WINDOW), "windows")
        sent.unpersist()
        out = found if out is None else out.union(found)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, run: int = RUN, block: int = BLOCK) -> DataFrame:
    """Pairs (doc_id, item_id) with the tokens covered by the best match, the item's length and its number of slots."""
    items = durable(item_windows(benchmark), "items")
    found = document_windows(docs, items, block)
    d = found.select(F.col("id").alias("doc_id"), "h", "width", F.col("form").alias("dform"), F.col("pos").alias("dpos"), F.col("slots").alias("dslots"))
    i = items.select(F.col("id").alias("item_id"), "h", "width", F.col("form").alias("iform"), F.col("pos").alias("ipos"), F.col("n").alias("item_tokens"), F.col("slots").alias("islots"), "words")
    hits = (
        d.join(i, ["h", "width"])
        .withColumn("shift", F.col("dpos") - F.col("ipos"))
        .withColumn("same", F.arrays_zip("islots", "dslots"))
        # openers that are no names may break the slots of all forms together, so the first form is judged by itself too
        .withColumn("apart", F.explode(F.when(F.col("iform").isin(0, EXACT) & F.col("dform").isin(0, EXACT), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False)))))
    )
    diagonal = hits.groupBy("doc_id", "item_id", "shift", "apart").agg(
        F.sort_array(F.collect_set("ipos")).alias("at"),
        F.max("width").alias("width"),
        F.max("item_tokens").alias("item_tokens"),
        F.array_distinct(F.flatten(F.collect_set("same"))).alias("pairs"),
        F.size(F.array_distinct(F.flatten(F.collect_set("words")))).alias("literals"),
    )
    covered = F.aggregate(
        "at",
        F.struct(F.lit(-1_000_000).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.col("width"), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    sides = [F.size(F.array_distinct(F.col(f"pairs.{s}"))) for s in ("islots", "dslots")]
    verbatim = F.forall("pairs", lambda p: p["islots"] == p["dslots"])
    return (
        diagonal.withColumn("covered", covered)
        .where(F.col("covered") >= F.least(F.lit(run), F.col("item_tokens")))
        .where((sides[0] == F.size("pairs")) & (sides[1] == F.size("pairs")))
        .where((F.col("literals") >= LITERALS) | verbatim)
        .groupBy("doc_id", "item_id")
        .agg(F.max("covered").alias("covered"), F.max("item_tokens").alias("item_tokens"), F.max(F.size("pairs")).alias("n_slots"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that match an item; rows without doc_id stay."""
    (id_,) = fresh(docs, "__id")
    out = contaminated(docs, benchmark).where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias(id_)).distinct()
    return docs.join(out, docs["doc_id"] == F.col(id_), "left_anti")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
