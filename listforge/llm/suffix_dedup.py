"""Suffix-array dedup: bytes covered by a string of ``WIDTH`` bytes that starts anywhere else too.

1. Keys: a window of WIDTH bytes takes as key the least-hashed ``GRAM``-byte string inside it, so equal windows have equal
   keys. Windows that share the occurrence of their key are a run; keys with one run are done (``repeats.candidates``).
2. The texts of the other runs are cut out once, equal ones of a batch collapsed, and dealt to tasks by key. Hot keys are
   dealt by the ``WIDTH - FINE + 1`` bytes that a few neighbouring windows have in common.
3. A task walks its rows in key order in shards of about ``SHARD`` bytes. A shard's suffixes are sorted by Larsson-Sadakane
   refinement: ranks by 8 bytes, then by twice as many each round, only groups that still hold several suffixes being
   sorted again. Common prefixes of neighbours follow by Kasai's inequality, for blocks of positions at a time. Windows in a
   group of neighbours with WIDTH bytes in common repeat.
4. A key whose rows fill several shards leaves each shard's windows as a sorted list of names; the lists are merged by
   binary search and windows found in two of them repeat as well.
5. Documents drop the union of their repeated windows.

Defined results: a null text is empty. Rows without doc_id lose nothing and hold nothing. Rows that repeat a doc_id are rows like
others: with the same text they are copies of one another, with another text each loses its own repeats. An empty table gives
an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable
from . import kernel
from .repeats import HOT, candidates, keyed, pack_runs, short_keys, unpack_hits, with_spans

WIDTH, GRAM, FINE = 200, 64, 8
#: Documents are walked in chunks of so many bytes; longer ones in overlapping blocks.
CHUNK, BLOCK = 256 << 10, 8 << 20
SHARD = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    n = len(v) - width + 1
    span = 1
    while 2 * span <= width:
        v = np.minimum(v[:-span], v[span:])
        span *= 2
    return np.minimum(v[:n], v[width - span : width - span + n])


def run_starts(d: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a byte string's windows: (first window, key, place of the key's occurrence)."""
    firsts, keys, places = [], [], []
    for a in range(0, max(len(d) - width + 1, 0), BLOCK):
        part = d[a : a + BLOCK + width - 1]
        h = kernel.mix(kernel.rolling(kernel.BYTE[part], gram), 21)
        least = sliding_min((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), width - gram + 1)
        at = (least & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        firsts.append(first + a)
        keys.append(h[at[first]])
        places.append(at[first] + a)
    if not firsts:
        none = np.zeros(0, np.int64)
        return none, none.view(np.uint64), none
    first, key, place = map(np.concatenate, (firsts, keys, places))
    new = np.append(True, np.diff(place) != 0)  # a run may go on in the next block
    return first[new], key[new], place[new]


def chunk_runs(d: np.ndarray, o: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of the windows that stay in a document: (document, first window, windows, key, place), places from the chunk's start."""
    first, key, place = run_starts(d, width, gram)
    if not len(first):
        return first, first, first, key, place
    last = np.append(first[1:], len(d) - width + 1) - 1  # the run's last window
    doc = np.searchsorted(o, first, "right") - 1
    # windows that leave the document are cut off; a run of them may reach into the next document
    limit = o[1:] - width
    lo, hi = [first], [np.minimum(last, limit[doc])]
    docs, src = [doc], [np.arange(len(first))]
    over = np.flatnonzero(last > limit[doc])
    while len(over):
        doc2 = docs[-1][np.searchsorted(src[-1], over)] + 1
        ok = doc2 < len(o) - 1
        over, doc2 = over[ok], doc2[ok]
        ok = o[doc2] <= last[over]
        over, doc2 = over[ok], doc2[ok]
        lo.append(np.maximum(first[over], o[doc2]))
        hi.append(np.minimum(last[over], limit[doc2]))
        docs.append(doc2)
        src.append(over)
        over = over[last[over] > limit[doc2]]
    lo, hi, doc, src = map(np.concatenate, (lo, hi, docs, src))
    keep = hi >= lo
    order = np.argsort(lo[keep], kind="stable")
    return tuple(x[keep][order] for x in (doc, lo, hi - lo + 1, key[src], place[src]))


RUN = "key long, doc_id long, run long"


def window_runs(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, th = (b.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "th"))
            for i, _, d, o in kernel.chunks(*kernel.utf8(b.column("text")), CHUNK):
                doc, lo, n, key, _ = chunk_runs(d, o)
                if len(lo):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(short_keys(key)), pa.array(ids[i + doc]), pa.array(pack_runs(lo - o[doc], n, th[i + doc]))], ["key", "doc_id", "run"]
                    )

    return docs.mapInArrow(run, RUN)


PIECE = "route long, doc_id long, th int, start long, n int, known boolean, text binary"


def pieces(chosen: DataFrame) -> DataFrame:
    """chosen(doc_id, th, text, hits) -> candidate runs with their bytes.

    ``known``: an equal piece stands elsewhere in the batch, so all its windows repeat; one of the equals carries the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = list(zip(b.column("doc_id").to_pylist(), b.column("th").to_pylist(), strict=True))
            rows: list[list] = []
            where: dict[bytes, int] = {}

            def put(route: int, doc: tuple[int, int], start: int, n: int, text: bytes) -> None:
                same = where.setdefault(text, len(rows))
                if same != len(rows):
                    rows[same][5] = True
                    rows.append([route ^ len(rows), *doc, start, n, True, None])
                else:
                    rows.append([route, *doc, start, n, False, text])

            for i, _, d, o in kernel.chunks(*kernel.utf8(b.column("text")), CHUNK):
                doc, lo, n, key, place = chunk_runs(d, o)
                raw, signed = d.tobytes(), key.view(np.int64)
                begin = {}
                for r, (k, s) in enumerate(zip(doc.tolist(), (lo - o[doc]).tolist(), strict=True)):
                    begin[k, s] = r
                for k in range(len(o) - 1):
                    firsts, _, hots = unpack_hits(np.array(b.column("hits")[i + k].values.to_numpy()))
                    for start, hot in zip(firsts.tolist(), hots.tolist(), strict=True):
                        r = begin.get((k, start), -1)
                        if r < 0:  # of another text whose hash has the same bits
                            continue
                        a, m, route = int(lo[r]), int(n[r]), int(signed[r])
                        if not hot:
                            put(route, ids[i + k], start, m, raw[a : a + m - 1 + WIDTH])
                            continue
                        base = int(place[r]) - (WIDTH - GRAM)  # first window that may hold the key's occurrence
                        at = a
                        while at < a + m:
                            g = (at - base) // FINE
                            to = min(base + (g + 1) * FINE, a + m)
                            core = raw[base + g * FINE + FINE - 1 : base + g * FINE + WIDTH]
                            put(_signed(xxhash.xxh64_intdigest(core, g)), ids[i + k], at - int(o[k]), to - at, raw[at : to - 1 + WIDTH])
                            at = to
            cols = list(zip(*rows, strict=True)) or [()] * 7
            types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["route", "doc_id", "th", "start", "n", "known", "text"])

    return chosen.mapInArrow(run, PIECE)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def suffix_order(text: np.ndarray, reach: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, 8 bytes from every place and ``reach`` beyond), by Larsson-Sadakane refinement.

    The order is complete, as Kasai's inequality needs: it fails for suffixes that are only sorted to some depth.
    """
    n = len(text)
    word = np.concatenate([text, np.zeros(reach + 16, np.uint8)]).astype(np.uint64)
    for shift in (1, 2, 4):
        word = (word[:-shift] << np.uint64(8 * shift)) | word[shift:]
    sa = np.argsort(word[:n])
    rank = np.zeros(n + 1, np.int64)  # past the end: 0, below all

    def heads(key: np.ndarray) -> np.ndarray:
        return np.append(True, key[1:] != key[:-1])

    head = heads(word[sa])
    start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[sa] = start + 1
    single = head & np.append(head[1:], True)
    slots = np.flatnonzero(~single)  # places of the order that still share their rank
    h = 8
    while len(slots):
        s = sa[slots]
        group = rank[s]
        key = group * np.int64(n + 2) + rank[np.minimum(s + h, n)]
        order = np.argsort(key)
        s, key, group = s[order], key[order], group[order]
        sa[slots] = s
        head = heads(key)
        first = np.maximum.accumulate(np.where(head, slots, 0))
        rank[s] = first + 1
        slots = slots[~(head & np.append(head[1:], True))]
        h *= 2
    return sa, word


def common_prefixes(sa: np.ndarray, word: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix, up to cap bytes, of each suffix with the one before it in order; by place in the text.

    Kasai: the prefix of place i + k is at least that of i less k. Places are done by halving strides, each starting from
    what the place before it leaves.
    """
    n = len(sa)
    before = np.empty(n, np.int64)
    before[sa[1:]] = sa[:-1]
    before[sa[0]] = -1
    out = np.zeros(n, np.int64)
    stride = 64
    todo = np.arange(0, n, stride)
    known = np.zeros(len(todo), np.int64)
    while True:
        live = before[todo] >= 0
        p, q, l = todo[live], before[todo[live]], known[live]
        act = np.flatnonzero(l < cap)
        while len(act):
            x = word[p[act] + l[act]] ^ word[q[act] + l[act]]
            same = x == 0
            l[act] += np.where(same, 8, _leading(x))
            act = act[same & (l[act] < cap)]
        out[todo[live]] = np.minimum(l, cap)
        if stride == 1:
            return out
        todo = np.arange(stride // 2, n, stride)
        known = np.maximum(out[todo - stride // 2] - stride // 2, 0)
        stride //= 2


def _leading(x: np.ndarray) -> np.ndarray:
    """Zero bytes at the high end of 64-bit words."""
    out = np.zeros(len(x), np.int64)
    for shift in (32, 16, 8):
        low = (x >> np.uint64(64 - shift)) == 0
        out += np.where(low, shift // 8, 0)
        x = np.where(low, x << np.uint64(shift), x)
    return out


def repeated_windows(texts: list[bytes], counts: np.ndarray, many: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one shard's texts with their numbers of windows: (repeats by window, text of each window, place of each window).

    many: the text stands in several places.
    """
    text = np.frombuffer(b"".join(texts), np.uint8)
    sa, word = suffix_order(text, width + 8)
    near = common_prefixes(sa, word, width)[sa] >= width
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    lane = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + (np.cumsum(size) - size)[lane]
    weight = np.zeros(len(text), np.int64)
    weight[place] = 1 + many[lane]
    first = np.flatnonzero(~near)
    total = np.add.reduceat(weight[sa], first)
    again = np.zeros(len(text), bool)
    again[sa] = np.repeat(total > 1, np.diff(np.append(first, len(sa))))
    return again[place], lane, place


def spans_of(found: DataFrame, parts: int, shard: int = SHARD) -> DataFrame:
    """Pieces -> (doc_id, th, lo, hi): stretches of repeated windows as byte spans, unmerged."""

    def walk(rows: Iterator[tuple]) -> Iterator[list[tuple]]:
        """Shards of rows in route order: cut where the route changes, or inside a route that is too large."""
        held, size = [], 0
        for row in rows:
            if size >= shard and (row[0] != held[-1][0] or size >= 4 * shard):
                yield held
                held, size = [], 0
            held.append(row)
            size += len(row[6])
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[int, int, int, int]] = []

        def rows() -> Iterator[tuple]:
            for b in batches:
                for row in zip(*[b.column(k).to_pylist() for k in range(7)], strict=True):
                    if row[6] is None:
                        done.append((row[1], row[2], row[3], row[3] + row[4] - 1 + WIDTH))
                    else:
                        yield row

        def flush() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True)) or [()] * 4
            done.clear()
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], ["doc_id", "th", "lo", "hi"])

        def mark(held: list[tuple], row: np.ndarray, at: np.ndarray) -> None:
            """Stretches of windows ``at`` of rows ``row``, both ascending."""
            if len(row):
                cut = np.flatnonzero((np.diff(row) != 0) | (np.diff(at) != 1)) + 1
                for r, a, z in zip(row[np.append(0, cut)].tolist(), at[np.append(0, cut)].tolist(), at[np.append(cut, len(at)) - 1].tolist(), strict=True):
                    done.append((held[r][1], held[r][2], held[r][3] + a, held[r][3] + z + WIDTH))

        open_route, lists = None, []  # sorted names of the windows of a route that goes on in the next shard

        def settle() -> None:
            """Merge a route's lists: names that stand in several repeat, and each list finds its own by binary search."""
            names, count = np.unique(np.concatenate([np.unique(x[0]) for x in lists]), return_counts=True)
            again = names[count > 1]
            for mine, order, held, row, at in lists if len(again) else ():
                i = np.minimum(np.searchsorted(again, mine), len(again) - 1)
                pick = np.sort(order[again[i] == mine])
                mark(held, row[pick], at[pick])
            lists.clear()

        for held in walk(rows()):
            texts: dict[bytes, int] = {}
            lane_of = [texts.setdefault(r[6], len(texts)) for r in held]
            many = np.zeros(len(texts), np.int64)
            counts = np.zeros(len(texts), np.int64)
            seen: set[int] = set()
            for r, t in zip(held, lane_of, strict=True):
                many[t] = 1 if r[5] or t in seen else many[t]
                counts[t] = r[4]
                seen.add(t)
            again, lane, place = repeated_windows(list(texts), counts, many)
            base = np.cumsum(counts) - counts
            for r, (row, t) in enumerate(zip(held, lane_of, strict=True)):
                hit = np.flatnonzero(again[base[t] : base[t] + counts[t]])
                mark(held, np.full(len(hit), r), hit)
            for route in dict.fromkeys((held[0][0], held[-1][0])):
                if route != open_route and route != held[-1][0]:
                    continue
                if route != open_route:
                    if len(lists) > 1:
                        settle()
                    lists.clear()
                    open_route = route
                mine = [row for row in held if row[0] == route]
                names = [kernel.mix(kernel.rolling(kernel.BYTE[np.frombuffer(row[6], np.uint8)], WIDTH), 31) for row in mine]
                size = [len(x) for x in names]
                names = np.concatenate(names)
                order = np.argsort(names)
                row_no = np.repeat(np.arange(len(mine)), size)
                at_no = np.arange(len(names)) - np.repeat(np.cumsum(size) - size, size)
                lists.append((names[order], order, [row[:4] for row in mine], row_no, at_no))
            if len(done) > 50_000:
                yield flush()
        if len(lists) > 1:
            settle()
        yield flush()

    ordered = found.repartition(parts, "route").sortWithinPartitions("route")
    return ordered.mapInArrow(run, "doc_id long, th int, lo long, hi long")


def removed_spans(docs: DataFrame, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """(doc_id, th, spans binary): pairs of little-endian 64-bit byte places [from, to), ascending and apart."""
    docs = keyed(docs)
    hits = candidates(window_runs(docs), across=False, hot=hot).withColumnsRenamed({"doc_id": "__id", "th": "__th"})
    chosen = docs.join(hits, (F.col("doc_id") == F.col("__id")) & (F.col("th") == F.col("__th"))).select("doc_id", "th", "text", "hits")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    found = spans_of(pieces(chosen), parts, shard)
    by_doc = found.groupBy("doc_id", "th").agg(F.collect_list("lo").alias("lo"), F.collect_list("hi").alias("hi"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lo, hi in zip(b.column("lo"), b.column("hi"), strict=True):
                a, z = lo.values.to_numpy().astype(np.int64), hi.values.to_numpy().astype(np.int64)
                order = np.argsort(a, kind="stable")
                a, z = a[order], np.maximum.accumulate(z[order])
                first = np.append(True, a[1:] > z[:-1])
                out.append(np.stack([a[first], z[np.append(first[1:], True)]], 1).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("th"), pa.array(out, pa.binary())], ["doc_id", "th", "spans"])

    return by_doc.mapInArrow(run, "doc_id long, th int, spans binary")


def dedup(docs: DataFrame, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """doc_id, kept binary (the bytes that stay), n_bytes, n_removed, n_spans."""
    spans = durable(removed_spans(docs, hot, shard), "byte-spans").withColumn("size", F.length("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = kernel.utf8(b.column("text"))
            kept, total, gone, n_spans = [], [], [], []
            for i, s in enumerate(b.column("spans")):
                raw = data[off[i] : off[i + 1]].tobytes()
                pairs = np.frombuffer(s.as_py(), "<i8").reshape(-1, 2).tolist() if s.is_valid else []
                at, parts = 0, []
                for lo, hi in pairs:
                    parts.append(raw[at:lo])
                    at = hi
                parts.append(raw[at:])
                kept.append(b"".join(parts))
                total.append(len(raw))
                gone.append(len(raw) - len(kept[-1]))
                n_spans.append(len(pairs))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(kept, pa.binary()), *[pa.array(x, pa.int64()) for x in (total, gone, n_spans)]], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    rows = with_spans(docs.select(F.col("doc_id").cast("long"), "text"), spans, "size")
    return rows.select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def op2(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
