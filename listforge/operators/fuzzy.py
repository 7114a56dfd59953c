"""Pairs of names whose score reaches a limit, all of them, without comparing everything with everything.

The score is 2 * LCS / (length + length) of the token-sorted names, so a pair reaches the limit only with at most
``(1 - limit) * (sum of the lengths)`` single-character insertions and deletions. Most pairs take few operations (``LEVELS``). For these the
characters are dealt to classes; what a name holds of one class, in its order, knows no places, and each operation touches one class
alone. So one class stays within its share of the operations, and what is left of both names' parts of it without as many characters is the same.
A pair of longer names takes more: the longer name is cut into parts that each take up to
two operations, so many that one more operation than any shorter partner may need would fill them all: some part then stays within its own.
It stands in the shorter name with so few characters gone on either side that what is left of both is the same: a subsequence of nearly the
whole part, which few other names share. The first such part by count leaves few places where it can stand: each part before it takes more
operations than its own, and what is left must do for the rest. Both names are looked up by (length of the longer, part, what is left of it).
Keys are hashes whose equals only make more rows, in plain equi-joins whose hot keys adaptive execution can split; a word of 64 bits, in which
each operation turns one bit at most, holds off most of the names that share a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names as N
from ..session import durable

#: Longer names are looked up by their segments alone, wherever these stand: that takes a number of keys that grows with the length only.
LONG = 128
#: Most operations of a part and one; names that one task makes keys of.
OWN, DEALT = 3, 5000
#: (most operations of a pair, classes, operations of a class): the classes can't all have one more.
LEVELS = ((0, 1, 0), (1, 1, 1), (3, 2, 1), (5, 3, 1), (8, 3, 2), (11, 4, 2), (14, 5, 2))
#: Pairs of a key that are compared as a block, pairs of a block, and pairs whose subsequences are found at once.
LARGE, BLOCK, CHUNK = 4096, 1 << 16, 1 << 15
#: Most characters that are told apart; the others go by their code points.
KNOWN = 1024


def sorted_tokens(core: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(core, " "), lambda t: t != "")), " ")


def _slack(limit: float) -> float:
    """Operations a character; a score counts as rounded to four places."""
    return 1 - limit + 0.00005 + 1e-9


def _segments(length: str, slack: float) -> str:
    """SQL: (number, first character, size) of the segments of a name of some length; sizes differ by one at most."""
    n = f"(CAST(floor({2 * slack} * {length}) AS INT) + 1)"
    short = f"({n} - {length} % {n})"
    return f"transform(sequence(0, {n} - 1), i -> named_struct('i', i, 'at', i * ({length} DIV {n}) + greatest(0, i - {short}), 'size', CAST({length} DIV {n} AS INT) + IF(i >= {short}, 1, 0)))"


def _parts(limit: float, most: int) -> list[tuple[int, ...]]:
    """(length, part, first character, size, operations, operations that the parts before it take, whether it is the last) for each length."""
    out = []
    for length in range(1, most + 1):
        ops = int(2 * _slack(limit) * length)
        n = -(-(ops + 1) // OWN)
        own = [(ops + 1) // n - 1 + (k < (ops + 1) % n) for k in range(n)]  # with one more each they are the operations and one
        rest, at, before = length - sum(own), 0, 0
        for k, t in enumerate(own):
            size = rest // n + (k < rest % n) + t
            out.append((length, k, at, size, t, before, int(k == n - 1)))
            at, before = at + size, before + t + 1
    return out


def _without(s: str, n: int) -> str:
    """SQL: the different strings that are left of one without n characters."""
    if n == 0:
        return f"array({s})"
    v = f"v{n}"
    one = f"IF({v} = '', CAST(array() AS array<string>), transform(sequence(1, length({v})), p{n} -> concat(substring({v}, 1, p{n} - 1), substring({v}, p{n} + 1))))"
    return f"array_distinct(flatten(transform({_without(s, n - 1)}, {v} -> {one})))"


def _key(of: str, i: str, left: str) -> Column:
    return F.expr(f"xxhash64({of}, {i}, {left})")


def _longer_keys(df: DataFrame, parts: DataFrame, slack: float) -> DataFrame:
    """Names as the longer of a pair: a row a part and what may be left of it."""
    cut = df.join(F.broadcast(parts), F.col("len") == F.col("of")).withColumn("s", F.expr("substring(name, at + 1, size)"))
    left = " ".join(f"WHEN {t} THEN flatten(array({', '.join(_without('s', x) for x in range(t + 1))}))" for t in range(OWN))
    near = cut.withColumn("seg", F.explode(F.expr(f"CASE own {left} END"))).select("name", _key("of", "i", "seg").alias("key"))
    far = df.where(F.col("len") > LONG).withColumn("g", F.explode(F.expr(_segments("len", slack))))
    return near.union(far.select("name", _key("-1", "-1", "substring(name, CAST(g.at + 1 AS INT), g.size)")))


def _shorter_keys(df: DataFrame, parts: DataFrame, slack: float) -> DataFrame:
    """Names as the shorter of a pair, or one as long: a row a longer length, part and what may be left of it where it may stand."""
    most = f"CAST(floor(len * (1 + {slack}) / (1 - {slack}) + 1e-6) AS INT)"
    grown = df.withColumn("of", F.explode(F.expr(f"sequence(len, greatest(len, least({LONG}, {most})))"))).where(f"of <= {LONG}")
    grown = grown.join(F.broadcast(parts), "of").withColumn("d", F.expr(f"CAST(floor({slack} * (len + of)) AS INT)"))
    # sh: how far the part stands from its place in the longer name; more: by how much it is longer there
    shifts = "CASE WHEN i = 0 THEN array(0) WHEN last = 1 THEN array(len - of - more) ELSE sequence(-d, d) END"
    places = f"flatten(transform(sequence(-own, own), more -> transform({shifts}, sh -> named_struct('more', more, 'sh', sh))))"
    fits = "greatest(before, abs(p.sh)) + abs(p.more) + abs(len - of - p.sh - p.more) <= d AND at + p.sh >= 0 AND size + p.more >= 0 AND at + p.sh + size + p.more <= len"
    fits += " AND (last = 0 OR p.sh + p.more = len - of)"
    # of the operations on the part as many as its own allows, by whose parity the two sizes differ
    gone = "(own - pmod(own - p.more, 2) + p.more) DIV 2"
    there = "substring(name, at + p.sh + 1, size + p.more)"
    left = " ".join(f"WHEN {n} THEN {_without(there, n)}" for n in range(OWN))
    keys = f"array_distinct(flatten(transform(filter({places}, p -> {fits}), p -> CASE CAST({gone} AS INT) {left} END)))"
    near = grown.withColumn("seg", F.explode(F.expr(keys))).select("name", _key("of", "i", "seg").alias("key"))
    n = f"(CAST(floor({2 * slack} * o) AS INT) + 1)"
    sizes = f"array_distinct(flatten(transform(sequence(greatest(len, {LONG + 1}), greatest(len, {LONG + 1}, {most})), o -> array(CAST(o DIV {n} AS INT), CAST(o DIV {n} AS INT) + 1))))"
    sizes = df.where(f"{most} > {LONG}").withColumn("size", F.explode(F.expr(sizes)))
    everywhere = sizes.where("size BETWEEN 1 AND len").withColumn("seg", F.explode(F.expr("array_distinct(transform(sequence(1, len - size + 1), p -> substring(name, p, size)))")))
    return near.union(everywhere.select("name", _key("-1", "-1", "seg")))


def _levels(slack: float, length: int) -> list[int]:
    """The levels at which a name of some length may have a partner."""
    found = set()
    for other in range(int(length * (1 - slack) / (1 + slack)), int(length * (1 + slack) / (1 - slack)) + 2):
        ops, by = int(slack * (length + other)), abs(length - other)
        if by <= ops <= LEVELS[-1][0]:  # lengths that differ by an odd number take an odd number of operations
            found.add(next(k for k, (most, _, _) in enumerate(LEVELS) if most >= ops - (ops - by) % 2))
    return sorted(found)


class _Outside(dict):
    """str.translate table: the characters of other classes go. Characters that aren't known have the class of their code point."""

    def __init__(self, known: dict[int, int], classes: int, c: int) -> None:
        super().__init__({p: p if k == c else None for p, k in known.items()})
        self.classes, self.c = classes, c

    def __missing__(self, point: int) -> int | None:
        return point if point % self.classes == self.c else None


def _classes(counts: list[tuple[str, int]], classes: int) -> list[_Outside]:
    """Classes that hold about as much of the names each; counts of characters, frequent ones first."""
    load, known = [0] * classes, {}
    for char, n in counts:
        known[ord(char)] = c = load.index(min(load))
        load[c] += n
    return [_Outside(known, classes, c) for c in range(classes)]


def _class_keys(df: DataFrame, counts: list[tuple[str, int]], slack: float, left: bool) -> DataFrame:
    """(name, len, bits, key): what may be left of the classes of a name.

    In phase ``t`` a left name lacks ``t`` characters of a class, a right one up to as many as the operations of the class then leave.
    """
    at = {ord(char): k for k, (char, _) in enumerate(counts)}
    tables = [(own, _classes(counts, classes)) for _, classes, own in LEVELS]
    levels = {n: _levels(slack, n) for n in range(1, LONG + 1)}

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            words, found = [], []
            for name in names:
                word, here = 0, []
                for point in map(ord, name):
                    # a bit for one, two and three of each of the twelve most frequent characters; the others share fourteen times two
                    k = at.get(point, point)
                    for bit in range(3 * k, 3 * k + 3) if k < 12 else range(36 + 2 * (k % 14), 38 + 2 * (k % 14)):
                        if not word >> bit & 1:
                            word |= 1 << bit
                            break
                for k in levels[len(name)]:
                    own, classes = tables[k]
                    for c, table in enumerate(classes):
                        gone = [{name.translate(table)}]
                        for _ in range(own):
                            gone.append({s[:i] + s[i + 1 :] for s in gone[-1] for i in range(len(s))})
                        for t in range(own + 1):
                            here += [f"{k}.{c}.{t}.{s}" for some in (gone[t : t + 1] if left else gone[: own - t + 1]) for s in some]
                words.append(word - (word >> 63 << 64))
                found.append(here)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.int64()), pa.array(found, pa.list_(pa.string()))], names=["name", "bits", "keys"])

    spread = df.where(F.col("len") <= LONG).select("name").mapInArrow(keys, "name string, bits long, keys array<string>")
    return spread.withColumn("seg", F.explode("keys")).select(F.xxhash64("seg").alias("key"), F.lit(0 if left else 1).alias("side"), F.length("name").alias("len"), "bits", "name")


def _coded(names: list[str], codes: np.ndarray) -> np.ndarray:
    """One row a name of 63 characters at most, one byte a character; zeros fill it up."""
    points = np.array([s[:63] for s in names]).view(np.uint32).reshape(len(names), -1)
    out, length = codes[points], np.array([len(s) for s in names])
    out[(out == 0) & (np.arange(out.shape[1]) < length[:, None])] = 1
    return out


def _neighbours(coded: np.ndarray) -> np.ndarray:
    """A word of 64 bits a name, for the pairs of characters that stand side by side: an operation turns three bits at most."""
    out = np.zeros(len(coded), np.uint64)
    for a, b in zip(coded.T[:-1].astype(np.uint64), coded.T[1:].astype(np.uint64), strict=True):
        out |= (b > 0).astype(np.uint64) << ((a * np.uint64(37) + b) & np.uint64(63))
    return out


def _common(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of rows a of left and rows b of right, as ``names._lcs``, a word of 64 bits a pair."""
    where, each = np.zeros((len(left), 64), np.uint64), np.arange(len(left))
    for i, code in enumerate(left.T):
        where[each, code] |= np.uint64(1 << i)
    where[:, 0] = 0
    words, at = where.ravel(), right.T.astype(np.int64)[:, b] + a * 64
    v = np.full(len(a), -1, np.int64).view(np.uint64)
    for places in at:
        u = v & words.take(places)
        v = (v + u) | (v - u)
    return np.bitwise_count(~v & np.uint64((1 << 63) - 1)).astype(np.int64)


def _class_pairs(keyed: DataFrame, counts: list[tuple[str, int]], slack: float, tasks: int) -> DataFrame:
    """(l_name, name) of left and right names that share a key and take no more operations than a pair may.

    A task reads its keys in order and holds the names of one key at a time. Names that share a key are compared by their bits, block by
    block, and what these let through by the characters that stand side by side, then by the common subsequence. Rare characters share a code there, and names of
    more than 63 characters aren't compared further, so more pairs may come out, which their score decides on.
    """
    top = LEVELS[-1][0]
    ops = np.array([int(slack * n) for n in range(2 * LONG + 1)])
    ahead = np.array([min(top, int(slack * 2 * n / (1 - slack)) + 1) for n in range(LONG + 1)], np.uint8)
    frequent = [ord(char) for char, _ in counts[:63]]

    def met(rows: pa.Table, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, side, length, bits = (rows.column(k).to_numpy() for k in range(4))
        bits, name = bits.view(np.uint64), rows.column(4).combine_chunks()
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = [0]

        def near(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
            most = ops[length[a] + length[b]]
            keep = (most <= top) & (abs(length[a] - length[b]) <= most) & (np.bitwise_count(bits[a] ^ bits[b]) <= most)
            kept.append((a[keep], b[keep]))
            waiting[0] += len(kept[-1][0])
            if waiting[0] >= CHUNK:
                yield from close()

        def close() -> Iterator[pa.RecordBatch]:
            a, b = (np.concatenate([x[k] for x in kept]) for k in (0, 1))
            kept.clear()
            waiting[0] = 0
            order = np.argsort(length[b], kind="stable")
            for at in range(0, len(a), CHUNK):
                x, y = a[order[at : at + CHUNK]], b[order[at : at + CHUNK]]
                (ids, x_row), (others, y_row) = np.unique(x, return_inverse=True), np.unique(y, return_inverse=True)
                left, right = (_coded(name.take(pa.array(k)).to_pylist(), codes) for k in (ids, others))
                total, keep = length[x] + length[y], np.maximum(length[x], length[y]) > 63
                k = np.flatnonzero(~keep & (np.bitwise_count(_neighbours(left)[x_row] ^ _neighbours(right)[y_row]) <= 3 * ops[total]))
                keep[k] = total[k] - 2 * _common(left, right, x_row[k], y_row[k]) <= ops[total[k]]
                yield pa.RecordBatch.from_arrays([name.take(pa.array(k[keep])) for k in (x, y)], names=["l_name", "name"])

        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        rights = np.add.reduceat(side, starts)
        lefts = sizes - rights
        large = lefts * rights > LARGE
        # all small keys at once, each right name with the left ones of its key
        group = np.repeat(np.arange(len(starts)), sizes)
        asks = np.flatnonzero((side == 1) & ~large[group] & (lefts[group] > 0))
        n, first = lefts[group[asks]], starts[group[asks]]
        upto = np.cumsum(n)
        at = 0
        while at < len(asks):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCK, "right")))
            some, begin = n[at:to], upto[at:to] - n[at:to]
            left = np.arange(begin[0], upto[to - 1]) - np.repeat(begin - first[at:to], some)
            yield from near(left, np.repeat(asks[at:to], some))
            at = to
        for g in np.flatnonzero(large):
            cut, end = starts[g] + lefts[g], starts[g] + sizes[g]
            own, step = bits[starts[g] : cut], max(1, BLOCK // int(lefts[g]))
            for k in range(cut, end, step):
                b, a = np.divmod(np.flatnonzero(np.bitwise_count(own ^ bits[k : min(k + step, end), None]) <= ahead[length[k : min(k + step, end)], None]), lefts[g])
                yield from near(a + starts[g], b + k)
        if kept:
            yield from close()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        codes = (np.arange(0x110000) % 63 + 1).astype(np.uint8)
        codes[0], codes[frequent] = 0, np.arange(1, len(frequent) + 1)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            if held[0].column(0)[0].as_py() != batch.column(0)[-1].as_py():
                last = int(np.argmax(batch.column(0).to_numpy() == batch.column(0)[-1].as_py()))
                yield from met(pa.Table.from_batches([*held[:-1], batch.slice(0, last)]), codes)
                held = [batch.slice(last)]
        if held:
            yield from met(pa.Table.from_batches(held), codes)

    return keyed.repartition(tasks, "key").sortWithinPartitions("key", "side").mapInArrow(search, "l_name string, name string")


def pairs(left: DataFrame, right: DataFrame, limit: float = 0.85) -> DataFrame:
    """(core, r_core, score) of all distinct names with a score of ``limit`` or more; left(core), right(r_core).

    Names are core names, whose case and punctuation are gone; empty and null ones have no pair. What the parts bring together is held
    against the plain edit distance first, which is never above the number of operations, and only what passes is scored.
    """
    if not 0.5 <= limit <= 1:
        raise ValueError("the limit lies between 0.5 and 1")
    slack = _slack(limit)

    spark = left.sparkSession

    def names(df: DataFrame, core: str) -> DataFrame:
        named = df.select(F.col(core).alias("core")).where("core IS NOT NULL").distinct().withColumn("name", sorted_tokens(F.col("core")))
        return named.where("name <> ''")

    def spread(df: DataFrame) -> DataFrame:
        """The different names, dealt to tasks of about ``DEALT``: a short table makes many rows."""
        one = df.select("name").distinct().withColumn("len", F.length("name"))
        return one.repartition(tasks(df.count()), "name")

    def tasks(n: int) -> int:
        return max(spark.sparkContext.defaultParallelism, n // DEALT + 1)

    # written once: each side is read as the longer and as the shorter one, and callers read the pairs several times
    a, b = durable(names(left, "core"), "names"), durable(names(right, "r_core"), "names")
    one, other = spread(a), spread(b)
    most = F.floor(F.lit(slack) * (F.col("l_len") + F.col("len"))).cast("int")
    longest = max(df.agg(F.max(F.length("name"))).first()[0] or 0 for df in (a, b))

    # few operations
    chars = a.select("name").union(b.select("name")).select(F.explode(F.split("name", "")).alias("c")).where("c <> ''")
    counts = [(r.c, r.n) for r in chars.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c").limit(KNOWN).collect()]
    top = LEVELS[-1][0]
    keyed = _class_keys(one, counts, slack, True).union(_class_keys(other, counts, slack, False))
    found = _class_pairs(keyed, counts, slack, tasks(a.count() + b.count())).selectExpr("l_name AS a_name", "name AS b_name")

    # more operations, or names too long for classes: where the longest name may be one of such a pair
    if longest > LONG or int(2 * slack * longest) > top:
        parts = spark.createDataFrame(_parts(limit, LONG), "of int, i int, at int, size int, own int, before int, last int").where(F.floor(F.lit(2 * slack) * F.col("of")) > top)

        def met(longer: DataFrame, shorter: DataFrame, side: int) -> DataFrame:
            grown = F.col("len") * ((1 + slack) / (1 - slack)) + 1e-6
            longer = longer.where((F.col("len") > LONG) | (F.floor(F.lit(2 * slack) * F.col("len")) > top))
            shorter = shorter.where((grown > LONG) | (F.floor(F.lit(slack) * (F.col("len") + grown)) > top))
            x = _longer_keys(longer, parts, slack).withColumnRenamed("name", "l_name").withColumnRenamed("key", "l_key")
            both = x.join(_shorter_keys(shorter, parts, slack), F.col("l_key") == F.col("key"))
            both = both.withColumn("l_len", F.length("l_name")).withColumn("len", F.length("name"))
            both = both.where((F.col("l_len") >= F.col("len") + side) & (F.col("l_len") - F.col("len") <= most) & ((most > top) | (F.col("l_len") > LONG)))
            # the threshold of the built-in is a constant; the limit of the pair isn't
            return both.where(F.levenshtein("l_name", "name") <= most).select("l_name", "name")

        # the right names as the longer ones, or as long; then the left names as the longer ones
        found = found.union(met(other, one, 0).selectExpr("name AS a_name", "l_name AS b_name").union(met(one, other, 1)))
    found = found.distinct().join(a.select("core", F.col("name").alias("a_name")), "a_name").join(b.select(F.col("core").alias("r_core"), F.col("name").alias("b_name")), "b_name")
    # what is under the limit goes when the table is read: with a filter before that every pair would be scored twice
    return durable(found.select("core", "r_core").withColumn("score", N.name_score(F.col("core"), F.col("r_core"))), "name-pairs").where(F.col("score") >= limit)
