"""Names by the classes of their characters: every pair, and few keys."""

import random

import numpy as np
import pytest

from listforge.functions import names as N
from listforge.operators import fuzzy as FZ

SYLLABLES = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "ez", "日", "é"]


def made(rng, n, sizes=(2, 2, 3)):
    return sorted({" ".join(sorted("".join(rng.choice(SYLLABLES) for _ in range(rng.choice(sizes))) for _ in range(rng.choice([1, 2, 3])))) for _ in range(n)})


def spoilt(rng, name):
    k = rng.randrange(len(name))
    return rng.choice([name[:k] + name[k + 1 :], name[:k] + rng.choice("etz\0") + name[k:], name[:k] + name[k : k + 2][::-1] + name[k + 2 :]])


def generated(df):
    """Rows that the generators of a collected frame gave."""

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        own = node.metrics().get("numOutputRows").get().value() if node.nodeName() == "Generate" else 0
        return own + sum(walk(node.children().apply(k)) for k in range(node.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.mark.parametrize("limit,large,long", [(0.85, 0, False), (0.85, 4096, False), (0.95, 30, True)])
def test_every_pair_by_classes(spark, monkeypatch, limit, large, long):
    monkeypatch.setattr(FZ, "LARGE", large)
    monkeypatch.setattr(FZ, "BLOCK", 7)
    monkeypatch.setattr(FZ, "CHUNK", 5)
    rng = random.Random(8)
    names = made(rng, 90, (12, 9, 20)) if long else made(rng, 150)  # long: some have more than a word's 63 characters
    right = sorted({spoilt(rng, n) for n in names + names} | {n[: len(n) * 3 // 4] for n in names} | {"zz" * 40, "\0", "e"})
    tidy = lambda s: " ".join(sorted(s.split()))
    want = {}
    for a in names:
        for b in right:
            x, y = tidy(a), tidy(b)
            score = round(2 * N._lcs(x, y) / (len(x) + len(y)) + 1e-12, 4)
            if b.strip() and score >= limit:
                want[a, b] = score
    got = FZ.pairs(spark.createDataFrame([(n,) for n in names], "core string"), spark.createDataFrame([(n,) for n in right], "r_core string"), limit).collect()
    assert {(r.core, r.r_core): r.score for r in got} == want and len(want) > 100 and len(got) == len(want)


def test_names_have_few_keys(spark, monkeypatch):
    monkeypatch.setattr(FZ, "durable", lambda df, tag="": df)
    names = made(random.Random(2), 600, (3, 4, 3))
    df = spark.createDataFrame([(n,) for n in names], "core string")
    pairs = FZ.pairs(df, df.withColumnRenamed("core", "r_core"))
    assert len(pairs.collect()) >= len(names)
    assert generated(pairs) < 2 * 80 * len(names)  # both sides; 175 a name by parts alone


def test_common_subsequences_of_many_names():
    rng = random.Random(3)
    words = ["".join(rng.choice("abcd é日\0") for _ in range(rng.randint(1, 63))) for _ in range(300)]
    codes = (np.arange(0x110000) % 63 + 1).astype(np.uint8)
    codes[0], codes[[ord(c) for c in "abcd é日"]] = 0, np.arange(1, 8)
    a, b = np.arange(300), np.array([rng.randrange(300) for _ in range(300)])
    coded = FZ._coded(words, codes)
    same = lambda s: s.replace("\0", "a")  # noqa: E731  it has the code of the first character
    assert list(FZ._common(coded, coded, a, b)) == [N._lcs(same(words[x]), same(words[y])) for x, y in zip(a, b, strict=True)]
