"""The near-dedup stage of the pipeline against brute force over all pairs."""

import random

from listforge.llm import near_copies

from . import brute


def shingle_set(text):
    w = brute.WORD.findall((text or "").translate(brute.LOWER))
    return {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))}


def similar(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    return {(i, j) for k, (i, a) in enumerate(sets) for j, b in sets[k + 1 :] if len(a & b) >= 0.8 * len(a | b)}


def edited(words, rng, edits):
    out = list(words)
    for p in rng.sample(range(len(out)), edits):
        out[p] = f"edit{rng.randrange(10**6)}"
    return " ".join(out)


def test_edited_copies_go(spark):
    rng = random.Random(8)
    rows = [(0, None), (1, " \n"), (2, "one two"), (3, "One  TWO"), (4, "one three")]
    for g in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(220)]
        rows += [(10 + 10 * g + k, edited(base, rng, k)) for k in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    root = {i: i for i, _ in rows}
    for i, j in sorted(similar(rows)):  # ids ascend: a group's smallest id is kept
        a, b = root[i], root[j]
        root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    want = sorted({r for r in root.values()})
    assert len(want) < len(rows) - 50
    assert sorted(r.doc_id for r in near_copies.keep_one(df).collect()) == want
    for heads in (1, 4):
        assert sorted(r.doc_id for r in near_copies.keep_one(df, cell=2, heads=heads).collect()) == want


def test_crowded_cells_of_many_groups_lose_no_link(spark):
    """Texts that share half of their words, with chains of copies in between whose ends aren't similar."""
    rng = random.Random(5)
    shared = [f"s{rng.randrange(10**6)}" for _ in range(120)]
    rows, k = [], 0
    for g in range(6):
        words = shared + [f"g{g}x{rng.randrange(10**6)}" for _ in range(60)]
        for step in range(24):
            rows.append((k, " ".join(words)))
            k += 1
            at = 120 + rng.randrange(4) + 2 * step
            words = [*words[:at], f"new{rng.randrange(10**6)}", *words[at + 1 :]]
            for _ in range(2):
                words[rng.randrange(120)] = f"new{rng.randrange(10**6)}"
    pairs = similar(rows)
    root = {i: i for i, _ in rows}
    for i, j in sorted(pairs):
        a, b = root[i], root[j]
        root = {n: min(a, b) if r in (a, b) else r for n, r in root.items()}
    assert len(pairs) < len(rows) * 8 and len(set(root.values())) == 6
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for cell, heads in ((16, 4), (1, 1)):
        got = {r.doc_id: r.component_id for r in near_copies.groups(df, cell=cell, heads=heads).collect()}
        assert got == root


def test_fingerprints_and_odd_rows(spark):
    import numpy as np

    sets = np.random.default_rng(2).integers(0, 2**63, 40).astype(np.uint64)
    offsets = np.array([0, 1, 18, 40])
    want = [sum(1 << b for b in range(64) if 2 * sum(int(x) >> b & 1 for x in sets[a:z]) > z - a) for a, z in zip(offsets[:-1], offsets[1:], strict=True)]
    assert near_copies.fingerprints(sets, offsets).tolist() == want
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows = [(1, " ".join(base)), (1, "another text of the same id and of some words"), (2, " ".join(base)), (None, " ".join(base)), (None, None), (3, edited(base, rng, 1)), (4, " ".join(f"z{k}" for k in range(30_000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS sh", "'x' AS fp", "2 AS u", "3 AS component", "4 AS bands")
    kept = near_copies.keep_one(df)
    assert kept.columns == df.columns and sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 1, 4, None, None], key=str)
    assert near_copies.keep_one(df.where("false")).count() == 0
