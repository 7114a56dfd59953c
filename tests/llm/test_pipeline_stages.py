"""Each stage of the pipeline on what the one before kept, held against plain Python: whole rows, not subsets."""

from collections import defaultdict

import corpus_pipeline
from listforge.session import durable

from . import brute
from .test_near_copies import similar

SF = "/root/testdata/sf0.001"


def key(line):
    return line.strip(brute.BLANKS).translate(brute.LOWER)


def after_quality(rows):
    """Kept documents without the lines that too many different texts of their host have."""
    verdict = {r[0]: r[7] for r in brute.quality([(i, t, s) for i, t, _, s, _ in rows])}
    texts, holders = defaultdict(set), defaultdict(set)
    for _, t, _, s, _ in rows:
        texts[s].add(t)
        for line in (t or "").split("\n"):
            if brute.WORD.search(line) and len(key(line)) >= 10:
                holders[s, key(line)].add(t)
    common = {k for k, v in holders.items() if len(v) > max(5, min(50, 0.05 * len(texts[k[0]])))}
    out = []
    for i, t, lang, s, _ in rows:
        if verdict[i]:
            left = "\n".join(x for x in t.split("\n") if (s, key(x)) not in common)
            out.append((i, left, lang, s, len(left)))
    return out


def after_lines(rows):
    first = {}
    for i, t, *_ in sorted(rows):
        for x in t.split("\n"):
            first.setdefault(key(x), i)
    out = []
    for i, t, lang, s, _ in rows:
        left = "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == i)
        out.append((i, left, lang, s, len(left)))
    return out


def after_near(rows):
    root = {r[0]: r[0] for r in rows}
    for i, j in sorted(similar(sorted((r[0], r[1]) for r in rows))):
        a, b = root[i], root[j]
        root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    return [r for r in rows if root[r[0]] == r[0]]


def plain(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [brute.WORD.findall(r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {"quality_rules": after_quality, "line_dedup": after_lines, "simhash_near_dedup": after_near}
    gone = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = plain(docs)
        docs = durable(stage(spark, docs, SF), name)
        after = plain(docs)
        gone[name] = len(before) - len(after)
        if name in want:
            assert sorted(after) == sorted(want[name](before)), name
        else:
            windows = {tuple(w[k : k + 8]) for w in items for k in range(len(w) - 7)}
            words = {r[0]: brute.WORD.findall(r[1].lower()) for r in before}
            shares = {i for i, w in words.items() if any(tuple(w[k : k + 8]) in windows for k in range(len(w) - 7))}
            holds = {i for i, w in words.items() if any(f" {' '.join(x)} " in f" {' '.join(w)} " for x in items)}
            assert set(after) <= set(before) and holds <= {r[0] for r in before} - {r[0] for r in after} <= shares
    assert gone["quality_rules"] and gone["simhash_near_dedup"] and gone["benchmark_decontamination"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r[0] for r in after} and all(r.offset + r.length <= 2048 for r in packed)
    by_sequence = defaultdict(list)
    for r in packed:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        assert all(a[0] + a[1] == b[0] for a, b in zip(sorted(parts), sorted(parts)[1:], strict=False)) and min(parts)[0] == 0
