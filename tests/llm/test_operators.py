"""Each operator against its brute-force version, on a table slice and on hard cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from listforge.llm import decontaminate, hilbert, line_dedup, packing, quality_model, quality_rules, recompression, rollups, simhash, suffix_dedup
from listforge.llm.components import components

from . import brute

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def hard_cases() -> list[tuple]:
    rng = random.Random(5)
    w = lambda n, seed: " ".join(random.Random(seed).choice("abcdefghij") * 2 + str(random.Random(seed * 1000 + k).randrange(50)) for k in range(n))
    passage = w(40, 1)
    texts = ["", None, " \t\n", "one", "a b", "x " * 300, "A b C\nA b C\na B c longer line here\n", "é" * 150, "y" * 450, "xy" * 260]
    texts += [w(60, 100 + k) + "\n" + passage + "\n" + w(30, 200 + k) for k in range(6)]
    texts += [w(80, 7)] * 5 + [w(79, 7) + " changed", w(8000, 3), "Same Line Of Text\nsame line of text  \nother"] * 2
    texts += ["".join(rng.choice("gh ") for _ in range(150)) + passage for _ in range(8)]
    return [(k, t, None if k % 11 == 0 else "en", None if k % 7 == 0 else f"s{k % 3}", len(t or "")) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    hard = hard_cases()
    clash = [F.lit(k).alias(n) for k, n in enumerate(("key", "h", "n", "n_words", "n_lines", "count", "rank", "shard", "kept", "curve"))]
    return {
        "real": (spark.createDataFrame(rows, SCHEMA), rows),
        "hard": (spark.createDataFrame(hard, SCHEMA).select("*", *clash).repartition(3), hard),
        "empty": (spark.createDataFrame([], SCHEMA), []),
    }


def triples(rows):
    return [(r[0], r[1], r[3]) for r in rows]


def got(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


CASES = [
    ("op2", suffix_dedup.op2, brute.suffix, ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")),
    ("op3", recompression.op3, brute.windows, ("doc_id", "n_words", "n_removed", "kept_sha256")),
    ("op6", line_dedup.op6, brute.lines, ("doc_id", "n_lines", "n_dropped", "kept_sha256")),
    ("op7", simhash.op7, brute.simhash, ("doc_id", "fingerprint", "component_id")),
    ("op9", quality_rules.op9, brute.quality, ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_boiler")),
]


@pytest.mark.parametrize("which", ["real", "hard", "empty"])
@pytest.mark.parametrize("name,op,plain,cols", CASES, ids=[c[0] for c in CASES])
def test_against_brute_force(spark, tables, which, name, op, plain, cols):
    df, rows = tables[which]
    assert got(op(spark, df), *cols) == sorted(plain(triples(rows)), key=str)


def test_hot_keys_and_small_shards_give_the_same(spark, tables):
    df, rows = tables["hard"]
    a = suffix_dedup.dedup(df, hot=2, shard=600).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("s"))
    assert got(a, *a.columns) == sorted(brute.suffix(triples(rows)), key=str)
    b = recompression.dedup(df, hot=2).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("s"))
    assert got(b, *b.columns) == sorted(brute.windows(triples(rows)), key=str)


def test_line_runs_compact(spark, tables):
    df, rows = tables["real"]
    one = got(line_dedup.dedup_lines(df, batches=1), "doc_id", "text")
    assert one == got(line_dedup.dedup_lines(df, batches=7, fanout=3), "doc_id", "text")
    runs = line_dedup.LineRuns(spark, fanout=2)
    for k in range(5):
        runs.add(spark.createDataFrame([(k, k, k)], line_dedup.RUN_SCHEMA))
    assert [len(x) for x in runs.levels] == [1, 0, 1] and runs.all().count() == 5


def test_crowded_cells_link_alike(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(20)]
    fps = {s ^ sum({1 << rng.randrange(64) for _ in range(rng.randrange(4))}) for s in seeds for _ in range(30)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    plain = {}
    todo = set(x[0] for x in signed)
    while todo:
        stack, comp = [todo.pop()], []
        while stack:
            x = stack.pop()
            comp.append(x)
            near = {y for y in todo if ((x ^ y) & (2**64 - 1)).bit_count() <= 2}
            todo -= near
            stack += near
        if len(comp) > 1:
            plain |= dict.fromkeys(comp, min(comp))
    for cell in (64, 3):
        assert dict(map(tuple, components(simhash.near_links(df, cell=cell)).collect())) == plain


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (7, 7)], "u long, v long")
    out = dict(map(tuple, components(edges).collect()))
    assert set(out.values()) == {0, 500} and len(out) == 203
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_hilbert_curve_steps_to_neighbours(spark):
    side = 1 << hilbert.BITS
    cube = spark.range(side**3).select((F.col("id") % side).cast("int").alias("x"), (F.floor(F.col("id") / side) % side).cast("int").alias("y"), F.floor(F.col("id") / side**2).cast("int").alias("z"))
    rows = sorted(map(tuple, cube.select(hilbert.curve_index([F.col("x"), F.col("y"), F.col("z")]), "x", "y", "z").collect()))
    assert [r[0] for r in rows] == list(range(side**3))
    at = np.array(rows)[:, 1:]
    assert (np.abs(np.diff(at, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("which", ["real", "hard", "empty"])
def test_shards(spark, tables, which):
    df, rows = tables[which]
    out = hilbert.op8(spark, df).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in out) == sorted((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    if rows:
        n = [len(slots.get(s, [])) for s in range(24)]
        assert max(n) - min(n) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    by_bytes = hilbert.shard_rows(hilbert.metadata(df), 4, "bytes").groupBy("shard").agg(F.sum("size").alias("b")).collect()
    if which == "real":
        total, largest = sum(r.b for r in by_bytes), max(len((r[1] or "").encode()) + 8 for r in rows)
        assert all(abs(r.b - total / 4) <= largest for r in by_bytes)


def test_shards_with_null_and_repeated_ids(spark):
    rows = [(None, f"t{k % 3}", None, "s", 2) for k in range(30)] + [(5, "same", None, None, 4)] * 30
    out = hilbert.op8(spark, spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 60 and len({(r.shard, r.slot) for r in out}) == 60


@pytest.mark.parametrize("which", ["real", "hard", "empty"])
def test_packing(spark, tables, which):
    from tokenizers import Tokenizer

    df, rows = tables[which]
    tok = Tokenizer.from_file(packing.default_path())
    want = {}
    for r in rows:
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            want[r[0], k] = (a, len(ids[a : a + 2048]), zlib.crc32(np.array(ids[a : a + 2048], "<u4").tobytes()))
    out = packing.op4(spark, df).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in out} == want and len(out) == len(want)
    seqs = {}
    for r in out:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        ends = np.cumsum([n for _, n in sorted(s)])
        assert [o for o, _ in sorted(s)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(seqs) <= 1.03 * sum(v[1] for v in want.values()) / 2048 + 1


def test_tokens_of_odd_words_match_the_tokenizer():
    from listforge.llm.tokens import WordIds
    from tokenizers import Tokenizer

    tok, ids = Tokenizer.from_file(packing.default_path()), WordIds(packing.default_path())
    for text in ["It's x's, a.,b I'LL don't. END.", "<|endoftext|> <|ENDOFTEXT|> a<|startoftext|>b", "Éa Éa  x y \x1cz", "12,345.67 $5 #a.b. ... ,", "İstanbul ΣΑΣ ß"]:
        assert np.frombuffer(ids.text(text.encode()), "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids


def test_decontamination(spark, tables):
    df, rows = tables["real"]
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    want = {(r[0], i) for r in rows for i, t in items if t in (r[1] or "")}
    mine = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    assert want and want == mine
    assert decontaminate.drop_contaminated(df, bench).count() == len(rows) - len({d for d, _ in want})


def test_reparameterised_questions(spark):
    q = "A train with Alice on board leaves at 9 and travels 240 km before it stops for 15 minutes while Alice waits, then how far does it travel in 3 hours?"
    docs = [
        (1, "Intro. " + q.replace("Alice", "Robert").replace("240 km", "310 miles").replace("15", "25") + " The end."),
        (2, "Intro. " + q.replace("on board leaves with Alice", "x").replace("while Alice", "while Robert")),  # one name, two values
        (3, "Quite another text about trains that leave at some time and travel far before they stop for a while and then go on again."),
        (4, q.upper()), (5, None), (6, ""), (None, q), (7, q), (7, q),
    ]
    pairs = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, q), (2, None), (3, "too short")], "item_id long, text string"))
    found = {r.doc_id: r.item_id for r in pairs.collect()}
    assert {1, 7, None} <= set(found) and not {2, 3, 5, 6} & set(found)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), none).count() == 0


def test_classifier(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = quality_model.score(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").where("held_out").select("score", "quality").collect()
    s, y = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])
    assert auc > 0.85
    assert {r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out.collect()} == {True}


def test_classifier_without_labels(spark, tables):
    df, rows = tables["hard"]
    for labels in ([], [(k, 1, 0) for k in range(30)], [(k, None, None) for k in range(30)]):
        out = quality_model.score(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
        assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)


def test_rollups(spark):
    state = rollups.Rollup(spark)
    shape = "doc_id long, tokenizer string, op string, source string, lang string, n_tokens long"
    put = lambda b, rows: state.apply(b, spark.createDataFrame(rows, shape))
    totals = lambda: {tuple(r)[:3]: tuple(r)[3:] for r in state.totals().collect()}
    assert put("1", [(1, "t", "insert", "a", None, 5), (2, "t", "insert", "a", None, 7), (2, "t", "insert", "a", None, 7), (None, "t", "insert", "a", None, 9)])
    assert totals() == {("a", None, "t"): (2, 12)}
    assert not put("1", [(3, "t", "insert", "a", None, 5)]) and totals() == {("a", None, "t"): (2, 12)}
    assert put("2", [(1, "t", "revise", "b", "en", 4), (2, "t", "delete", None, None, None), (9, "t", "delete", None, None, None)])
    assert totals() == {("b", "en", "t"): (1, 4)}
    assert put("3", [(2, "t", "insert", "a", None, 1), (1, "u", "insert", "b", "en", 8)])
    assert totals() == {("b", "en", "t"): (1, 4), ("a", None, "t"): (1, 1), ("b", "en", "u"): (1, 8)}
    with pytest.raises(ValueError):
        put("0", [])


def test_rollup_query(spark, tables):
    from tokenizers import Tokenizer

    for which in ("real", "hard", "empty"):
        df, rows = tables[which]
        tok, first, want = Tokenizer.from_file(packing.default_path()), {}, {}
        for r in rows:
            first.setdefault(r[1] or "", r[0])
        for i, t, lang, source, _ in rows:
            if first[t or ""] == i:
                for name, n in (("words-1", len(brute.WORD.findall(t or ""))), ("word_bpe_49k-1", len(tok.encode(t or "", add_special_tokens=False).ids))):
                    a, b = want.get((source, lang, name), (0, 0))
                    want[source, lang, name] = (a + 1, b + n)
        assert {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollups.op10(spark, df).collect()} == want


def test_pipeline(spark):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {q[0] for q in brute.quality(rows) if q[7]}
    rows = [r for r in rows if r[0] in kept]
    first = {}
    key = lambda x: x.strip(brute.BLANKS).translate(brute.LOWER)
    for i, t, _ in sorted(rows):
        for x in t.split("\n"):
            first.setdefault(key(x), i)
    rows = [(i, "\n".join(x for x in t.split("\n") if len(key(x)) < 10 or first[key(x)] == i), s) for i, t, s in rows]
    near = {c[2] for c in brute.simhash(rows)}
    rows = [r for r in rows if r[0] in near]
    held = {r[0] for r in rows if any(t in r[1] for t in items)}
    out = {r.doc_id for r in cp.run(spark, SF).collect()}
    assert out <= {r[0] for r in rows} - held
    lost = {r[0] for r in rows} - held - out  # an item may have lost lines and still be one
    assert len(lost) <= 0.02 * len(rows)


def test_rows_of_one_id_lose_their_own_repeats(spark):
    """Texts of one doc_id stay apart: what stands once is not lost with what another text of that id repeats."""
    rng = random.Random(12)
    unique = lambda n: " ".join(f"u{rng.getrandbits(40):x}" for _ in range(n))
    long, mine = unique(60), unique(90)
    rows = [(1, long, "s"), (2, long, "s"), (2, mine, "s"), (2, mine + " " + long[:300], "s"), (3, unique(20) + " " + long + " " + unique(20), "s"), (None, long, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    shown = [r for r in rows if r[0] is not None]
    for hot in (2000, 1):
        seen = suffix_dedup.dedup(df, hot=hot).select("doc_id", "n_bytes", "n_removed", F.sha2("kept", 256).alias("s")).where("doc_id IS NOT NULL")
        every = [t.encode() for _, t, _ in shown]
        count = {}
        for t in every:
            for p in range(len(t) - 199):
                count[t[p : p + 200]] = count.get(t[p : p + 200], 0) + 1
        want = []
        for (i, _, _), t in zip(shown, every, strict=True):
            gone = set()
            for p in range(len(t) - 199):
                if count[t[p : p + 200]] > 1:
                    gone.update(range(p, p + 200))
            want.append((i, len(t), len(gone), brute.sha(bytes(b for p, b in enumerate(t) if p not in gone))))
        assert got(seen, *seen.columns) == sorted(want, key=str)
        kept = recompression.dedup(df, hot=hot).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("s")).where("doc_id IS NOT NULL")
        first, want = {}, []
        words = [t.split() for _, t, _ in shown]
        for (i, _, _), w in zip(shown, words, strict=True):
            for k in range(len(w) - 12):
                first[tuple(w[k : k + 13])] = min(i, first.get(tuple(w[k : k + 13]), i))
        for (i, _, _), w in zip(shown, words, strict=True):
            gone = {p for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for p in range(k, k + 13)}
            want.append((i, len(w), len(gone), brute.sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
        assert got(kept, *kept.columns) == sorted(want, key=str)


def test_recompression_rounds(spark, tables):
    """Symbols of all levels resolve copies and long passages; with any choice of levels the result is the same."""
    df, rows = tables["hard"]
    want = sorted(brute.windows(triples(rows)), key=str)
    for levels in ((), (2, 4), (6,), recompression.LEVELS):
        spans = recompression.removed_spans(df, levels=levels)
        assert spans.count() > 0
    rng = random.Random(3)
    passage = [f"p{rng.randrange(10**6)}" for _ in range(900)]
    noise = lambda n: [f"n{rng.randrange(10**9)}" for _ in range(n)]
    docs = [(k, " ".join(noise(40) + passage + noise(30)), "s") for k in range(5)] + [(9, " ".join(passage), "s"), (8, " ".join(passage), "s")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string")
    found = {}
    for r in recompression.shared_symbols(recompression.keyed(d)).collect():
        found.setdefault(r.doc_id, []).append((r.span >> 24, r.span & (1 << 24) - 1))
    assert 0 not in found and found[9] == [(0, 900)] and all(sum(n for _, n in found[k]) > 300 for k in (1, 2, 3, 4, 8))
    out = recompression.dedup(d).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("s"))
    assert got(out, *out.columns) == sorted(brute.windows(docs), key=str) and want


def test_repeated_rows_with_other_texts(spark):
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(1, long, "s"), (2, "short text", "s"), (2, long + " and more than that", "s"), (2, long + " and more than that", "s"), (None, long, None), (3, "x\ny", None), (3, "same old line here\ny", "s"), (4, "same old line here", "s"), (0, "z\nsame old line here", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for hot in (2000, 1):
        out = recompression.dedup(df, hot=hot).where("doc_id = 2").select("n_words", "n_removed").collect()
        assert sorted(map(tuple, out)) == [(2, 0), (64, 60), (64, 60)]
    lines = sorted(tuple(r) for r in line_dedup.dedup_lines(df.where("doc_id IN (0, 3, 4)")).select("doc_id", "text").collect())
    assert lines == [(0, "z\nsame old line here"), (3, "x\ny"), (3, "y"), (4, "")]
    for op in (simhash.op7, quality_rules.op9, packing.op4):
        assert op(spark, df).count() == len(rows)


def test_shards_of_wide_and_outlying_ids(spark):
    lo, hi = -(1 << 63), (1 << 63) - 1
    for ids in ([0, 5, 1 << 60], [lo, -1, 0, hi], [*range(400), 1 << 62], [None, lo, hi] + [7] * 40):
        rows = [(i, f"text {k % 5}", None, None if k % 4 == 0 else "s", 0) for k, i in enumerate(ids)]
        for law in ("rows", "bytes"):
            out = hilbert.shard_rows(hilbert.metadata(spark.createDataFrame(rows, SCHEMA).repartition(3)), 4, law).collect()
            slots = {}
            for r in out:
                slots.setdefault(r.shard, []).append(r.slot)
            assert sorted((str(r.doc_id) for r in out)) == sorted(map(str, ids)) and all(sorted(v) == list(range(len(v))) for v in slots.values())
            if law == "rows":
                assert max(map(len, slots.values())) - min(len(slots.get(s, [])) for s in range(4)) <= 1


def test_shard_bounds_prune_and_whole_rows_are_written(spark, tmp_path):
    rng = random.Random(9)
    rows = [(rng.getrandbits(40), "x" * int(2 ** rng.uniform(0, 12)), "en", f"h{rng.randrange(40):02d}", k) for k in range(4000)] + [(None, None, None, None, -1)] * 3 + [(1, "same", "a", "h00", -2), (1, "same", "b", "h00", -3)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("slot", F.lit("clash"))
    bounds = hilbert.shard_bounds(hilbert.shard_rows(hilbert.metadata(df), 64)).collect()
    cut = sorted(r[0] for r in rows if r[0] is not None)[200]
    hit = {"id": sum(b.min_doc_id is None or b.min_doc_id <= cut for b in bounds), "host": sum(b.min_source is None or b.min_source <= "h02" for b in bounds), "size": sum(b.max_size >= 3000 for b in bounds)}
    assert len(bounds) == 64 and all(n <= 32 for n in hit.values()), hit
    hilbert.write_shards(df, str(tmp_path / "shards"), 8)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.drop("shard").columns == df.columns
    plain = lambda d: sorted(map(str, d.collect()))
    assert plain(back.drop("shard")) == plain(df)
    counts = [r[1] for r in back.groupBy("shard").count().collect()]
    assert len(counts) == 8 and max(counts) - min(counts) <= 1


def test_rollup_batches_that_died(spark):
    """A batch without its marker isn't there; run again it counts once. Small batches touch their own buckets only."""
    state = rollups.Rollup(spark, buckets=8)
    shape = "doc_id long, tokenizer string, op string, source string, lang string, n_tokens long"
    put = lambda b, rows: state.apply(b, spark.createDataFrame(rows, shape))
    totals = lambda: {tuple(r)[:3]: tuple(r)[3:] for r in state.totals().collect()}
    assert totals() == {}
    put("1", [(k, "t", "insert", "a", None, 10) for k in range(40)])
    fs, make = state._fs()
    put("2", [(k, "t", "revise", "b", None, 3) for k in range(5)] + [(7, "t", "delete", None, None, None)])
    after = {("a", None, "t"): (34, 340), ("b", None, "t"): (5, 15)}
    assert totals() == after
    fs.delete(make(f"{state.path}/2/delta/_SUCCESS"), False)
    assert totals() == {("a", None, "t"): (40, 400)}
    put("2", [(k, "t", "revise", "b", None, 3) for k in range(5)] + [(7, "t", "delete", None, None, None)])
    assert totals() == after and state.entries().count() == 39
    put("3", [(3, "t", "revise", "b", None, 4)])
    assert len([n for n in state._names(f"{state.path}/3/current") if n.startswith("bucket=")]) == 1
    put("4", [])
    assert totals() == {("a", None, "t"): (34, 340), ("b", None, "t"): (5, 16)} and state.entries().count() == 39


def test_classifier_ignores_labels_of_no_document(spark):
    docs = spark.createDataFrame([(k, ("good clear prose " if k % 2 else "zz qq junk ") * 20) for k in range(120)], "doc_id long, text string").withColumns({"y": F.lit(1), "h": F.lit("x"), "x": F.lit(0)})
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(120)] + [(10**6 + k, 1 - k % 2, 0) for k in range(3000)], "doc_id long, quality int, toxic int").withColumn("score", F.lit(0))
    features = quality_model.pooled(docs, quality_model.unit_vectors(quality_model.context_sums(docs)))
    model = quality_model.train(features, labels, rows=60)
    assert isinstance(model, quality_model.Network)
    x = np.array([r.x for r in features.orderBy("doc_id").collect()], dtype=np.float64)
    right = (model.score(x) >= 0.5) == (np.arange(120) % 2 == 1)
    assert right.mean() == 1.0


def test_pooled_features_are_those_of_plain_sums(spark):
    """Random indexing and pooling against a loop over words."""
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefg") * 3 for _ in range(rng.randrange(0, 30))) for _ in range(25)] + ["", None, "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    index, sums = quality_model.index_vectors(), np.zeros((quality_model.BUCKETS, quality_model.DIMS))
    bucket = {}
    for t in texts:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        b, _ = quality_model.buckets_of(raw, np.array([0, len(raw)]))
        bucket[t] = b
        for i in range(len(b)):
            for j in range(max(0, i - quality_model.REACH), min(len(b), i + quality_model.REACH + 1)):
                if i != j:
                    sums[b[i]] += index[b[j]]
    assert np.allclose(quality_model.context_sums(df), sums, atol=1e-3)
    unit = quality_model.unit_vectors(sums)
    for r in quality_model.pooled(df, unit).collect():
        v = unit[bucket[texts[r.doc_id]]]
        want = np.concatenate([v.mean(0), v.std(0), [np.log1p(len(v)) / 8]]) if len(v) else np.zeros(quality_model.FEATURES)
        assert np.allclose(r.x, want, atol=1e-3)


def test_sorted_runs_are_not_dealt_again(spark, tables):
    """Anti-joins and merges shuffle the batch's keys alone, and leave no table behind."""
    df, _ = tables["real"]
    before = {t.name for t in spark.catalog.listTables()}
    runs = line_dedup.LineRuns(spark)
    lines = line_dedup.line_keys(df, 10)
    runs.add_batch(lines.where("doc_id < 100"))
    name = runs.runs()[0]
    keys = lines.where("doc_id >= 100").groupBy("k1", "k2").agg(F.min("doc_id").alias("first_doc"))
    plan = keys.join(spark.table(name).hint("merge"), ["k1", "k2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and f"SelectedBucketsCount: {runs.buckets} out of {runs.buckets}" in plan
    merged = line_dedup.LineRuns.merge(spark.table(name), spark.table(name))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in merged
    runs.close(files=True)
    assert line_dedup.dedup_lines(df).count() == df.count()
    assert {t.name for t in spark.catalog.listTables()} == before
