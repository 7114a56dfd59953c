"""Record linkage against plain Python on small fixtures."""

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from listforge.functions import names as N
from listforge.operators import enrich as E
from listforge.operators import fuzzy as FZ
from listforge.operators import monitor as MO
from listforge.operators import notices as G
from listforge.operators import quality as Q
from listforge.operators import removals as R


def score(a, b):
    if not a or not b:
        return 0.0
    x, y = (" ".join(sorted(s.split())) for s in (a, b))
    return 1.0 if a == b else round(2 * N._lcs(x, y) / (len(x) + len(y)) + 1e-12, 4)


SUBJ = [
    (1, "L1", True, None, "FR", "gulf petro trading"), (2, "L1", False, "R1", "FR", "x y"), (3, None, False, "R2", "FR", "other name"), (4, None, False, None, "FR", "gulf petroleum trading"), (5, None, False, None, None, "gulf petroleum trading"),
    (6, None, False, None, "DE", "nothing like it"), (7, None, False, None, "US", ""), (8, None, False, None, "FR", "alpha shipping lines"),
    (9, None, False, None, "FR", "alpha shipping line"), (10, None, False, None, "FR", "petrobank"), (11, None, False, None, "FR", "acme tradng"),
]
REG = [("L1", "R9", "FR", "gulf petroleum trading"), ("L2", "R1", "FR", "a b"), ("L3", "R2", "FR", "c d"), ("L4", "R2", "FR", "e f"), ("L5", "", "IR", "alpha shipping line"), ("L6", "", None, "other names"), ("L7", "", "FR", "petrobnk"), ("L8", "", "FR", "acmee trading")]


def test_legal_entities(spark):
    s = spark.createDataFrame(SUBJ, "subject_id int, lei string, lei_valid boolean, reg_norm string, country string, core string")
    r = spark.createDataFrame(REG, "lei string, reg_norm string, country string, core string")
    got = {x.subject_id: (x.match_method, x.score, x.status, x.provider_key) for x in E.legal_entities(s, r).collect()}
    assert got[1] == ("LEI", 1.0, "AUTO_ACCEPTED", "L1") and got[2] == ("REGISTRATION_NUMBER", 1.0, "AUTO_ACCEPTED", "L2")
    assert got[4] == got[5] == ("NAME_COUNTRY", 1.0, "AUTO_ACCEPTED", "L1")
    assert got[7] == ("NAME_COUNTRY", 0.0, "NO_MATCH", None)
    for k, _, _, _, country, core in SUBJ:
        if got[k][0] == "NAME_COUNTRY":
            home = max([score(core, c) for _, _, rc, c in REG if country is None or country == rc], default=0.0)
            away = max([max(0.0, round(score(core, c) - 0.15, 4)) for _, _, rc, c in REG if rc != country], default=0.0) if home < 0.85 and country else 0.0
            assert got[k][1] == (max(home, away) if max(home, away) >= 0.85 else 0.0), k
    assert got[8] == ("NAME_COUNTRY", 0.0, "NO_MATCH", None)  # alike, but in another country
    assert got[9] == ("NAME_COUNTRY", 0.85, "NEEDS_REVIEW", "L5") and got[10][2:] == ("NEEDS_REVIEW", "L7") and got[11][2:] == ("NEEDS_REVIEW", "L8")


def test_companies(spark):
    rng = random.Random(2)
    words = [f"word{k}" for k in range(12)]
    name = lambda: " ".join(rng.sample(words, 3))
    reg = [(f"{k:07d}", name()) for k in range(40)]
    subj = [(k, rng.choice([None, "GB", "FR"]), f"{rng.randrange(80):07d}" if k % 3 == 0 else "12", rng.choice(reg)[1].replace("word1", "wrd1", 1) if k % 2 else name()) for k in range(60)] + [(99, "GB", None, None)]
    got = {x.subject_id: x for x in E.companies(spark.createDataFrame(subj, "subject_id int, country string, reg_norm string, core string"), spark.createDataFrame(reg, "number string, core string")).collect()}
    assert set(got) == {k for k, c, _, _ in subj if c != "FR"}
    for k, c, no, core in subj:
        if c == "FR":
            continue
        if no in {n for n, _ in reg} and 6 <= len(no) <= 8:
            assert (got[k].match_method, got[k].provider_key, got[k].status) == ("REGISTRATION_NUMBER", no, "AUTO_ACCEPTED")
            continue
        best = max([score(core, rc) for _, rc in reg], default=0.0)
        assert got[k].match_method == "NAME" and got[k].score == (best if best >= 0.85 else 0.0)
        if got[k].status != "NO_MATCH":
            assert got[k].provider_key == min(n for n, rc in reg if score(core, rc) == got[k].score)


LETTERS = "aeionrstlkmdx"


def spoilt(rng, name, times):
    out = list(name)
    for _ in range(times):
        at, what = rng.randrange(len(out) + 1), rng.random()
        if what < 0.4 and len(out) > 1:
            out.pop(min(at, len(out) - 1))
        elif what < 0.8:
            out.insert(at, rng.choice(LETTERS))
        elif at < len(out):
            out[at] = rng.choice(LETTERS)
    return " ".join("".join(out).split())


@pytest.mark.parametrize("limit,long", [(0.85, 128), (0.85, 12), (0.7, 128), (1.0, 128)])
def test_every_pair_above_the_limit_is_found(spark, monkeypatch, limit, long):
    monkeypatch.setattr(FZ, "LONG", long)  # with 12 most names are looked up by the segments alone
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(LETTERS) for _ in range(rng.randint(2, 9)))
    base = [" ".join(word() for _ in range(rng.choice([1, 1, 2, 2, 3]))) for _ in range(120)] + [" ".join(word() for _ in range(24)) for _ in range(3)]
    left = [spoilt(rng, b, rng.randint(0, max(1, len(b) // 4))) for b in base for _ in range(2)] + ["", None, "é ü", "petrobank", "acme tradng", "rosneftt trading", "petrobank"]
    right = base + [spoilt(rng, b, 1) for b in base] + ["", None, "ü é", "petrobnk", "acmee trading", "rosneft tradng"]
    df = lambda names, c: spark.createDataFrame([(n, 1) for n in names], f"{c} string, len int").withColumn("seg", F.lit("x"))
    got = {(r.core, r.r_core): r.score for r in FZ.pairs(df(left, "core"), df(right, "r_core"), limit).collect()}
    want = {(a, b): score(a, b) for a in set(left) for b in set(right) if score(a, b) >= limit}
    assert got == want and len(want) > 20


def test_no_names_no_pairs(spark):
    none = spark.createDataFrame([], "core string")
    assert FZ.pairs(none, none.withColumnRenamed("core", "r_core")).collect() == []


def test_hits_without_pairs(spark):
    rng = random.Random(4)
    rows = sorted({("S", k, "PASSPORT", f"p{rng.randrange(9)}") for k in range(40) for _ in range(rng.randrange(5))} | {("T", 7, "LEI", f"p{k}") for k in range(12)} | {("S", k, "LEI", f"p{k % 12}") for k in range(60, 90)} | {("S", 500, "LEI", "alone")})
    keys = spark.createDataFrame(rows, "source_id string, source_key int, key_type string, key_value string")
    held = {}
    for s, k, t, v in rows:
        held.setdefault((s, k), set()).add((t, v))
    cands = [x for i, x in enumerate(held) if i % 2 == 0 or x in (("T", 7), ("S", 500))]
    df = spark.createDataFrame(cands, "source_id string, source_key int")
    want = {c: sum(bool(held[c] & held[o]) for o in held if o != c) for c in cands}
    for most in (8, 2, 1):
        got = {(r.source_id, r.source_key): r.n_hits for r in R.crosslist_hits(df, keys, ["source_id", "source_key"], most).collect()}
        assert got == {c: n for c, n in want.items() if n}
    lists = {(r.source_id, r.source_key): r.sources for r in R.listed_elsewhere(df, keys).collect()}
    assert lists == {c: sorted({o[0] for o in held if o != c and held[c] & held[o]}) for c, n in want.items() if n}


def test_names_stand_in_texts(spark):
    rng = random.Random(6)
    texts = [(k, " ".join(rng.choice("abcde") * 2 for _ in range(30))) for k in range(30)] + [(90, "aa"), (91, ""), (92, None)]
    names = [(k, " ".join(rng.choice("abcde") * 2 for _ in range(rng.choice([1, 2, 3, 4])))) for k in range(40)] + [(90, "zz yy xx"), (91, ""), (92, None)]
    t, n = spark.createDataFrame(texts + [(93, "x " * 50_000 + "aa bb cc")], "notice_id int, norm string"), spark.createDataFrame(names + [(93, "aa bb cc"), (94, "bb cc"), (95, "aa bb cc")], "name_id int, name string")
    want = {(r.notice_id, s.name_id) for r, s in product(t.collect(), n.collect()) if r.norm and s.name and len(s.name) >= 6 and " " in s.name and f" {s.name} " in f" {r.norm} "}
    for chars in (4 << 20, 60):
        got = [tuple(r) for r in G.names_in_texts(t, n, shard_chars=chars).collect()]
        assert set(got) == want and len(got) == len(want) and {(93, 93), (93, 95)} <= want
    assert G.names_in_texts(t, n.where("false")).collect() == [] == G.names_in_texts(t.where("false"), n).collect()


def test_texts_are_scanned_once_for_names(spark, tmp_path):
    spark.createDataFrame([(1, "some text")], "notice_id int, norm string").write.parquet(str(tmp_path / "t"))
    plan = G.names_in_texts(spark.read.parquet(str(tmp_path / "t")), spark.createDataFrame([(1, "some text")], "name_id int, name string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("MapInArrow") == 1 and "Generate" not in plan


def test_severities_rank(spark):
    log = spark.createDataFrame([("k", 1, "SEEN", "PAGE"), ("k", 2, "SEEN", "WARN"), ("k", 3, "RESOLVED", "INFO"), ("k", 4, "SEEN", "INFO"), ("k", 5, "SEEN", "WARN")], "dedupe_key string, seq int, kind string, severity string").withColumn("at", F.lit(1))
    assert [(r.severity, r.status) for r in MO.incidents(log).orderBy("island").collect()] == [("PAGE", "RESOLVED"), ("WARN", "OPEN")]


def test_floors_and_warnings(spark):
    rates = spark.createDataFrame([(1, "PERSON", "dob", 0.89999), (1, "VESSEL", "imo", 0.93), (2, "PERSON", "dob", 0.99), (2, "AIRCRAFT", "msn", 0.0)], "version_id int, entity_type string, field string, value double")
    floors = spark.createDataFrame([("PERSON", "dob", 0.9), ("VESSEL", "imo", 0.9), ("ORGANIZATION", "lei", 0.9)], "entity_type string, field string, floor double")
    assert sorted((r.version_id, r.field, r.status) for r in Q.floor_gate(rates, floors, ["version_id"]).collect()) == [(1, "PERSON.dob", "FAIL"), (1, "VESSEL.imo", "WARN")]
    told = spark.createDataFrame([(1, "PARSE_WARNING", 9), (1, "DATE", 2), (1, "odd", 1), (1, "COUNTRY", 0)], "version_id int, category string, n long")
    assert sorted(r.field for r in Q.warning_gate(told, ["version_id"], ["DATE", "COUNTRY"]).collect()) == ["DATE", "PARSE_WARNING"]


def test_chains_of_any_length_and_circles(spark):
    rows = [(k, k - 1 if k else None) for k in range(1001)] + [(2000 + k, 2000 + (k + 1) % 5) for k in range(5)] + [(2100, 2003), (2200, 9999), (2201, 2200), (2300, 2300)]
    got = {r.run_id: r.chain for r in MO.chain_lengths(spark.createDataFrame(rows, "run_id int, resumed_from int")).collect()}
    assert got == {k: k for k in range(1001)} | dict.fromkeys([2000, 2001, 2002, 2003, 2004, 2100, 2300]) | {2200: 0, 2201: 1}
