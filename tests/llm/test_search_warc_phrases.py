"""Ranked search, WARC archives and phrases against brute force, with nulls, ties, repeats, long texts and clashing columns."""

import base64
import gzip
import hashlib
import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from listforge.llm import collocations, lexical_search, warc

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def terms(s):
    return TERM.findall(lower(s or ""))


def brute_search(docs, items, top):
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c, c.total()) for d, c in held if c]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    of = defaultdict(set)
    for i, t in items:
        if i is not None:
            of[i] |= set(terms(t))
    out = []
    for i, ts in of.items():
        scored = []
        for d, c, size in held:
            m = 100 - 50 + 50 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if c[t])
            if s > 0:
                scored.append((-s, d is None, d or 0))
        out += [(i, k + 1, None if null else d, -s) for k, (s, null, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def corpus(seed, n, words=60):
    r = np.random.default_rng(seed)
    vocabulary = np.array([f"w{i}" for i in range(words)] + ["Äpfel", "x-y", "Zoo"])
    weight = 1 / np.arange(1, len(vocabulary) + 1)
    return [" ".join(r.choice(vocabulary, size=r.integers(1, 40), p=weight / weight.sum())) for _ in range(n)]


@pytest.mark.parametrize("top,stages", [(5, 1), (5, 4), (50, 3)])
def test_search_equals_brute_force(spark, top, stages):
    texts = corpus(1, 300)
    docs = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (7, "w1 w2 other"), (None, "w3 w4 w5"), (None, None), (900, None), (901, ""), (902, "-- ,"), (903, "w9 " * 40_000 + "ZOO")]
    docs += [(1000 + i, "w40 W41 w42 x") for i in range(80)]  # ties beyond the limit
    items = [(1, texts[3]), (2, "w40 w41"), (3, None), (4, "?"), (5, "nowhere"), (None, "w1"), (6, "w1 w2"), (6, "Zoo äpfel"), (8, " ".join(texts[:4]))]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"item_id": F.lit(1), "rank": F.lit("x"), "block": F.lit(0)}).repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(3))
    got = lexical_search.search(d, q, top=top, stages=stages)
    want = brute_search(docs, items, top)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    in_blocks = lexical_search.search(d, q, top=top, stages=stages, item_bytes=40)
    assert sorted((tuple(r) for r in in_blocks.collect()), key=str) == want


def test_search_in_small_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "SLICE", 64)
    assert sum((len(x) for x in lexical_search.slices(b"Ab cd-ef " * 100)), 0) == 300
    assert [w for x in lexical_search.slices(b"x" * 500 + b" y") for w in x] == [b"x" * 500, b"y"]


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical_search.search(none, items).collect() == []
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert lexical_search.search(docs, items.where("false")).columns == ["item_id", "rank", "doc_id", "score"]
    assert lexical_search.search(docs, items.where("false")).collect() == []


def test_owners_hold_about_the_same_and_rare_terms_come_first():
    df = np.array([100, 1, 50, 2, 100, 3, 80, 64])
    owner = lexical_search.owners(df, 4)
    assert set(owner) <= {0, 1, 2, 3} and max(owner) == owner[4] == 3 and owner[1] == 0
    assert all(owner[a] <= owner[b] for a in range(8) for b in range(8) if df[a] < df[b])


PAGES = [
    (1, "https://M.Example.org:443/a b?x=1#top", "<p>one</p>"),
    (2, "https://m.example.org/a%20b?x=1", "<p>one</p>"),
    (3, "http://m.example.org:8080/", "ü" * 70_000),
    (4, None, None),
    (5, "", ""),
    (6, "not an address\n", "\x1f odd \r\n\r\n WARC/1.1"),
    (None, "http://x.net", "only here"),
    (None, "http://x.net", "only here"),
    (None, "http://x.net/2", "<p>one</p>"),
    (9, "http://x.net", "twice"),
    (9, "http://x.net", "twice"),
    (8, "http://x.net", "twice"),
]


def brute_pages(pages, least=0):
    best = {}
    for p, _, h in pages:
        if p is not None:
            best[h or ""] = max(best.get(h or "", p), p)
    out = []
    for p, _, h in pages:
        raw = (h or "").encode()
        w = best.get(h or "") if len(raw) >= least else None
        first = w is None or p == w
        out.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if first else "revisit", None if first else w))
    return sorted(out, key=str)


def read_back(spark, pages, least=0, **sizes):
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"winner": F.lit(1), "same": F.lit("x"), "id": F.lit(2), "key": F.lit("k")}).repartition(3)
    path = warc.new_path(spark, "warc-test")
    warc.write_archives(df, path, least, records=sizes.get("records", 4))
    index = warc.build_index(warc.captures(spark, path), sizes.get("lines", 2))
    keys = df.select(warc.host_key(warc.address(F.col("url"))).alias("key")).distinct()
    return path, index, warc.read_records(warc.look_up(index, keys))


@pytest.mark.parametrize("least", [0, 6])
def test_archives_read_back_as_written(spark, least):
    _, _, found = read_back(spark, PAGES, least)
    got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_pages(PAGES, least)
    whole = {r["page_id"]: r["payload"] for r in found.where("record_type = 'response' AND page_id IS NOT NULL").collect()}
    assert all(bytes(v).decode() == next(h or "" for p, _, h in PAGES if p == k) for k, v in whole.items())


def test_archives_are_plain_members_of_records(spark):
    path, _, _ = read_back(spark, PAGES)
    files = [p for p in Path(path.removeprefix("file:")).glob("part-*")]
    text = b"".join(gzip.decompress(p.read_bytes()) for p in files if p.stat().st_size)
    assert len(files) > 2 and text.count(b"WARC-Record-ID: ") == len(PAGES) and text.startswith(b"WARC/1.1\r\nWARC-Type: ")


def test_a_hot_address_fills_many_blocks(spark):
    pages = [(i, "http://hot.example.com/x", f"page {i}") for i in range(300)] + [(1000 + i, f"http://a{i}.example.com/", "same") for i in range(100)]
    _, index, found = read_back(spark, pages, records=50, lines=10)
    assert index.count() > 30 and index.select("part").distinct().count() > 2
    got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_pages(pages)
    one = spark.createDataFrame([("com,example,a7)/",), ("com,example,none)/",), (None,)], "key string")
    assert [r["page_id"] for r in warc.look_up(index, one).collect()] == [1007]


def test_no_pages_give_no_records(spark):
    assert read_back(spark, [])[2].collect() == []


def test_keys_of_addresses(spark):
    urls = ["https://user@M.a.org:80/x?y#z", "http://a.org", "ftp://a.org?q", "plain text", None, "http://a.org:81/"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(warc.host_key(F.col("u")))
    assert [r[0] for r in df.collect()] == ["org,a,m)/x?y", "org,a)/", "org,a)/?q", "plain text", "", "org,a:81)/"]


def brute_phrases(docs, least, first, longest=5):
    count, total = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            ws = [w for w in re.split("[\x20\x09]+", piece) if w]
            total[lang] += len(ws)
            for n in range(1, longest + 1):
                count[lang].update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    out = []
    for lang, f in count.items():
        cand = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        inside = Counter()
        for p, a in cand.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        rows = []
        for p, a in cand.items():
            if 100 * inside[p] >= 100 * a:
                continue
            s, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-s, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:first])]
    return sorted(out, key=str)


TEXTS = [("en", "The cat sat on the mat. " * 9 + "the  cat\tsat"), (None, "a b c d e f, A B C D E F! " * 6), ("en", "on the mat " * 30), ("en", None), (None, None), ("de", ""), ("und", "a b c d e f"), ("de", "Äpfel und Birnen; Äpfel und Birnen" * 8)]


@pytest.mark.parametrize("sizes", [{}, {"chunk": 40, "gather": 10, "bits": 64}])
def test_phrases_equal_brute_force(spark, sizes):
    texts = TEXTS + [("en", t) for t in corpus(2, 150, words=15)]
    df = spark.createDataFrame([(i // 2, *t) for i, t in enumerate(texts)], "doc_id long, lang string, text string").withColumns({"fp": F.lit(1), "n": F.lit(2), "phrase": F.lit("x"), "c": F.lit(0)}).repartition(4)
    for first in (8, 1000):
        got = collocations.collocations(df, least=5, first=first, **sizes).drop("doc_id")
        assert sorted((tuple(r) for r in got.collect()), key=str) == brute_phrases(texts, 5, first)


def test_fingerprints_that_meet_don_t_mix_phrases(spark, monkeypatch):
    monkeypatch.setattr(collocations, "mix", lambda x: x * np.uint64(0))  # every fingerprint is the same
    words = collocations.Words(np.frombuffer(b"aa bb aa bc aa bb", np.uint8), np.uint64(0))
    at = words.whole(2)
    assert len(set(words.fingerprints(at, 2).tolist())) == 1
    assert words.equal(at, np.zeros(len(at), np.int64), 2).tolist() == [True, False, False, False, True]


def test_chunks_end_between_pieces():
    texts = [b"One two. Three four! " * 20, b"", b"x" * 90, b"end"]
    got = list(collocations.chunks(texts, 32))
    assert sorted(b"".join(d.tobytes() for d, _ in got).replace(b"\n", b"")) == sorted(b"".join(texts).lower())
    assert all(len(d) <= 32 or b"x" * 90 in d.tobytes() for d, _ in got) and {i for _, s in got for i in s[:, 1].tolist()} == {0, 1, 2, 3}


def test_phrases_of_an_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "doc_id long, lang string, text string")).collect() == []
