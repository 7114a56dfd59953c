"""Boilerplate lines are cut from the documents that stay."""

import corpus_pipeline
from listforge.llm import quality_rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def body(k):
    return " ".join(f"word{k}x{j}" for j in range(12))


def test_boilerplate_lines_are_cut(spark):
    line = "Subscribe to our news letter"
    rows = [(k, f"{body(k)}\n\n  {line.upper()} \n{body(k + 1000)}", None, "a", 0) for k in range(60)]
    rows += [(100, f"{line}\n{body(7000)}", None, "b", 0), (101, None, None, "a", 0), (None, f"{line}\n{body(8000)}", None, "a", 0)]
    rows += [(0, f"{body(9000)}\n{line}", None, "a", 0), (102, f"{line} short", None, "a", 0)]
    out = corpus_pipeline.quality_stage(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), "").collect()
    want = [(k, f"{body(k)}\n\n{body(k + 1000)}") for k in range(60)] + [(100, f"{line}\n{body(7000)}"), (None, body(8000)), (0, body(9000))]
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in out)


def test_limit_of_small_middle_and_hot_hosts(spark):
    line, rows = "Subscribe to our news letter", []
    holders = {"small": (50, 6), "sparse": (50, 5), "middle": (500, 50), "edge": (500, 25), "hot": (4000, 60), "hot edge": (4000, 50)}
    for host, (n, m) in holders.items():
        rows += [(len(rows) + k, f"{body(len(rows) + k)}\n{line}" if k < m else body(len(rows) + k), None, host, 0) for k in range(n)]
    out = corpus_pipeline.quality_stage(spark, spark.createDataFrame(rows, SCHEMA).repartition(8), "").collect()
    assert len(out) == len(rows)
    held = {h: sum(r.source == h and line in r.text for r in out) for h in holders}
    assert held == {"small": 0, "sparse": 5, "middle": 0, "edge": 25, "hot": 0, "hot edge": 50}


def test_query_rejects_depleted_documents(spark):
    """The dealt rule decides: hosts with shared lines, documents that are little else, against brute force."""
    from . import brute

    shared = [" ".join(f"shared{k}w{j}" for j in range(9)) for k in range(6)]
    rows = [(k, "\n".join([*shared[: k % 7], body(k)] if k % 3 else [*shared, f"own {k} words here only"]), f"h{k % 4}" if k % 5 else None) for k in range(240)]
    rows += [(300, "\n".join(shared), "lonely"), (301, None, "h1"), (301, body(5), "h1"), (302, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_boiler")
    out = sorted((tuple(r) for r in quality_rules.op9(spark, df).select(*cols).collect()), key=str)
    assert out == sorted(brute.quality(rows), key=str)
    assert sum(not r[7] and not r[6] for r in out) > 40 and sum(r[8] > 0 and r[7] for r in out) > 40
