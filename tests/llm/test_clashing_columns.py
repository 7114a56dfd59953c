"""Operators that return whole documents leave further columns alone, whatever their names; stages take nulls, repeats and empty tables."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from listforge.llm import decontaminate, line_dedup, near_copies, quality_rules

NAMES = "__id __th __kept __drop __cut __host __lines __keep id th kept cut drop host lines h k1 k2 batch line_no dropped sh fp bands component_id first n pos slots width form item_id".split()
LONG = " ".join(f"word{i} goes here" for i in range(30))
ROWS = [
    (1, "a shared line of text\n" + LONG, "en", "s"), (2, "a shared line of text\nother words " + LONG.upper(), "en", "s"), (3, None, None, None), (None, LONG, "en", "s"), (4, "", "en", "t"),
    (5, LONG + " more", None, None), (5, LONG + " more", None, None), (6, "What is the number of days in a common year of the calendar?", "en", "u"), (7, "x", "de", ""),
]
ITEM = "What is the number of days in a common year of the calendar?"


def documents(spark, rows=ROWS):
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")


OPERATORS = {
    "keep_one": lambda spark, d: near_copies.keep_one(d),
    "drop_contaminated": lambda spark, d: decontaminate.drop_contaminated(d, spark.createDataFrame([(1, ITEM)], "item_id long, text string")),
    "dedup_lines": lambda spark, d: line_dedup.dedup_lines(d).drop("n_lines", "n_dropped"),
    "clean": lambda spark, d: quality_rules.clean(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_other_columns_stay_whatever_their_names(spark, name):
    plain = documents(spark)
    more = plain.withColumns({c: F.concat(F.lit(c), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in NAMES})
    out = OPERATORS[name](spark, more)
    assert out.columns == more.columns
    rows = out.collect()
    assert all(r[c] == f"{c}{'-' if r.doc_id is None else r.doc_id}" for r in rows for c in NAMES)
    want = OPERATORS[name](spark, plain).collect()
    assert sorted((tuple(r)[:5] for r in rows), key=str) == sorted(map(tuple, want), key=str)


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_take_odd_rows_and_empty_tables(spark, tmp_path, stage):
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(spark)
    out = stage[1](spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in out.collect()}
    assert {d for d, _ in texts} <= {r[0] for r in ROWS}
    empty = stage[1](spark, documents(spark).where("false"), str(tmp_path))
    assert empty.columns == docs.columns and empty.collect() == []


def test_the_last_stage_takes_odd_rows_and_empty_tables(spark, tmp_path):
    pack = corpus_pipeline.STAGES[-1][1]
    assert {r.doc_id for r in pack(spark, documents(spark), str(tmp_path)).collect()} == {r[0] for r in ROWS}
    assert pack(spark, documents(spark).where("false"), str(tmp_path)).collect() == []
