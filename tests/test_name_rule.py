"""The SQL of the name queries folds and counts names as the operators do."""

import duckdb
import pytest

import __spark_entry__ as e

NAMES = ["Straße nach Köln", "one", "a b", "", None, "back`tick name^d", "Банк Россия", "naïve Société", "under_score two", "x\u00a0y zzzz", "don't go there", "日本 銀行 東京", "acute\u00b4 mark"]
TEXTS = [f"before {n} after" for n in NAMES if n] + ["strasse NACH koln", "stra e nach koln", "backtick named", "back tick name d", "ban one a b", "", None, "банк россия!", "под банк россиян", "dont go there", "acute mark"]


@pytest.mark.parametrize("name", ["g04_names_in_texts", "g05_g06_notice_status"])
def test_sql_has_the_rule_of_the_names(spark, tmp_path, name):
    d = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(NAMES)), "item_id long, text string")
    d.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    b.coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS FROM '{tmp_path}/{t}.parquet/*.parquet'")
    df = e.registry.QUERIES[name](spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(df.columns)} FROM ({e.registry.ORACLES[name]})").fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(want) and len(want) > 8
