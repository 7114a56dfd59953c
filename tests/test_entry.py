import importlib.util

import __spark_entry__ as e


def test_every_query_has_a_name_and_most_have_sql():
    q, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(q) and len(sql) > 0.8 * len(e.registry.QUERIES)


def test_entry_gives_change_counts(spark):
    rows = e.entry(spark).collect()
    assert {r.change_type for r in rows} == {"ADD", "CHANGE", "REMOVE", "SAME"}


def test_training_data_queries_come_and_go_with_their_package():
    has = importlib.util.find_spec("listforge.llm") is not None
    assert has == any(k.startswith("op") and k[2].isdigit() for k in e.queries())
