"""Every registered list query gives the rows of its SQL in DuckDB."""

import duckdb
import pytest

import __spark_entry__ as e

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return c


def plain(rows):
    fix = lambda v: round(v, 6) if isinstance(v, float) else v
    return sorted(([fix(v) for v in r] for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(set(e.registry.QUERIES) & set(e.registry.ORACLES)))
def test_query_equals_its_sql(spark, con, name):
    df = e.registry.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    sql = e.registry.ORACLES[name]
    assert cols == sorted(con.sql(sql).columns)
    want = con.sql(f"SELECT {', '.join(chr(34) + c + chr(34) for c in cols)} FROM ({sql})").fetchall()
    assert plain(df.select(cols).collect()) == plain(want)
