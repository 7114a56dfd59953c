"""Inputs that the registered queries derive from the star-schema tables, in SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _party(keep: str, change: str) -> str:
    return f"""
SELECT c_custkey AS source_key, 'L' || CAST(c_custkey % 3 AS VARCHAR(9)) AS source_id,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 'VESSEL' WHEN 'BUILDING' THEN 'ORGANIZATION' WHEN 'AUTOMOBILE' THEN 'AIRCRAFT' ELSE 'PERSON' END AS entity_type,
       c_name AS primary_name, CAST(c_nationkey AS VARCHAR(9)) AS country,
       CAST(CAST(round(c_acctbal * 100) AS BIGINT) + {change} AS VARCHAR(30)) AS amount
FROM customer WHERE {keep}"""


#: Three versions of a list of parties: some leave, come, change and return.
PARTY1 = _party("c_custkey % 10 <> 3", "0")
PARTY2 = _party("c_custkey % 10 <> 7", "CASE WHEN c_custkey % 10 = 5 THEN 100 ELSE 0 END")
PARTY3 = PARTY1

#: Identifiers of parties: two a party, with labels, checksummed numbers and shared values.
IDENTIFIERS = """
SELECT o_orderkey AS rid, o_custkey AS source_key, 'L' || CAST(o_custkey % 3 AS VARCHAR(9)) AS source_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'IMO number' WHEN '2-HIGH' THEN 'Passport' WHEN '3-MEDIUM' THEN 'MMSI' WHEN '4-NOT SPECIFIED' THEN 'Company Number' ELSE 'Minimum' END AS label,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'IMO ' || lpad(CAST(o_orderkey * 7919 % 10000000 AS VARCHAR(9)), 7, '0')
            WHEN '2-HIGH' THEN 'ab-' || CAST(o_orderkey % 97 AS VARCHAR(9)) WHEN '3-MEDIUM' THEN lpad(CAST(o_orderkey * 104729 % 1000000000 AS VARCHAR(12)), 9, '2')
            WHEN '4-NOT SPECIFIED' THEN ' ' ELSE 'X/' || CAST(o_orderkey % 31 AS VARCHAR(9)) || '.1' END AS value
FROM orders"""

#: Runs of sources: status, times and counts.
RUNS = """
SELECT o_orderkey AS run_id, 'S' || CAST(o_custkey % 40 AS VARCHAR(9)) AS source_id, o_custkey % 100 AS batch_id, o_orderdate AS queued_at,
       CASE o_orderstatus WHEN 'F' THEN 'FAILED' WHEN 'O' THEN CASE WHEN o_orderkey % 9 = 0 THEN 'HELD' WHEN o_orderkey % 9 = 1 THEN 'NO_CHANGE' ELSE 'SUCCEEDED' END
            ELSE CASE WHEN o_orderkey % 11 = 0 THEN 'RUNNING' ELSE 'SUCCEEDED' END END AS status,
       CAST(o_orderkey % 4 AS INT) AS attempt, CAST(o_orderkey % 50 AS INT) AS added, CAST(o_orderkey % 20 AS INT) AS changed, CAST(o_orderkey % 5 AS INT) AS removed,
       CAST(floor(o_totalprice) AS BIGINT) AS seconds
FROM orders"""

#: Fetch log: one row an event; errors carry a class.
FETCHES = """
SELECT event_id, 'S' || CAST(user_id % 40 AS VARCHAR(9)) AS source_id, ts AS fetched_at, CASE WHEN event_type = 'error' THEN 'E' || CAST(event_id % 4 AS VARCHAR(9)) END AS error_class,
       CAST(floor(value * 10) AS BIGINT) AS duration_ms, event_id * 37 % 100000 AS size_bytes
FROM events"""


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Temporary views of the tables, for the derivations above."""
    for n in names:
        load(spark, sf_dir, n).createOrReplaceTempView(n)


def derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    import re

    views(spark, sf_dir, *(t for t in TABLES if re.search(rf"\b{t}\b", sql)))
    return spark.sql(sql)
