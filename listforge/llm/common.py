"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of all word and line contracts: \x20 and \x09-\x0D.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a computed value inside one expression, so that it is evaluated once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for own use, made of the given ones, that no column of df has in any spelling."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
