"""Row filters: required fields, first-kept keys, keywords, cutoffs, optional parameters, search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def required(df: DataFrame, reasons: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with the first reason that holds)."""
    reason = F.coalesce(*[F.when(c, F.lit(r)) for r, c in reasons.items()])
    marked = df.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


def first_kept(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The first row of each key by file position, with the number of rows dropped behind it."""
    w = Window.partitionBy(*keys)
    ranked = df.withColumns({"__r": F.row_number().over(w.orderBy(position)), "duplicates": F.count("*").over(w) - 1})
    return ranked.where("__r = 1").drop("__r")


def keyword_keep(text: Column, keywords: Sequence[str]) -> Column:
    """Any keyword, in any case; no keywords keep everything."""
    out = F.lit(not keywords)
    low = F.lower(text)
    for k in keywords:
        out = out | low.contains(k.lower())
    return out


def newest(df: DataFrame, date: str, as_of: Column, days: int, n: int, *ties: Column) -> DataFrame:
    """The newest n rows at most ``days`` old; undated rows pass."""
    kept = df.where(F.col(date).isNull() | (F.to_date(date) >= F.date_sub(as_of, days)))
    return kept.orderBy(F.col(date).desc_nulls_last(), *ties).limit(n)


def optional(df: DataFrame, **wanted) -> DataFrame:
    """Equality filters of which those with None don't apply."""
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def search(df: DataFrame, needle: str, cols: Sequence[str], n: int, *order: Column) -> DataFrame:
    """Case-insensitive substring search over several columns, first n in the given order."""
    hit = F.lit(False)
    for c in cols:
        hit = hit | F.lower(F.coalesce(F.col(c), F.lit(""))).contains(needle.lower())
    return df.where(hit).orderBy(*order).limit(n)
