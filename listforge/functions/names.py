"""Name normalisation and name scores.

ASCII names are folded by built-in functions. Other scripts need Unicode decomposition, which has no built-in form: only those
values enter an Arrow UDF, which looks every character up in a table that fills itself.
"""

from __future__ import annotations

import re
import unicodedata as ud

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


class Folds(dict):
    """Code point -> what stands for it in a normalised name: nothing for marks, a blank for punctuation."""

    def __missing__(self, point: int) -> str:
        plain = [x for c in ud.normalize("NFKD", chr(point)) if not self.is_mark(c) for x in c.casefold()]
        self[point] = out = "".join(x if x.isalnum() or x == "_" else " " for x in plain)
        return out

    @staticmethod
    def is_mark(c: str) -> bool:
        """Non-spacing marks, modifier letters and modifier symbols."""
        return ud.category(c) in {"Mn", "Lm", "Sk"}


FOLDS = Folds()
#: ASCII alone goes through a plain table, in which dropped characters are None.
ASCII_FOLDS = {p: FOLDS[p] or None for p in range(128)}
OTHER_SCRIPT = re.compile(r"[^\x00-\x7f]+")


def _fold_text(text: str) -> str:
    """Runs of other scripts first; what they fold to stays as it is where it isn't ASCII."""
    text = OTHER_SCRIPT.sub(lambda run: run[0].translate(FOLDS), text)
    return " ".join(text.translate(ASCII_FOLDS).split())


@F.pandas_udf(StringType())
def _unicode_fold(names: pd.Series) -> pd.Series:
    return names.map(_fold_text, na_action="ignore")


def normalize_name(name: Column) -> Column:
    """Case-folded, without diacritics and punctuation, single-spaced; null stays null."""
    ascii_ = F.octet_length(name) == F.length(name)
    plain = F.trim(F.regexp_replace(F.translate(F.lower(name), "^`", ""), "[^a-z0-9_]+", " "))
    return F.when(ascii_, plain).otherwise(_unicode_fold(F.when(~ascii_, name)))


def with_normalized(df: DataFrame, name: str, out: str) -> DataFrame:
    """df plus the normalised name; each distinct name is folded once."""
    folded = df.select(F.col(name).alias("__raw")).distinct().withColumn(out, normalize_name(F.col("__raw")))
    return df.join(folded, F.col(name).eqNullSafe(F.col("__raw")), "left").drop("__raw")


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & where.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


@F.pandas_udf(DoubleType())
def _sorted_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = " ".join(sorted(x.split())), " ".join(sorted(y.split()))
        out.append(2 * _lcs(x, y) / (len(x) + len(y)))
    return pd.Series(out)


def name_score(core_a: Column, core_b: Column) -> Column:
    """Token-sorted common-subsequence ratio of two core names: 1 if equal, 0 if either is empty."""
    a, b = F.coalesce(core_a, F.lit("")), F.coalesce(core_b, F.lit(""))
    safe = F.when((a == "") | (b == ""), F.lit("x")).otherwise(a), F.when((a == "") | (b == ""), F.lit("y")).otherwise(b)
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(F.round(_sorted_ratio(*safe), 4))


def decision(score: Column, accept: float = 0.95, review: float = 0.85) -> Column:
    return F.when(score >= accept, "AUTO_ACCEPTED").when(score >= review, "NEEDS_REVIEW").otherwise("NO_MATCH")
