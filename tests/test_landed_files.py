"""Landed lists grow in files, so that no task reads more as they grow."""

import glob

from listforge.plans import q_sources as S


def test_a_longer_list_lands_in_more_files(spark, monkeypatch):
    monkeypatch.setattr(S, "FILE_ROWS", 100)
    path = S._xml(spark.range(0, 950, 1, 1).selectExpr("CAST(id AS STRING) AS K"), "R")
    files = glob.glob(path.removeprefix("file://") + "/part-*")
    counts = [open(f).read().count("<R>") for f in files]
    assert len(files) == 10 and sum(counts) == 950 and max(counts) <= 150
