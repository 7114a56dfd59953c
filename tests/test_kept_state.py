"""Intervals stabbed by many points, months that expire, marts that are kept up: each against a plain computation."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from listforge.operators import intervals as I
from listforge.operators import kept as K
from listforge.operators import retention as R
from listforge.operators import versioning as V
from listforge.session import new_path


def test_many_snapshots_equal_single_reads(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), k, f, rng.choice([None, f, f + 1, f + 2, f + rng.randrange(1, 400), f + 2**45])) for k in range(400) for f in [rng.randrange(300)]]
    versions = spark.createDataFrame(rows, "source_id string, key int, valid_from_seq long, valid_to_seq long")
    pins = [(s, src, rng.randrange(-1, 500)) for s in range(100) for src in "ab"] + [(100, "a", 2**44), (101, "none", 3)]
    found = I.as_of_many(versions, spark.createDataFrame(pins, "snapshot_id int, source_id string, pin long"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = sorted((r.snapshot_id, r.key) for r in found.collect())
    assert got == sorted((s, k) for s, src, p in pins for o, k, a, b in rows if o == src and a <= p and (b is None or p < b))
    one = spark.createDataFrame([(src, p) for s, src, p in pins if s == 7], "source_id string, pin long")
    assert sorted(r.key for r in V.as_of(versions, one).collect()) == [k for s, k in got if s == 7]


@pytest.fixture
def evidence(spark):
    e = R.Evidence(spark, new_path(spark, "evidence"), "run_id int, at timestamp, status string", "at")
    rows = [(i, dt.datetime(2024, 1 + i % 6, 1 + i % 28), "HELD" if i % 10 in (0, 1) else "DONE") for i in range(120)]
    e.append(spark.createDataFrame(rows[:60], "run_id int, at timestamp, status string"))
    e.append(spark.createDataFrame(rows[60:], "run_id int, at timestamp, status string"))
    return e, rows


def ids(df):
    return sorted(r.run_id for r in df.collect())


def test_months_expire_and_held_rows_stay(spark, evidence):
    e, rows = evidence
    assert ids(e.read()) == [r[0] for r in rows] and e.months() == [f"2024-0{m}" for m in range(1, 7)]
    held = F.col("status") == "HELD"
    assert e.expire(dt.date(2024, 5, 15), 46, held) == ["2024-01", "2024-02"]  # until March 30: March isn't over
    want = [r[0] for r in rows if r[1].month > 2 or r[2] == "HELD"]
    assert ids(e.read()) == want and e.months() == ["2024-03", "2024-04", "2024-05", "2024-06"]
    assert e.expire(dt.date(2024, 5, 15), 46, held) == [] and ids(e.read()) == want
    assert e.expire(dt.date(2024, 5, 17), 46, held & (F.col("run_id") != 0)) == ["2024-03"]
    assert ids(e.read()) == [r[0] for r in rows if r[1].month > 3 or (r[2] == "HELD" and r[0] != 0)]
    assert e.expire(dt.date(2030, 1, 1), 0, F.lit(False)) and e.read().count() == 0 and e.months("/held") == []


def test_reads_open_the_months_they_need(spark, evidence):
    e, rows = evidence
    part = e.read(dt.date(2024, 3, 10), dt.date(2024, 4, 5))
    assert ids(part) == [r[0] for r in rows if dt.date(2024, 3, 10) <= r[1].date() <= dt.date(2024, 4, 5)]
    opened = {r[0].split("month=")[1][:7] for r in e._folders(["2024-03", "2024-04"]).select(F.input_file_name()).distinct().collect()}
    assert opened == {"2024-03", "2024-04"} and all("month=2024-03" in f or "month=2024-04" in f for f in part.inputFiles())


def test_an_expiry_that_dies_changes_nothing(spark, evidence, monkeypatch):
    e, rows = evidence

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(R, "drop_path", die)
        with pytest.raises(OSError):
            e.expire(dt.date(2024, 5, 15), 46, F.col("status") == "HELD")
    assert ids(e.read()) == [r[0] for r in rows]
    e.expire(dt.date(2024, 5, 15), 46, F.col("status") == "HELD")
    assert ids(e.read()) == [r[0] for r in rows if r[1].month > 2 or r[2] == "HELD"]


def test_kept_marts_equal_those_from_scratch(spark):
    rng = random.Random(2)
    volume = K.KeptMart(spark, new_path(spark, "mart"), "source_id string, seq int, status string, change_type string")
    counts = K.KeptMart(spark, new_path(spark, "mart"), "source_id string, seq int, entity_type string")
    now, log, want = {}, [], []
    for seq in range(1, 6):
        changes = []
        for k in range(30):
            new = rng.choice([None, "PERSON", "VESSEL", now.get(k)])
            kind = "ADD" if k not in now else "REMOVE" if new is None else "CHANGE"
            if new != now.get(k):
                changes.append(("S", seq, k, "HELD" if seq == 3 else "PUBLISHED", kind, now.get(k), new))
                now.pop(k, None)
                now |= {k: new} if new else {}
        log += changes
        df = spark.createDataFrame(changes, "source_id string, seq int, key int, status string, change_type string, old string, new string")
        for _ in range(2):  # the second time changes nothing
            volume.apply(seq, K.change_rows(df, volume.dims))
            counts.apply(seq, K.count_rows(df, ["source_id", "seq"], "old", "new"))
        want += [("S", seq, t, n) for t, n in Counter(now.values()).items()]
        assert {tuple(r) for r in volume.read().collect()} == {(*k, n) for k, n in Counter((c[0], c[1], c[3], c[4]) for c in log).items()}
        got = K.running_counts(counts.read(), ["source_id", "entity_type"], "seq").select("source_id", "seq", "entity_type", "n")
        assert {tuple(r) for r in got.collect()} == set(want)
        if seq == 4:
            volume.compact()
            volume.apply(2, K.change_rows(df, volume.dims))  # compacted already
    held = K.change_rows(spark.createDataFrame([c for c in log if c[1] == 3], df.schema), volume.dims)
    volume.apply(6, K.released(held, F.lit("HELD"), F.lit("PUBLISHED")))
    assert {tuple(r) for r in volume.read().collect()} == {(*k, n) for k, n in Counter((c[0], c[1], "PUBLISHED", c[4]) for c in log).items()}
    volume.compact()
    assert volume.read().count() == len(Counter((c[1], c[4]) for c in log)) and len(volume._folders()) == 1
