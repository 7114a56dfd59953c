"""Published versions on written tables: what readers see after good, broken, repeated and late publishes."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from listforge.operators import publish as P
from listforge.session import new_path

V1 = {"a": "1", "b": "1", "c": "1", "d": "1", "e": None}
V2 = {"a": "1", "b": "2", "d": "1", "e": None, "f": "1"}
V3 = {"a": "1", "b": "2", "c": "1", "e": "3", "f": "1"}


def frame(spark, rows):
    return spark.createDataFrame([(1, k, v, f"name {k}{v}") for k, v in rows.items()], "source_id int, source_key string, content_hash string, name string")


@pytest.fixture
def store(spark):
    return P.ListStore(spark, new_path(spark, "store"), ["source_id", "source_key"], bucket_keys=2)


def seen(df):
    return {r["source_key"]: r["content_hash"] for r in df.collect()}


def test_three_versions(spark, store):
    commits = [store.publish(s, frame(spark, v)) for s, v in ((1, V1), (2, V2), (5, V3))]
    assert [c.counts for c in commits] == [
        {"ADD": 5, "CHANGE": 0, "REMOVE": 0, "RELIST": 0},
        {"ADD": 1, "CHANGE": 1, "REMOVE": 1, "RELIST": 0},
        {"ADD": 0, "CHANGE": 1, "REMOVE": 1, "RELIST": 1},
    ]
    assert seen(store.current()) == V3
    for seq, want in ((0, {}), (1, V1), (2, V2), (4, V2), (5, V3), (9, V3)):
        assert seen(store.as_of(seq)) == want
    got = {(r["source_key"], r["valid_from_seq"], r["valid_to_seq"], r["content_hash"]) for r in store.versions().collect()}
    assert got == {("a", 1, None, "1"), ("b", 1, 2, "1"), ("b", 2, None, "2"), ("c", 1, 2, "1"), ("c", 5, None, "1"), ("d", 1, 5, "1"), ("e", 1, 5, None), ("e", 5, None, "3"), ("f", 2, None, "1")}
    log = {(r["seq"], r["source_key"], r["change_type"]) for r in store.changes().where("seq > 1").collect()}
    assert log == {(2, "b", "CHANGE"), (2, "c", "REMOVE"), (2, "f", "ADD"), (5, "c", "RELIST"), (5, "d", "REMOVE"), (5, "e", "CHANGE")}
    assert P.history(store.commits())[2] == (3, 5, 5, 0, 1, 1, 1)


def test_only_touched_buckets_are_written(spark, store):
    rows = {f"k{i}": "1" for i in range(12)}
    first = store.publish(1, frame(spark, rows))
    second = store.publish(2, frame(spark, rows | {"k3": "2"}))
    assert first.buckets == second.buckets == 8
    new = {b for b, f in second.folders.items() if f == second.folder}
    bucket = frame(spark, {"k3": "2"}).select(store.bucket(8)).first()[0]
    assert new == {str(bucket)} and set(first.folders) == set(second.folders)
    assert [p.name for p in Path(f"{store.root.removeprefix('file:')}/data/{second.folder}/open").glob("bucket=*")] == [f"bucket={bucket}"]
    third = store.publish(3, frame(spark, {f"k{i}": "1" for i in range(40)}))  # more keys, more buckets
    assert third.buckets == 32 and seen(store.current()) == {f"k{i}": "1" for i in range(40)} and seen(store.as_of(2)) == rows | {"k3": "2"}


@pytest.mark.parametrize("at", ["_digest", "_written", "_add"])
def test_a_publish_that_dies_is_invisible(spark, store, monkeypatch, at):
    store.publish(1, frame(spark, V1))

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, at, die)
        with pytest.raises(OSError):
            store.publish(2, frame(spark, V2))
    assert seen(store.current()) == V1 and len(store.commits()) == 1
    assert store.publish(2, frame(spark, V2)).number == 2 and seen(store.current()) == V2 and seen(store.as_of(1)) == V1
    left = store.sweep(older_than_s=0)
    assert seen(store.current()) == V2 and seen(store.as_of(1)) == V1 and store.versions().count() == 7
    assert (len([p for p in left if not p.endswith("/open")]) == 1) == (at != "_digest") and store.sweep(older_than_s=0) == []


def test_repeats_and_older_sequences(spark, store):
    store.publish(3, frame(spark, V1))
    again = store.publish(3, frame(spark, dict(reversed(V1.items()))))
    assert again.number == 1 and len(store.commits()) == 1
    for seq, rows in ((3, V2), (2, V2), (2, V1)):
        with pytest.raises(P.Refused):
            store.publish(seq, frame(spark, rows))
    with pytest.raises(P.Refused):
        store.publish(4, frame(spark, V2).withColumn("more", F.lit(1)))
    assert seen(store.current()) == V1


def test_of_two_publishers_one_commits(spark, store, monkeypatch):
    store.publish(1, frame(spark, V1))
    other = P.ListStore(spark, store.root, store.keys, bucket_keys=2)
    add = store._add

    def late(commit):
        other.publish(2, frame(spark, V2))  # while the first is about to commit
        add(commit)

    monkeypatch.setattr(store, "_add", late)
    with pytest.raises(P.Refused):
        store.publish(3, frame(spark, V3))
    assert seen(other.current()) == V2 and [c.seq for c in other.commits()] == [1, 2]


def test_empty_candidates_and_empty_stores(spark, store):
    with pytest.raises(LookupError):
        store.current()
    none = frame(spark, V1).where("false")
    assert store.publish(1, none).counts["ADD"] == 0 and store.current().count() == 0
    store.publish(2, frame(spark, V1))
    assert store.publish(3, none).counts["REMOVE"] == 5 and store.current().count() == 0 and seen(store.as_of(2)) == V1
    assert store.publish(4, frame(spark, V1)).counts["RELIST"] == 5
