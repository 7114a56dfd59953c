"""Nested JSON differences and hash trees against plain Python."""

import json
import random

import pytest
from pyspark.sql import functions as F

from listforge.operators import jsondiff as J
from listforge.operators import merkle as M
from listforge.session import new_path


def plain_diff(old, new, at=()):
    if isinstance(old, dict) and isinstance(new, dict):
        return [p for k in sorted({*old, *new}) for p in plain_diff(old.get(k), new.get(k), (*at, k))]
    return [] if old == new else [".".join(at) if at else "<root>"]


def document(rng, depth=0):
    kind = rng.random()
    if depth < 7 and kind < (1 if depth == 0 else 0.5):
        return {rng.choice(["url", "a", "b b", "ü", "d.e", ""]): document(rng, depth + 1) for _ in range(rng.randrange(4))}
    return rng.choice([1, 2, -3.5, True, None, "x", "OBJECT<", "", [1, {"a": 2}], [1, {"a": 3}], [], "é\n\""])


def test_paths_of_nested_documents(spark):
    rng = random.Random(3)
    docs = [(i, document(rng), document(rng)) for i in range(150)]
    docs += [(200 + i, a, b) for i, (a, b) in enumerate([({}, {}), ({"a": {}}, {}), ({"a": None}, {}), (1, 2), ([1], {"a": 1}), (None, {}), ({"a": {"b": {"c": {"d": 1}}}}, {"a": {"b": {"c": {"d": 2}}}})])]
    df = lambda i: spark.createDataFrame([(d[0], json.dumps(d[i])) for d in docs] + [(999 + i, "{}"), (998, None)], "id int, doc string")
    got = {}
    for r in J.diff_paths(df(1), df(2), ["id"], "doc", ["url", "c"]).collect():
        got.setdefault(r.id, []).append(r.path)
        assert r.sensitive == bool({"url", "c"} & set(r.path.split(".")))
    assert {k: sorted(v) for k, v in got.items()} == {i: sorted(plain_diff(a, b)) for i, a, b in docs if plain_diff(a, b)}


def test_versions_of_documents(spark):
    rows = [("k", 1, '{"a": 1, "b": {"c": [1]}}'), ("k", 2, '{"a": 1, "b": {"c": [1, 2]}}'), ("k", 3, '{"b": 0}'), ("m", 7, "{}"), ("k", 5, '{"z": 1}'), ("n", 1, "no json"), ("n", 2, "{}")]
    got = {(r.k, r.v, r.path, r.old_value, r.new_value) for r in J.version_paths(spark.createDataFrame(rows, "k string, v int, doc string"), ["k"], "v", "doc").collect()}
    assert got == {("k", 2, "b.c", "[1]", "[1,2]"), ("k", 3, "a", "1", None), ("k", 3, "b", None, "0"), ("n", 2, "<root>", None, None)}
    assert J.nodes(spark.createDataFrame([], "k string, doc string"), ["k"], "doc").collect() == []


def table(spark, rows):
    return spark.createDataFrame(sorted(rows.items()), "key int, content_hash string").withColumn("more", F.concat(F.lit("m"), "content_hash"))


@pytest.mark.parametrize("range_keys", [4, 10_000])
def test_diff_reads_the_ranges_that_differ(spark, range_keys):
    rows = {k: str(k % 7) for k in range(200)}
    other = rows | {3: "x", 900: "1"}
    del other[4]
    paths = []
    for r in (rows, other, rows, {}):
        paths.append(new_path(spark, "merkle"))
        M.write(table(spark, r), paths[-1], ["key"], range_keys=range_keys)
    a, b, same, none = (M.Version(spark, p) for p in paths)
    assert M.changed_ranges(a, same)[1] == [] and M.changes(a, same, ["key"]).collect() == []
    depth, ranges = M.changed_ranges(a, b)
    assert len(ranges) <= 3 and (range_keys > 200 or len(ranges) > 1)
    assert {(r.key, r.change_type) for r in M.changes(a, b, ["key"]).collect()} == {(3, "CHANGE"), (4, "REMOVE"), (900, "ADD")}
    assert tuple(M.preview(a, b, ["key"]).first()) == (1, 1, 1, 198, 200) and tuple(M.preview(a, none, ["key"]).first()) == (0, 200, 0, 0, 200)
    read = lambda df: df.select(F.input_file_name()).distinct().count()
    part = a.rows(M._under(a, depth, ranges))
    assert read(part) <= len(ranges) and (range_keys > 8 or read(a.rows()) > 100) and "PartitionFilters: [" in part._jdf.queryExecution().executedPlan().toString()


def test_trees_of_different_depth(spark):
    small, large = {k: "a" for k in range(40)}, {k: "a" for k in range(100)}
    paths = [new_path(spark, "merkle") for _ in range(2)]
    for p, r in zip(paths, (small, large), strict=True):
        M.write(table(spark, r), p, ["key"], range_keys=4)
    a, b = (M.Version(spark, p) for p in paths)
    assert a.depth() < b.depth()
    assert {(r.key, r.change_type) for r in M.changes(a, b, ["key"]).collect()} == {(k, "ADD") for k in range(40, 100)}
    assert M.changes(b, a, ["key"]).count() == 60


def test_roots_tell_groups_apart(spark):
    rows = [("s", 1, "a"), ("s", 2, "b"), ("t", 2, "b"), ("t", 1, "a"), ("u", 1, "b"), ("u", 2, "a"), ("v", 1, "a"), ("v", 1, "a"), ("w", 1, None)]
    got = {r.g: r.root for r in M.roots(spark.createDataFrame(rows, "g string, key int, h string"), ["g"], ["key"], "h").collect()}
    assert got["s"] == got["t"] and len(set(got.values())) == 4
