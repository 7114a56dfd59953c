"""Nested JSON documents: their nodes to any depth, and the dotted paths at which two versions differ.

Documents are parsed once to VARIANT and taken apart level by level with built-in functions. A level is written before the next one is made, so
the work is that of all nodes once, however deep they lie; the loop ends with the first level that holds no objects.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable

#: Path of a document that isn't an object.
ROOT = "<root>"


def nodes(docs: DataFrame, keys: Sequence[str], doc: str) -> DataFrame:
    """keys, path array<string>, is_object, value: every node that is reached through objects, the document itself under an empty path.

    Values are JSON text: arrays whole, objects and JSON's null as null. What isn't JSON counts as null, a null document has no nodes.
    """
    shape = F.schema_of_variant("__v")
    # a document is small beside its nodes: a given number of partitions, which aren't put together, spreads the levels over all tasks
    docs = docs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    level = docs.where(F.col(doc).isNotNull()).select(*keys, F.array().cast("array<string>").alias("path"), F.try_parse_json(doc).alias("__v"))
    out = []
    while True:
        is_object = F.coalesce(F.startswith(shape, F.lit("OBJECT")), F.lit(False))
        plain = F.when(~is_object & (shape != "VOID"), F.to_json("__v"))
        level = durable(level.select(*keys, "path", is_object.alias("is_object"), plain.alias("value"), F.when(is_object, F.to_json("__v")).alias("__body")), "json-level")
        out.append(level.drop("__body"))
        inner = level.where("is_object").select(*keys, "path", F.parse_json("__body").alias("__body"))
        if inner.isEmpty():
            return reduce(DataFrame.union, out)
        view = f"json_level_{len(out)}"
        inner.createOrReplaceTempView(view)
        names = ", ".join(f"t.`{k}`" for k in keys)
        level = docs.sparkSession.sql(f"SELECT {names}, array_append(t.path, e.key) AS path, e.value AS __v FROM {view} t, LATERAL variant_explode(t.__body) e")


def diff_paths(old: DataFrame, new: DataFrame, keys: Sequence[str], doc: str, sensitive: Sequence[str] = ()) -> DataFrame:
    """keys, path, old_value, new_value, sensitive: dotted paths whose values differ, for documents that both sides have.

    Two objects are compared key by key, anything else as a whole; a key that isn't there equals null. Where an object meets something else
    the path is that of the object. A path is sensitive if one of its parts is listed.
    """
    mine = new.select(*keys).join(old.select(*keys), list(keys), "left_semi")
    sides = []
    for df, tag in ((old, "o"), (new, "n")):
        held = nodes(df.join(mine, list(keys), "left_semi"), keys, doc)
        sides.append(held.select(*keys, "path", F.col("is_object").alias(f"{tag}_object"), F.col("value").alias(f"{tag}_value")))
    both = durable(sides[0].join(sides[1], [*keys, "path"], "full_outer"), "json-pairs")
    yes = lambda c: F.coalesce(c, F.lit(False))
    objects = yes(F.col("o_object")) & yes(F.col("n_object"))
    above = both.where(objects).select(*keys, F.col("path").alias("__above"))
    differ = both.where(~objects & ((yes(F.col("o_object")) != yes(F.col("n_object"))) | ~F.col("o_value").eqNullSafe(F.col("n_value"))))
    differ = differ.withColumn("__above", F.expr("slice(path, 1, greatest(0, size(path) - 1))"))
    inner = differ.where(F.size("path") > 0).join(above, [*keys, "__above"], "left_semi")
    root = differ.where(F.size("path") == 0)
    marks = F.array(*[F.lit(s) for s in sensitive]).cast("array<string>")
    dotted: Column = F.when(F.size("path") == 0, F.lit(ROOT)).otherwise(F.array_join("path", "."))
    cols = [*keys, dotted.alias("path"), F.col("o_value").alias("old_value"), F.col("n_value").alias("new_value"), F.arrays_overlap("path", marks).alias("sensitive")]
    return inner.select(*cols).unionByName(root.select(*cols))


def version_paths(docs: DataFrame, keys: Sequence[str], version: str, doc: str, sensitive: Sequence[str] = ()) -> DataFrame:
    """The same for each version of a document against the version before; versions are numbered one by one."""
    before = docs.withColumn(version, F.col(version) + 1)
    return diff_paths(before, docs, [*keys, version], doc, sensitive)
