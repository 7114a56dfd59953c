"""Hilbert-curve sharding (DataFrame functions only).

Three metadata dimensions (document id, host, size) are quantised to ``BITS`` bits each, rows are ordered by their index
on the Hilbert curve through that cube, and the order is cut into runs. Neighbours on the curve are neighbours in every
dimension, so each run covers a small box and its min/max statistics prune files for filters on any of the three.

Ids and hosts are quantised by rank, so that no outlying id and no large host leaves the cube empty: an id's coordinate is
the 32nd part of all rows in which it lies, a host's the one in which its first row lies if rows are ordered by host. Size
counts by its power of two. Ranks and the order along the curve are running totals over ranges (``order.running``), so no task
sees all rows, all hosts or all of a cell, and ids may take all of the 64 bits.

Defined results: a null text has size 8 and CRC-32 0. Null doc_ids and null sources sort first, as values like others. Repeated
rows are ranked one behind the other. An empty table is empty. Columns other than doc_id, source and text are ignored by the
plan; ``write_shards`` keeps them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import durable
from .order import running

BITS, DIMS = 5, 3


def curve_table(dims: int = DIMS) -> list[int]:
    """Hilbert curve as a state machine: entry [state * 2**dims + octant] is digit * states + next state.

    A state is (entry corner e, direction d) as e * dims + d; built by the rule of gray codes and rotations.
    """
    n, size = dims, 1 << dims
    rot = lambda x, k: ((x << (k % n)) | (x >> (n - k % n))) & (size - 1) if k % n else x
    gray = lambda i: i ^ (i >> 1)
    ones = lambda i: (~i & (i + 1)).bit_length() - 1  # noqa: E731  trailing set bits
    inverse = {gray(i): i for i in range(size)}
    entry = lambda w: 0 if w == 0 else gray(2 * ((w - 1) // 2))
    turn = lambda w: 0 if w == 0 else ones(w - 1) % n if w % 2 == 0 else ones(w) % n
    table = []
    for state in range(size * n):
        e, d = divmod(state, n)
        for octant in range(size):
            w = inverse[rot(octant ^ e, n - (d + 1) % n)]
            table.append(w * size * n + (e ^ rot(entry(w), d + 1)) * n + (d + turn(w) + 1) % n)
    return table


def curve_index(coords: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of integer coordinates of ``bits`` bits."""
    n = len(coords)
    states = n << n
    table = F.array(*[F.lit(v) for v in curve_table(n)])

    def step(acc: Column, octant: Column) -> Column:
        v = F.get(table, acc["s"] * (1 << n) + octant)
        return F.struct((v % states).cast("int").alias("s"), (acc["h"] * (1 << n) + (v / states).cast("int")).cast("int").alias("h"))

    octants = F.array(*[sum((F.shiftright(c, b).bitwiseAND(1) * (1 << j) for j, c in enumerate(coords)), F.lit(0)) for b in range(bits - 1, -1, -1)])
    start = F.struct(F.lit(0).alias("s"), F.lit(0).alias("h"))
    return F.aggregate(octants, start, step, lambda a: a["h"])


def shard_rows(rows: DataFrame, n_shards: int = 24, law: str = "rows") -> DataFrame:
    """rows(doc_id, source, size, text_crc32) plus curve, shard and slot.

    law ``rows``: counts of shards differ by one at most. law ``bytes``: the order is cut at equal shares of size.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(law)
    side = 1 << BITS
    base = durable(rows.select("doc_id", "source", "size", "text_crc32", F.monotonically_increasing_id().alias("__row")), "metadata")
    ends = base.agg(F.count("*").alias("n"), F.sum("size").alias("b")).first()
    n = max(ends["n"], 1)
    first = lambda c: F.col(c).asc_nulls_first()
    rest = [first("doc_id"), first("source"), F.col("size"), F.col("text_crc32"), F.col("__row")]
    part = lambda rank: F.expr(f"cast({rank} * {side} div {n} as int)")

    hosts = durable(base.groupBy(F.col("source").alias("__host")).agg(F.count("*").alias("__c")), "hosts")
    hosts = running(hosts, [first("__host")], __before=F.col("__c")).select("__host", part("__before").alias("x_host"))
    placed = running(base, rest, __rank=F.lit(1)).withColumns({"x_id": part("__rank"), "x_size": F.least(F.length(F.bin("size")), F.lit(side - 1))})
    placed = placed.join(durable(hosts, "host-parts"), F.col("source").eqNullSafe(F.col("__host"))).drop("__host", "__rank")
    curved = durable(placed.withColumn("curve", curve_index([F.col("x_id"), F.col("x_host"), F.col("x_size")])), "curve")
    ranked = running(curved, [F.col("curve"), *rest], rank=F.lit(1), before=F.col("size")).drop("__row", "x_id", "x_host", "x_size")
    if law == "rows":
        ranked = ranked.withColumn("shard", F.expr(f"cast(rank * {n_shards} div {n} as int)"))
        return ranked.withColumn("slot", F.expr(f"rank - ((cast(shard as bigint) * {n} + {n_shards - 1}) div {n_shards})")).drop("before")
    ranked = durable(ranked.withColumn("shard", F.expr(f"cast(least(cast(before as decimal(38,0)) * {n_shards} div {ends['b'] or 1}, {n_shards - 1}) as int)")), "sharded")
    start = ranked.groupBy("shard").agg(F.min("rank").alias("__first"))  # a row a shard
    return ranked.join(F.broadcast(start), "shard").withColumn("slot", F.col("rank") - F.col("__first")).drop("__first", "before")


def metadata(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_crc32): all that sharding reads of a document."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))


def shard_bounds(sharded: DataFrame) -> DataFrame:
    """Per shard the box that its rows cover: what a reader needs to prune files."""
    cols = ("doc_id", "source", "size")
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), *[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("min", F.min), ("max", F.max))])


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, law: str = "rows") -> None:
    """Write whole documents, with all their columns, as n_shards folders ``shard=i``, rows in slot order.

    Rows find their place by doc_id, source, size and checksum, null values included, and repeated rows by their number.
    """
    keys = ("doc_id", "source", "size", "text_crc32")
    copy = lambda names: F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(0)))
    text = F.coalesce("text", F.lit(""))
    marked = docs.withColumns({"__doc_id": F.col("doc_id"), "__source": F.col("source"), "__size": (F.octet_length(text) + 8).cast("long"), "__text_crc32": F.crc32(F.encode(text, "UTF-8"))})
    marked = marked.withColumn("__n", copy([f"__{k}" for k in keys]))
    plan = shard_rows(metadata(docs), n_shards, law).select(*[F.col(k).alias(f"__p_{k}") for k in keys], F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))
    plan = plan.withColumn("__pn", copy([f"__p_{k}" for k in keys]))
    same = F.col("__n") == F.col("__pn")
    for k in keys:
        same = same & F.col(f"__{k}").eqNullSafe(F.col(f"__p_{k}"))
    whole = marked.join(plan, same).repartition(n_shards, "__shard").sortWithinPartitions("__shard", "__slot")
    whole.select(*docs.columns, F.col("__shard").alias("shard")).write.partitionBy("shard").parquet(path)


def op8(spark: SparkSession, docs: DataFrame) -> DataFrame:
    out = shard_rows(metadata(docs.select("doc_id", "source", "text")))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def oracle() -> str:
    """The same order in DuckDB: the curve's state machine unrolled over its levels; CRC-32 by its byte table."""
    table = ",".join(map(str, curve_table()))
    states, side = DIMS << DIMS, 1 << BITS
    levels, prev = [], "q"
    for k, b in enumerate(range(BITS - 1, -1, -1)):
        octant = " + ".join(f"((({c} >> {b}) & 1) << {j})" for j, c in enumerate(("x_id", "x_host", "x_size")))
        levels.append(
            f"l{k} AS (SELECT * EXCLUDE (s, h, v), (v % {states}) AS s, h * 8 + v // {states} AS h FROM "
            f"(SELECT *, (SELECT t FROM tbl)[s * 8 + ({octant}) + 1] AS v FROM {prev}))"
        )
        prev = f"l{k}"
    return f"""
WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(i))),
tbl AS (SELECT [{table}] AS t),
m AS (SELECT doc_id, source, octet_length(encode(coalesce(text, '')))::BIGINT + 8 AS size, hex(encode(coalesce(text, ''))) AS hx FROM documents),
c AS (SELECT doc_id, source, size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hx, '..'), lambda b: ('0x' || b)::BIGINT)),
   lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])))::BIGINT AS text_crc32 FROM m, crc),
e AS (SELECT count(*) AS n FROM m),
hosts AS (SELECT source, ((sum(k) OVER (ORDER BY source NULLS FIRST) - k)::BIGINT * {side} // n)::INT AS x_host FROM (SELECT source, count(*) AS k FROM m GROUP BY source), e),
q AS (SELECT c.*, x_host, ((row_number() OVER (ORDER BY doc_id NULLS FIRST, c.source NULLS FIRST, size, text_crc32) - 1) * {side} // n)::INT AS x_id, least(length(bin(size)), {side - 1})::INT AS x_size, 0 AS s, 0 AS h
      FROM c JOIN hosts ON c.source IS NOT DISTINCT FROM hosts.source, e),
{", ".join(levels)},
r AS (SELECT *, row_number() OVER (ORDER BY h, doc_id NULLS FIRST, source NULLS FIRST, size, text_crc32) - 1 AS rank FROM {prev}),
sh AS (SELECT r.*, (rank * 24 // n)::INT AS shard, n FROM r, e)
SELECT doc_id, size, text_crc32, 'rows' AS law, shard, (rank - ((shard::BIGINT * n + 23) // 24))::BIGINT AS slot, NULL::INT AS grown_shard FROM sh
"""
