"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer numpy network.

1. Random indexing over all documents: every word bucket owns a fixed sparse ternary index vector; a bucket's context
   vector is the sum of the index vectors of the words up to ``REACH`` places away. Tasks sum what they see, Spark sums the
   tasks (one row per bucket and task). The result has BUCKETS x DIMS numbers at any corpus size and is broadcast.
2. Pooling: mean and spread of the unit context vectors of a document's words, plus the logarithm of its word count.
3. A tanh network with one hidden layer, fitted on at most ``TRAIN_ROWS`` labelled documents (those of smallest hash),
   and a temperature fitted on a fifth of them that the weights never saw.

Labels, language, source and doc_id are no inputs. Defined results: null and empty texts pool to zeros and get the score
that the network gives those. Labels that are null or belong to no document are ignored; a document with several labels is
several examples, and so is a labelled doc_id with several texts. Empty tables give empty results. Repeated rows get equal scores.
Further columns, of whatever name, are ignored. Texts of any length are pooled whole. Without labels of both kinds every score is the share of label 1 (0.5 without any). Rows without doc_id
are scored and never held out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable
from . import kernel
from .common import table

BUCKETS, DIMS, REACH, NONZERO = 8192, 32, 2, 4
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 128, 3e-3, 1e-4
TRAIN_ROWS = 20_000
FEATURES = 2 * DIMS + 1


def index_vectors() -> np.ndarray:
    """Sparse ternary vectors by rule: NONZERO places with random signs for each bucket."""
    r = kernel._splitmix(BUCKETS * NONZERO, 99).reshape(BUCKETS, NONZERO)
    out = np.zeros((BUCKETS, DIMS), np.float32)
    sign = np.where((r >> np.uint64(40)) & np.uint64(1), 1.0, -1.0).astype(np.float32)
    np.add.at(out, (np.arange(BUCKETS)[:, None], (r % np.uint64(DIMS)).astype(np.int64)), sign)
    return out


def buckets_of(d: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word, and the offsets by document."""
    starts, ends, by_doc = kernel.words(d, o)
    return (kernel.hash_spans(d, starts, ends, 5) % np.uint64(BUCKETS)).astype(np.int64), by_doc


def context_sums(docs: DataFrame) -> np.ndarray:
    """Context vectors of all buckets over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(), np.zeros((BUCKETS, DIMS), np.float64)
        for b in batches:
            for _, _, d, o in kernel.chunks(*kernel.utf8(b.column("text"))):
                word, by_doc = buckets_of(d, o)
                if not len(word):
                    continue
                doc = np.repeat(np.arange(len(by_doc) - 1), np.diff(by_doc))
                near = np.zeros((len(word), DIMS), np.float32)
                for k in range(1, REACH + 1):
                    if len(word) > k:
                        same = (doc[k:] == doc[:-k])[:, None]
                        near[k:] += index[word[:-k]] * same
                        near[:-k] += index[word[k:]] * same
                order = np.argsort(word, kind="stable")
                first = np.flatnonzero(np.diff(word[order], prepend=-1))
                total[word[order][first]] += np.add.reduceat(near[order], first, axis=0)
        used = np.flatnonzero(total.any(axis=1))
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), *[pa.array(total[used, k].astype(np.float32)) for k in range(DIMS)]], ["bucket", *[f"v{k}" for k in range(DIMS)]])

    schema = "bucket long, " + ", ".join(f"v{k} float" for k in range(DIMS))
    sums = docs.select("text").mapInArrow(run, schema).groupBy("bucket").agg(*[F.sum(f"v{k}").alias(f"v{k}") for k in range(DIMS)])
    out = np.zeros((BUCKETS, DIMS))
    for r in sums.collect():  # BUCKETS rows at most
        out[r[0]] = r[1:]
    return out


def unit_vectors(sums: np.ndarray) -> np.ndarray:
    """Context vectors of length one, around their common centre."""
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    unit = np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0)
    seen = norm[:, 0] > 0
    if seen.any():
        unit[seen] -= unit[seen].mean(axis=0)
    return unit.astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray) -> DataFrame:
    """(doc_id, x array<float>): the pooled features of every document."""
    held = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = held.value
        for b in batches:
            x = np.zeros((b.num_rows, FEATURES), np.float32)
            for i, j, d, o in kernel.chunks(*kernel.utf8(b.column("text"))):
                word, by_doc = buckets_of(d, o)
                n = np.diff(by_doc)
                full = np.flatnonzero(n)
                if not len(full):
                    continue
                v, count = unit[word], n[full][:, None]
                mean = np.add.reduceat(v, by_doc[full], axis=0) / count
                square = np.add.reduceat(v * v, by_doc[full], axis=0) / count
                x[i + full] = np.hstack([mean, np.sqrt(np.maximum(square - mean**2, 0)), np.log1p(count) / 8])
            flat = pa.array(x.reshape(-1))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, FEATURES, dtype=np.int32)), flat)], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, x array<float>")


class Network:
    """Two layers: standardised inputs, tanh, one output; ``temperature`` divides the logit."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 13):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        self.w1 = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN))
        self.w2 = rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN)
        self.b1, self.b2, self.temperature = np.zeros(HIDDEN), np.array(0.0), 1.0
        turn = rng.permutation(len(x))
        aside, rest = turn[: len(x) // 5], turn[len(x) // 5 :]
        self._fit((x[rest] - self.mean) / self.scale, y[rest], rng)
        self._calibrate(x[aside], y[aside])

    def _fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        names = ("w1", "b1", "w2", "b2")
        m, v, step = {k: 0.0 for k in names}, {k: 0.0 for k in names}, 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            for a in range(0, len(x), BATCH):
                at = order[a : a + BATCH]
                hid = np.tanh(x[at] @ self.w1 + self.b1)
                err = (1 / (1 + np.exp(-(hid @ self.w2 + self.b2))) - y[at]) / len(at)
                back = np.outer(err, self.w2) * (1 - hid**2)
                grads = {"w1": x[at].T @ back + DECAY * self.w1, "b1": back.sum(0), "w2": hid.T @ err + DECAY * self.w2, "b2": err.sum()}
                step += 1
                rate = RATE * (1 - epoch / EPOCHS)
                for k in names:
                    m[k] = 0.9 * m[k] + 0.1 * grads[k]
                    v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
                    setattr(self, k, getattr(self, k) - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature of least log loss on rows that the weights never saw."""
        if len(x):
            z = self.logit(x)
            loss = lambda t: np.mean(np.logaddexp(0, z / t) - y * z / t)
            self.temperature = float(min(np.exp(np.linspace(-2, 3, 101)), key=loss))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


class Constant:
    """Where there is nothing to tell apart."""

    def __init__(self, share: float):
        self.share = share

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.share)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def train(features: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Network | Constant:
    """Fit on at most ``rows`` labelled documents that are not held out, those of smallest hash; labels of no document take no place."""
    marks = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).select(F.col("doc_id").alias("__id"), F.col("quality").cast("double").alias("y"))
    order = [F.col("h"), F.col("__id"), F.col("y"), F.col("xh")]
    # labelled documents are joined without their features first: the bounded sample then takes the features of its own rows
    ids = features.select("doc_id", F.xxhash64("x").alias("xh"))
    picked = marks.join(ids, F.col("doc_id") == F.col("__id")).select("__id", "y", "xh", F.xxhash64("__id", "y").alias("h")).orderBy(*order).limit(rows)
    known = features.withColumn("__xh", F.xxhash64("x")).join(F.broadcast(picked), (F.col("doc_id") == F.col("__id")) & (F.col("__xh") == F.col("xh"))).orderBy(*order).limit(rows).select("x", "y").collect()
    y = np.array([r["y"] for r in known])
    if len(y) < 10 or y.min() == y.max():
        return Constant(float(y.mean()) if len(y) else 0.5)
    return Network(np.array([r["x"] for r in known], dtype=np.float64), y)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    features = durable(pooled(docs, unit_vectors(context_sums(docs))), "pooled")
    model = docs.sparkSession.sparkContext.broadcast(train(features, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy().reshape(-1, FEATURES).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.value.score(x))], ["doc_id", "score"])

    out = features.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
