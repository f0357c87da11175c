"""Approximate nearest neighbours by a hash-prefix forest.

A tree gives every vector a long string of bits, the sides of random hyperplanes it lies on, and is the array of these strings in
sorted order. Vectors that share a long prefix are likely to be near. A query descends in every tree to its longest
matching prefix, then ascends in all trees at once, to shorter and shorter prefixes, until the vectors met are enough.

The index is a table of segments of ``SEGMENT`` vectors, each with its sorted arrays, so no array grows with the data. The depth a
query ascends to is decided from the counts of all segments together. Queries run in blocks against all segments, which are
read in place: vectors are never shuffled, and no pair of a query and a candidate leaves the task that scores it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattloom.llm.common import stored

TREES = 48
BITS = 24
SEGMENT = 8192
NEIGHBOURS = 5
QUERY_EVERY = 50
QUERY_BLOCK = 4096
# Vectors a query meets before it stops ascending: SPREAD * rows ** GROWTH.
SPREAD, GROWTH = 8.0, 0.75
SEED = 5

INDEX = "dim int, n int, vec_ids binary, vectors binary, strings binary, orders binary"


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that take part: an id, and an embedding without nulls, NaN or infinities that is not zero."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & some)


def planes(dim: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """The hyperplanes of all trees, the same in every task."""
    return np.random.default_rng([SEED, dim]).normal(size=(dim, trees * bits))


def strings(vectors: np.ndarray, normals: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """Vectors x trees: bit strings as numbers, the first plane in the highest bit."""
    sides = (vectors @ normals > 0).reshape(len(vectors), trees, bits)
    return (sides * (1 << np.arange(bits - 1, -1, -1))).sum(axis=2).astype(np.uint32)


def build(vectors: DataFrame, trees: int = TREES, bits: int = BITS, segment: int = SEGMENT) -> DataFrame:
    """The index: one row for each dimension and segment of a task's vectors."""

    def pack(dim: int, ids: list[int], rows: list[np.ndarray]) -> pa.RecordBatch:
        x = np.stack(rows)
        normals = planes(dim, trees, bits)
        keys = strings(x / np.abs(x).max(axis=1, keepdims=True), normals, trees, bits).T
        order = np.argsort(keys, axis=1, kind="stable").astype(np.uint32)
        row = [dim, len(ids), np.array(ids, np.int64).tobytes(), x.tobytes(), np.take_along_axis(keys, order, 1).tobytes(), order.tobytes()]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], [c.split()[0] for c in INDEX.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(batch.column(1).value_lengths().to_numpy(zero_copy_only=False))
            for vec_id, row in zip(batch.column(0).to_pylist(), np.split(flat, ends[:-1]), strict=True):
                ids, rows = held.setdefault(len(row), ([], []))
                ids.append(vec_id)
                rows.append(row)
                if len(ids) == segment:
                    yield pack(len(row), *held.pop(len(row)))
        for dim, (ids, rows) in held.items():
            yield pack(dim, ids, rows)

    return usable(vectors).mapInArrow(run, INDEX)


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, component after component, so equal vectors get equal products anywhere."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[..., k]
    return total


class Segment:
    """One row of the index, opened."""

    def __init__(self, row: dict, trees: int, bits: int):
        self.n, self.bits = row["n"], bits
        self.ids = np.frombuffer(row["vec_ids"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(self.n, row["dim"])
        self.strings = np.frombuffer(row["strings"], np.uint32).reshape(trees, self.n)
        self.orders = np.frombuffer(row["orders"], np.uint32).reshape(trees, self.n)

    def range(self, tree: int, keys: np.ndarray, depth: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Where the strings stand that share the first ``depth`` bits with the keys."""
        rest = self.bits - np.asarray(depth)
        low = (keys.astype(np.int64) >> rest) << rest
        high = low + (np.int64(1) << rest)
        return np.searchsorted(self.strings[tree], low.astype(np.uint32)), np.searchsorted(self.strings[tree], high.astype(np.int64))

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Queries x depths: how many strings of all trees share so many bits, from the whole array down to the longest match."""
        out = np.zeros((len(keys), self.bits + 1), np.int64)
        out[:, 0] = self.n * keys.shape[1]
        for tree in range(keys.shape[1]):
            alive = np.arange(len(keys))
            for depth in range(1, self.bits + 1):
                low, high = self.range(tree, keys[alive, tree], depth)
                out[alive, depth] += high - low
                alive = alive[high > low]
                if not len(alive):
                    break
        return out

    def candidates(self, keys: np.ndarray, depth: np.ndarray) -> Iterator[np.ndarray]:
        """For each query the rows that share its first ``depth`` bits in any tree."""
        low, high = np.zeros(keys.shape, np.int64), np.full(keys.shape, self.n)
        for tree in range(keys.shape[1]):
            low[:, tree], high[:, tree] = self.range(tree, keys[:, tree], depth)
        for q in range(len(keys)):
            met = np.zeros(self.n, bool)
            for tree in np.flatnonzero(high[q] > low[q]):
                met[self.orders[tree, low[q, tree] : high[q, tree]]] = True
            yield np.flatnonzero(met)

    def nearest(self, rows: np.ndarray, query: np.ndarray, own: int, norms: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The best of the candidates: (cosines, ids), nearest first, ties to the smaller id."""
        rows = rows[self.ids[rows] != own]
        if not len(rows):
            return np.empty(0), np.empty(0, np.int64)
        size = math.sqrt(float(added(query[None], query)[0]))
        rough = (self.vectors[rows] @ query) / (norms[rows] * size)
        if len(rows) > k:
            rows = rows[rough >= np.partition(rough, -k)[-k] - 1e-9]
        score = added(self.vectors[rows], query) / (norms[rows] * size)
        best = np.lexsort((self.ids[rows], -score))[:k]
        return score[best], self.ids[rows[best]]


def _opened(batches: Iterator[pa.RecordBatch], trees: int, bits: int) -> Iterator[Segment]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Segment({n: batch.column(n)[i].as_py() for n in batch.schema.names}, trees, bits)


def search(index: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, trees: int = TREES, bits: int = BITS, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for every usable query, itself left out.

    Nearness is the cosine of the original vectors in double precision. Queries of other dimensions than a vector's do not
    meet it. Repeated ids are rows of their own; a query never finds a row with its own id.
    """
    spark = index.sparkSession
    sizes = {r["dim"]: r["n"] for r in index.groupBy("dim").agg(F.sum("n").alias("n")).collect()}  # a row for each dimension
    asked = stored(usable(queries).dropDuplicates(["vec_id"]).withColumn("__dim", F.size("embedding")), "queries")
    schema = "query_id long, vec_id long, score double"
    found = None
    for dim, total in sorted(sizes.items()):
        # at least k others besides the query itself, however often the same ones are met
        wanted = max(SPREAD * total**GROWTH, (k + 1) * trees)
        rows = index.where(F.col("dim") == dim)
        mine = asked.where(F.col("__dim") == dim)
        n = mine.count()
        for b in range(-(-n // block)):
            some = mine.where(F.pmod(F.xxhash64("vec_id"), F.lit(-(-n // block))) == b).orderBy("vec_id").select("vec_id", "embedding").toArrow()
            if not some.num_rows:
                continue
            ids = some.column(0).to_numpy()
            x = np.array(some.column(1).combine_chunks().flatten()).reshape(len(ids), dim)
            keys = strings(x / np.abs(x).max(axis=1, keepdims=True), planes(dim, trees, bits), trees, bits)
            shared = spark.sparkContext.broadcast((ids, x, keys))  # a block of queries: bounded

            def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                ids, _, keys = shared.value
                total = np.zeros((len(ids), bits + 1), np.int64)
                for segment in _opened(batches, trees, bits):
                    total += segment.counts(keys)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(ids)))] + [pa.array(total[:, d]) for d in range(bits + 1)], ["q"] + [f"d{d}" for d in range(bits + 1)])

            columns = ", ".join(f"d{d} long" for d in range(bits + 1))
            met = rows.mapInArrow(count, f"q long, {columns}").groupBy("q").agg(*[F.sum(f"d{d}").alias(f"d{d}") for d in range(bits + 1)])
            table = met.orderBy("q").toArrow()
            counts = np.stack([table.column(f"d{d}").to_numpy() for d in range(bits + 1)], axis=1)
            # ascend in all trees at once: the deepest level at which enough vectors are met
            enough = counts >= min(wanted, total * trees)
            depth = bits - np.argmax(enough[:, ::-1], axis=1)
            asked_here = spark.sparkContext.broadcast((ids, x, keys, depth))

            def score(batches: Iterator[pa.RecordBatch], shared=asked_here) -> Iterator[pa.RecordBatch]:
                ids, x, keys, depth = shared.value
                best: list[list[tuple[float, int]]] = [[] for _ in ids]
                for segment in _opened(batches, trees, bits):
                    norms = np.sqrt(added(segment.vectors, segment.vectors))
                    for q, met in enumerate(segment.candidates(keys, depth)):
                        scores, found = segment.nearest(met, x[q], ids[q], norms, k)
                        if len(found):
                            best[q] = sorted(best[q] + list(zip((-scores).tolist(), found.tolist(), strict=True)))[:k]
                out = [(i, v, -s) for i, rows in zip(ids.tolist(), best, strict=True) for s, v in rows]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

            part = rows.mapInArrow(score, schema)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], schema)
    # at most k rows of a query from each task
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


# Every pair of a query and another vector: what the forest finds at full recall.
ORACLE = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT vec_id, x, sqrt(list_inner_product(x, x)) AS size FROM v),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(c.x, q.x) / (c.size * q.size) AS score
      FROM u q JOIN u c ON q.vec_id <> c.vec_id WHERE q.vec_id % {QUERY_EVERY} = 0 AND q.size > 0 AND c.size > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {NEIGHBOURS}
"""


def neighbours(vectors: DataFrame, every: int = QUERY_EVERY) -> DataFrame:
    """The nearest neighbours of the vectors whose id is divisible by ``every`` among all vectors."""
    index = stored(build(vectors), "forest")
    return search(index, vectors.where(F.col("vec_id") % every == 0))
