"""Exact top-k search by inner product with a pivot-distance index.

Components x become floor(256 * x). To have distances that follow the inner product, a vector x
gets one more component, sqrt(M² - |x|²), M being the greatest norm; queries get a zero. Then
|q - x|² = |q|² + M² - 2 q·x.

Index: every vector is keyed by its nearest pivot and by its distance from it, in rings between
fixed distances (annuli). Search: a query's distance d from a pivot bounds its distance from all
vectors of a ring [lo, hi] of that pivot, by the triangle inequality: at least lo - d and d - hi. A first wave takes
each query to the rings next to it; the k-th best score found there is a bound, and the second
wave expands to all rings that the bound does not exclude. Rings are cut into parts of some `PART`
vectors and queries into blocks, and a block meets a part once.

Pivots and distances between rings come from a sample of at most `SAMPLE` vectors; all vectors
are indexed. Bounds have a margin for rounding, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import batches, packed_rows, stored

SAMPLE, PIVOTS, RINGS, PART, BLOCK, FIRST = 2048, 32, 16, 512, 64, 3


def scaled(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v, norm): components as packed doubles, |v|². Without rows whose id or vector is null or
    empty or whose vector holds a null, a NaN or an infinity."""

    def floor(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids, bodies, norms = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if i is None or not v.is_valid or v.values.null_count or not len(v.values):
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all():
                    x = np.floor(256 * x)
                    ids.append(i)
                    bodies.append(x.tobytes())
                    norms.append(float(x @ x))
            yield packed_rows(["id", "v", "norm"], [ids, bodies, norms], [pa.int64(), pa.binary(), pa.float64()])

    return vectors.select(F.col(id_column).cast("long"), vector_column).mapInArrow(floor, "id long, v binary, norm double")


def _matrix(bodies: list[bytes], width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    if all(len(b) == 8 * width for b in bodies):
        return np.frombuffer(b"".join(bodies), np.float64).reshape(-1, width)
    out = np.zeros((len(bodies), width))
    for r, b in enumerate(bodies):
        out[r, : len(b) // 8] = np.frombuffer(b, np.float64)
    return out


class Index:
    """Pivots, distances between rings, and the greatest norm: all that queries and tasks share."""

    def __init__(self, sample: np.ndarray, norm: float) -> None:
        self.norm = norm
        rows = self.lifted(sample)
        chosen, far = [0], np.linalg.norm(rows - rows[0], axis=1)
        while len(chosen) < min(PIVOTS, len(rows)) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, np.linalg.norm(rows - rows[chosen[-1]], axis=1))
        self.pivots = rows[chosen]
        cell, distance = self.key(rows)
        self.edges = np.zeros((len(self.pivots), RINGS - 1))
        for c in range(len(self.pivots)):
            self.edges[c] = np.quantile(distance[cell == c], np.linspace(0, 1, RINGS + 1)[1:-1])
        self.low = np.column_stack((np.zeros(len(self.edges)), self.edges))
        self.high = np.column_stack((self.edges, np.full(len(self.edges), np.inf)))
        self.margin = 1e-6 * (1 + norm)

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack((rows, np.sqrt(np.maximum(0, self.norm - (rows * rows).sum(1)))))

    def distances(self, rows: np.ndarray) -> np.ndarray:
        square = (rows * rows).sum(1)[:, None] + (self.pivots * self.pivots).sum(1) - 2 * rows @ self.pivots.T
        return np.sqrt(np.maximum(0, square))

    def key(self, lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = self.distances(lifted)
        return far.argmin(1), far.min(1)

    def ring(self, cell: np.ndarray, distance: np.ndarray) -> np.ndarray:
        return (distance[:, None] >= self.edges[cell]).sum(1)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The least distance of each query from each ring (queries x cells x rings)."""
        far = self.distances(np.column_stack((queries, np.zeros(len(queries)))))[:, :, None]
        return np.maximum(0, np.maximum(self.low - far, far - self.high))

    def reach(self, queries: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance beyond which no vector scores as much."""
        return np.sqrt(np.maximum(0, (queries * queries).sum(1) + self.norm - 2 * score)) + self.margin


def top(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where `is_query` holds the k greatest inner
    products with other ids, ties to the smaller id; all, if there are fewer.

    Rows without id, and vectors that are null, empty or hold a null or an infinite component take
    no part; shorter vectors end in zeros. Rows that repeat an id are one candidate with the
    greatest of their scores.
    """
    spark = vectors.sparkSession
    batches(spark, 64)
    rows = stored(scaled(vectors, id_column, vector_column).distinct(), "vectors")
    norm, width = rows.agg(F.max("norm"), F.max(F.length("v"))).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if norm is None:
        return spark.createDataFrame([], schema)
    width //= 8
    drawn = rows.orderBy(F.xxhash64("id", "v"), "id", "v").limit(SAMPLE).toArrow()
    index = spark.sparkContext.broadcast(Index(_matrix(drawn["v"].to_pylist(), width), float(norm)))
    drawn = drawn.sort_by("id")
    sample = spark.sparkContext.broadcast((drawn["id"].to_numpy(), _matrix(drawn["v"].to_pylist(), width)))

    def place(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            cell, far = index.value.key(index.value.lifted(_matrix(batch.column(1).to_pylist(), width)))
            yield packed_rows(
                ["id", "v", "cell", "ring"], [batch.column(0), batch.column(1), cell, index.value.ring(cell, far)],
                [pa.int64(), pa.binary(), pa.int32(), pa.int32()],
            )

    placed = rows.select("id", "v").mapInArrow(place, "id long, v binary, cell int, ring int")
    sizes = np.zeros((PIVOTS, RINGS), np.int64)  # at most PIVOTS * RINGS rows
    for r in placed.groupBy("cell", "ring").count().collect():
        sizes[r["cell"], r["ring"]] = r["count"]
    parts = np.maximum(1, -(-sizes // PART))
    flat = F.array(*[F.lit(int(p)) for p in parts.ravel()])
    own = F.element_at(flat, F.col("cell") * RINGS + F.col("ring") + 1)
    stock = placed.withColumn("part", F.pmod(F.xxhash64("id", "v"), own).cast("int"))
    stock = stock.groupBy("cell", "ring", "part").agg(F.collect_list("id").alias("ids"), F.collect_list("v").alias("vs"))
    stock = stored(stock, "annuli")

    names = ["cell", "ring", "part", "queries", "qv", "known"]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.float64())]

    def visits(known: bool):
        """Rows (ring part, block of queries that go there) of a wave, next queries together."""

        def plan(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, (ids, others) = index.value, sample.value
            fresh = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            for batch in batches_in:
                query, bodies = batch.column(0).to_numpy(), batch.column(1).to_pylist()
                q = _matrix(bodies, width)
                score = q @ others.T
                score[ids[None, :] == query[:, None]] = -np.inf
                score = np.maximum.reduceat(score, fresh, axis=1)  # an id counts once
                seed = np.sort(score, axis=1)[:, -k] if score.shape[1] >= k else np.full(len(q), -np.inf)
                if known:
                    seed = np.maximum(seed, batch.column(2).fill_null(-np.inf).to_numpy(zero_copy_only=False))
                bound = own.bounds(q)
                near = bound.reshape(len(q), -1)
                first = np.zeros(near.shape, bool)
                np.put_along_axis(first, np.argsort(near, axis=1, kind="stable")[:, : FIRST * 2], True, 1)
                going = near <= own.reach(q, seed)[:, None]
                going = going & ~first if known else going & first
                out = []
                for r in np.flatnonzero(going.any(0)):
                    some = np.flatnonzero(going[:, r])
                    c, g = divmod(int(r), RINGS)
                    if sizes[c, g]:
                        for p in range(parts[c, g]):
                            out.append((c, g, p, query[some].tolist(), [bodies[i] for i in some], seed[some].tolist()))
                for i in range(0, len(out), 64):
                    yield packed_rows(names, [list(x) for x in zip(*out[i : i + 64], strict=True)], types)

        return plan

    def best(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            for queries, qv, known, ids, vs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                ids = np.array(ids)
                score = _matrix(qv, width) @ _matrix(vs, width).T
                score[ids[None, :] == np.array(queries)[:, None]] = -np.inf
                q, c = np.nonzero(score >= np.array(known)[:, None])
                order = np.lexsort((ids[c], -score[q, c], q))
                q, c = q[order], c[order]
                _, once = np.unique(np.column_stack((q, ids[c])), axis=0, return_index=True)
                once.sort()  # the greatest score of each id
                q, c = q[once], c[once]
                rank = np.arange(len(q)) - np.searchsorted(q, q)
                keep = (rank < k) & np.isfinite(score[q, c])
                yield packed_rows(
                    ["query_id", "vec_id", "score"],
                    [np.array(queries)[q[keep]], ids[c[keep]], score[q[keep], c[keep]].astype(np.int64)],
                    [pa.int64()] * 3,
                )

    def wave(queries: DataFrame, known: bool) -> DataFrame:
        asked = queries.mapInArrow(
            visits(known), "cell int, ring int, part int, queries array<long>, qv array<binary>, known array<double>"
        )
        met = asked.join(stock, ["cell", "ring", "part"]).select("queries", "qv", "known", "ids", "vs")
        return met.mapInArrow(best, "query_id long, vec_id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    asked = rows.where(is_query).select("id", "v").dropDuplicates(["id", "v"])
    first = stored(ranked(wave(asked, False)), "first")
    bound = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("least"))
    second = wave(asked.join(bound, "id", "left").select("id", "v", "least"), True)
    out = ranked(first.select("query_id", "vec_id", "score").union(second))
    return out.select("query_id", "rank", "vec_id", "score")
