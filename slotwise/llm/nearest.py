"""Approximate nearest neighbours by low-dimensional stable projections in a kd-tree.

Vectors are projected to `DIMENSIONS` random directions with normal entries. The squared distance
of two projections, divided by that of the vectors, then follows a chi-square distribution with
as many degrees of freedom. Candidates are verified in the order of their projected distance; when
that exceeds what the distribution allows, with probability `SURE`, to a vector as near as the k-th
best found, the search stops: any better one would have been seen with that probability.

The projections are dealt out by a kd-tree, whose cuts come from a sample of at most `SAMPLE`
vectors; every vector is indexed. Leaves are cut into parts of some `PART` vectors. A query first
goes to the `FIRST` leaves nearest to its projection. The k-th best distance found there bounds the
projected distance up to which leaves are then entered, each looked through in projected order.

Distances are taken on the original vectors in double precision. Recall is some points above `SURE`,
as nearer neighbours pass the test more easily.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slotwise.llm.common import batches, packed_rows, stored

DIMENSIONS, SURE, SAMPLE, LEAVES, PART, BLOCK, FIRST, STEP = 8, 0.95, 1 << 14, 256, 1024, 256, 4, 64


def chi_square(x: float, freedom: int = DIMENSIONS) -> float:
    """The distribution function of the chi-square distribution, for an even number of degrees."""
    term = total = math.exp(-x / 2)
    for i in range(1, freedom // 2):
        term *= x / 2 / i
        total += term
    return 1 - total


def limit_of(sure: float, freedom: int = DIMENSIONS) -> float:
    """Where the distribution function reaches `sure`."""
    low, high = 0.0, 1.0
    while chi_square(high, freedom) < sure:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, freedom) < sure else (low, mid)
    return high


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v): components as packed doubles. Without rows whose id is null or whose vector is null,
    empty, zero or holds a null, a NaN or an infinity."""

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            ids, bodies = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if i is None or not v.is_valid or v.values.null_count or not len(v.values):
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    bodies.append(x.tobytes())
            yield packed_rows(["id", "v"], [ids, bodies], [pa.int64(), pa.binary()])

    return vectors.select(F.col(id_column).cast("long"), vector_column).mapInArrow(pack, "id long, v binary")


def _matrix(bodies: list[bytes], width: int) -> np.ndarray:
    """Rows of equal width; shorter vectors end in zeros."""
    if all(len(b) == 8 * width for b in bodies):
        return np.frombuffer(b"".join(bodies), np.float64).reshape(-1, width)
    out = np.zeros((len(bodies), width))
    for r, b in enumerate(bodies):
        out[r, : len(b) // 8] = np.frombuffer(b, np.float64)
    return out


class Tree:
    """Cuts at medians of the widest direction. Leaves are numbered; each is a box without bounds
    where nothing was cut."""

    def __init__(self, points: np.ndarray, most: int) -> None:
        self.nodes: list[tuple[int, float, int, int]] = []  # direction, cut, children; a leaf is ~number
        low, high = np.full(points.shape[1], -np.inf), np.full(points.shape[1], np.inf)
        boxes: list[tuple[np.ndarray, np.ndarray]] = []

        def grow(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> int:
            spread = rows.max(0) - rows.min(0) if len(rows) > most else np.zeros(1)
            way = int(spread.argmax())
            cut = float(np.median(rows[:, way])) if spread[way] > 0 else 0.0
            left = rows[:, way] <= cut
            if spread[way] <= 0 or left.all():
                boxes.append((low, high))
                return ~(len(boxes) - 1)
            own = len(self.nodes)
            self.nodes.append((way, cut, 0, 0))
            upto, beyond = high.copy(), low.copy()
            upto[way] = beyond[way] = cut
            a, b = grow(rows[left], low, upto), grow(rows[~left], beyond, high)
            self.nodes[own] = (way, cut, a, b)
            return own

        self.root = grow(points, low, high)
        self.low, self.high = np.array([b[0] for b in boxes]), np.array([b[1] for b in boxes])

    def __len__(self) -> int:
        return len(self.low)

    def leaf(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int32)

        def down(node: int, rows: np.ndarray) -> None:
            if node < 0:
                out[rows] = ~node
            elif len(rows):
                way, cut, a, b = self.nodes[node]
                left = points[rows, way] <= cut
                down(a, rows[left])
                down(b, rows[~left])

        down(self.root, np.arange(len(points)))
        return out

    def far(self, points: np.ndarray) -> np.ndarray:
        """Squared distances of points from the boxes (points x leaves)."""
        out = np.zeros((len(points), len(self)))
        for d in range(points.shape[1]):
            x = points[:, d, None]
            out += np.maximum(0, np.maximum(self.low[:, d] - x, x - self.high[:, d])) ** 2
        return out


def _search(q: np.ndarray, at: np.ndarray, own: int, bound: float, ids: np.ndarray, rows: np.ndarray, places: np.ndarray, k: int, limit: float):
    """(ids, distances) of the k best rows of a part for one query, nearer ones by their projections
    first, up to where the chi-square test ends the search. `bound` is the k-th best elsewhere."""
    projected = np.sqrt(((places - at) ** 2).sum(1))
    order = np.argsort(projected, kind="stable")
    found_ids, found = np.zeros(0, np.int64), np.zeros(0)
    for begin in range(0, len(order), STEP):
        some = order[begin : begin + STEP]
        if projected[some[0]] > limit * bound:
            break
        some = some[(projected[some] <= limit * bound) & (ids[some] != own)]
        found_ids = np.concatenate((found_ids, ids[some]))
        found = np.concatenate((found, np.sqrt(((rows[some] - q) ** 2).sum(1))))
        best = np.lexsort((found, found_ids))
        best = best[np.append(True, found_ids[best][1:] != found_ids[best][:-1])] if len(best) else best  # an id counts once
        best = best[np.lexsort((found_ids[best], found[best]))][:k]
        found_ids, found = found_ids[best], found[best]
        if len(found) == k:
            bound = min(bound, found[-1])
    return found_ids, found


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding", sure: float = SURE
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where `is_query` (over `id`) holds the k nearest
    other ids found, by Euclidean distance, ties to the smaller id; all, if there are fewer.

    Rows without id and vectors that are null, empty, zero or hold a null or non-finite component
    take no part; shorter vectors end in zeros. Rows that repeat an id are one candidate, as near
    as the nearest of them, and one query.
    """
    spark = vectors.sparkSession
    batches(spark, BLOCK)
    rows = stored(usable(vectors, id_column, vector_column).distinct(), "vectors")
    width = rows.agg(F.max(F.length("v"))).first()[0]
    schema = "query_id long, rank int, vec_id long, score double"
    if width is None:
        return spark.createDataFrame([], schema)
    width //= 8
    directions = np.random.default_rng(12).normal(size=(width, DIMENSIONS))
    limit = math.sqrt(limit_of(sure)) * (1 + 1e-9)  # of projected by true distance; the margin is for rounding

    def project(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            at = _matrix(batch.column(0).to_pylist(), width) @ directions
            yield packed_rows(["at"], [[r.tobytes() for r in at]], [pa.binary()])

    drawn = rows.select("id", "v").orderBy(F.xxhash64("id", "v"), "id", "v").limit(SAMPLE).select("v")
    points = _matrix(drawn.mapInArrow(project, "at binary").toArrow()["at"].to_pylist(), DIMENSIONS)
    tree = spark.sparkContext.broadcast(Tree(points, max(1, len(points) // LEAVES)))

    def place(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            leaf = tree.value.leaf(_matrix(batch.column(1).to_pylist(), width) @ directions)
            yield packed_rows(["id", "v", "leaf"], [batch.column(0), batch.column(1), leaf], [pa.int64(), pa.binary(), pa.int32()])

    placed = stored(rows.mapInArrow(place, "id long, v binary, leaf int"), "leaves")
    sizes = np.zeros(len(tree.value), np.int64)
    for r in placed.groupBy("leaf").count().collect():  # at most some LEAVES rows
        sizes[r["leaf"]] = r["count"]
    parts = np.maximum(1, -(-sizes // PART))
    number = F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("leaf") + 1)
    stock = placed.withColumn("part", F.pmod(F.xxhash64("id", "v"), number).cast("int"))
    stock = stored(stock.groupBy("leaf", "part").agg(F.collect_list("id").alias("ids"), F.collect_list("v").alias("vs")), "parts")

    names = ["leaf", "part", "queries", "qv", "known"]
    types = [pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.float64())]

    def visits(again: bool):
        """Rows (part of a leaf, block of queries that go there)."""

        def plan(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches_in:
                query, bodies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                far = tree.value.far(_matrix(bodies, width) @ directions)
                bound = batch.column(2).to_numpy(zero_copy_only=False) if again else np.full(len(query), np.inf)
                first = np.zeros(far.shape, bool)
                np.put_along_axis(first, np.argsort(far, axis=1, kind="stable")[:, :FIRST], True, 1)
                going = ~first & (np.sqrt(far) <= limit * bound[:, None]) if again else first
                for leaf in np.flatnonzero(going.any(0)):
                    some = np.flatnonzero(going[:, leaf])
                    if sizes[leaf]:
                        row = [[query[i] for i in some], [bodies[i] for i in some], bound[some].tolist()]
                        n = int(parts[leaf])
                        for a in range(0, n, 16):
                            some_parts = list(range(a, min(n, a + 16)))
                            yield packed_rows(names, [[leaf] * len(some_parts), some_parts, *[[c] * len(some_parts) for c in row]], types)

        return plan

    def look(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            for queries, qv, known, ids, vs in zip(*batch.columns, strict=True):
                stock_rows, q = _matrix(vs.as_py(), width), _matrix(qv.as_py(), width)
                places, at, ids = stock_rows @ directions, q @ directions, ids.values.to_numpy()
                out = []
                for i, (own, bound) in enumerate(zip(queries.as_py(), known.as_py(), strict=True)):
                    some, distance = _search(q[i], at[i], own, bound, ids, stock_rows, places, k, limit)
                    out.append((np.full(len(some), own), some, distance))
                yield packed_rows(["query_id", "vec_id", "score"], [np.concatenate(c) for c in zip(*out, strict=True)], [pa.int64(), pa.int64(), pa.float64()])

    def wave(queries: DataFrame, again: bool) -> DataFrame:
        asked = queries.mapInArrow(visits(again), "leaf int, part int, queries array<long>, qv array<binary>, known array<double>")
        met = asked.join(stock, ["leaf", "part"]).select("queries", "qv", "known", "ids", "vs")
        return met.mapInArrow(look, "query_id long, vec_id long, score double")

    def ranked(found: DataFrame) -> DataFrame:
        found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    queries = placed.where(is_query).sortWithinPartitions("leaf")
    first = stored(ranked(wave(queries.select("id", "v"), False)), "first")
    bound = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("known"))
    every = F.coalesce("known", F.lit(float("inf")))
    asked = queries.join(bound, "id", "left").select("id", "v", "leaf", every.alias("known")).sortWithinPartitions("leaf")
    second = wave(asked.select("id", "v", "known"), True)
    out = ranked(first.select("query_id", "vec_id", "score").union(second))
    return out.select("query_id", "rank", "vec_id", "score")
