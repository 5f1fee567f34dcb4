"""Approximate neighbours against brute force."""

import math

import numpy as np
from pyspark.sql import functions as F

from slotwise.llm import nearest

SCHEMA = "vec_id long, embedding array<float>, leaf int, known string"


def found(table, is_query, **more):
    got = {}
    for r in nearest.nearest(table, is_query, **more).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    return got


def test_chi_square():
    assert math.isclose(nearest.chi_square(15.507313055865453), 0.95, rel_tol=1e-9)
    assert math.isclose(nearest.limit_of(0.95), 15.507313055865453, rel_tol=1e-9)
    draws = (np.random.default_rng(1).normal(size=(20000, nearest.DIMENSIONS)) ** 2).sum(1)
    assert abs((draws <= nearest.limit_of(0.9)).mean() - 0.9) < 0.01


def test_tree_boxes_hold_their_points():
    points = np.random.default_rng(2).normal(size=(3000, nearest.DIMENSIONS))
    points[:500] = points[0]
    tree = nearest.Tree(points, 50)
    leaf = tree.leaf(points)
    assert len(tree) > 30 and np.bincount(leaf, minlength=len(tree)).min() > 0
    assert (points >= tree.low[leaf]).all() and (points <= tree.high[leaf]).all()
    far = tree.far(points[:100])
    assert (far[np.arange(100), leaf[:100]] == 0).all()
    every = ((points[:100, None, :] - points[None]) ** 2).sum(2)
    assert (far[:, leaf] <= every + 1e-9).all()


def test_recall_and_scores(spark):
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(12, 32))
    x = (centres[rnd.integers(0, 12, 4000)] + 0.7 * rnd.normal(size=(4000, 32))).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(x)], SCHEMA)
    got, hits = found(table, F.col("id") % 50 == 0), 0
    assert sorted(got) == list(range(0, 4000, 50))
    for q, rows in got.items():
        far = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        far[q] = np.inf
        best = np.lexsort((np.arange(len(far)), far))[:10]
        assert sorted(rows) == list(range(1, 11)) and q not in [v for v, _ in rows.values()]
        assert all(math.isclose(far[v], s, rel_tol=1e-12) for v, s in rows.values())
        order = [(s, v) for _, (v, s) in sorted(rows.items())]
        assert order == sorted(order)
        hits += len({v for v, _ in rows.values()} & set(best))
    assert hits >= 0.93 * 10 * len(got)


def test_odd_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(i, one, 1, "x") for i in range(10, 1500)] + [(i, [float(i), 1.0, 0.5], 1, "x") for i in range(10)]
    rows += [(2000, None, 1, "x"), (2001, [1.0, None, 1.0], 1, "x"), (2002, [float("nan")] * 3, 1, "x"), (2003, [0.0] * 3, 1, "x"), (2004, [], 1, "x")]
    rows += [(None, one, 1, "x"), (2005, [5.0, 1.0], 1, "x"), (2006, one, 1, "x"), (2006, [2.0, 1.0, 0.5], 1, "x"), (2006, one, 1, "x")]
    table = spark.createDataFrame(rows, SCHEMA)
    got = found(table, F.col("id").isin(700, 2003, 2000, 2004, 5), sure=0.999999)
    assert sorted(got) == [5, 700]
    assert got[700] == {r: (i, 0.0) for r, i in enumerate(range(10, 20), 1)}  # copies: ties to smaller ids
    assert [v for v, _ in [got[5][r] for r in range(1, 5)]] == [2005, 4, 6, 3] and got[5][1][1] == 0.5
    few = table.where("vec_id < 4")
    assert {q: len(r) for q, r in found(few, F.lit(True)).items()} == dict.fromkeys(range(4), 3)
    assert found(table.where("vec_id = 3"), F.lit(True)) == {} and found(table.where("false"), F.lit(True)) == {}
    assert found(table.where("vec_id = 2000"), F.lit(True)) == {}
