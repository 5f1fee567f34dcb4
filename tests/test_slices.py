"""Slices of equally many rows: results do not depend on them, and no hot key is held whole."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from slotwise.functions.timeslice import key_slices, prefix_scan
from slotwise.operators import buckets, joins, patterns, windows
from test_events import MS, brute_consume, brute_pattern, events, kind, two_sided

HOT = ["hot"] * 9 + ["k1", "k2", "k3", "k4"]


def sides(seed, n, span):
    rng = random.Random(seed)
    return [(rng.choice("llr"), rng.choice(HOT), rng.randrange(span), i, f"v{i}") for i in range(n)]


@pytest.mark.parametrize("ranges, span", [(40, 3000), (40, 40), (7, 1), (None, 500)])
def test_joins_in_equal_slices(spark, ranges, span):
    data = sides(span, 700, span)
    both = two_sided(spark, data)
    got = joins.debounced_join(both, ttl=20 * MS, delay=7 * MS, ranges=ranges)
    assert rows(got.select("key", "right_id", "left_id")) == brute_consume(data, 20, 7)
    once = joins.consume_once_join(both, ttl=20 * MS, ranges=ranges)
    assert rows(once.select("key", "right_id", "left_id")) == brute_consume(data, 20, -1)


@pytest.mark.parametrize("ranges, span", [(40, 2000), (40, 60), (5, 3)])
def test_patterns_in_equal_slices(spark, ranges, span):
    rng = random.Random(ranges * span)
    data = [(rng.choice(HOT), rng.randrange(span), i, rng.choice("aabc")) for i in range(500)]
    steps = [("a", "next"), ("b", "followed_by"), ("c", "next"), ("a", "followed_by")]
    spec = [patterns.Step(kind(k), follow) for k, follow in steps]
    found = patterns.pattern_match(events(spark, data), spec, 25 * MS, ranges=ranges)
    matched, late = brute_pattern(data, steps, 25)
    assert rows(found.matched.select("key", "ids")) == matched
    assert rows(found.timed_out.select("key", "id")) == late


def test_a_key_with_nine_of_ten_rows_is_cut_evenly(spark):
    """Also where all of them lie within one instant, and whatever the width of the operator."""
    for span in (10**6, 1):
        rng = random.Random(span)
        data = [(rng.random() < 0.9, rng.randrange(span), i) for i in range(20_000)]
        df = spark.createDataFrame(data, "hot boolean, us bigint, id bigint").select(F.when(F.col("hot"), "hot").otherwise("k").alias("key"), "us", "id")
        parts = key_slices(df.repartition(5), ["key"], ["us", "id"], ranges=100).groupBy("key", "_slice").count()
        assert parts.agg(F.max("count")).first()[0] <= 20_000 / 50
        order = parts.orderBy("_slice").collect()
        assert len(order) >= 60


def test_reverse_scans(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), t, rng.choice([None, t])) for t in range(200)]
    df = spark.createDataFrame(data, "k string, t bigint, v bigint").withColumn("_slice", F.expr("t div 17"))
    got = prefix_scan(df, ["k"], "_slice", ["t"], {"next": ("last", F.col("v")), "after": ("sum", F.col("t")), "top": ("max", F.col("v"))}, inclusive=False, reverse=True)
    for r in got.collect():
        later = [(t, v) for k, t, v in data if k == r.k and t > r.t]
        values = [v for _, v in later if v is not None]
        assert r.next == (values[0] if values else None) and r.after == sum(t for t, _ in later) and r.top == max(values, default=None)


def test_late_rows_and_running_values_without_a_given_width(spark):
    rng = random.Random(8)
    data = [(i, rng.randrange(50) + (i if i < 250 else 250), rng.choice(HOT)) for i in range(400)]
    df = spark.createDataFrame(data, "id bigint, us bigint, key string").withColumn("arrival", F.col("id") * 1000)
    split = patterns.late_split(df, "arrival", "us", "id", timedelta(microseconds=20))
    seen, late = -1, set()
    for i, us, _ in data:
        if seen >= 0 and us < seen - 20:
            late.add(i)
        seen = max(seen, us)
    assert {r.id for r in split.late.collect()} == late and split.tagged.count() == 400
    running = windows.running_reduce(df.withColumn("ts", F.timestamp_micros("us")), "key", "ts", "id", F.lit(1))
    for r in running.collect():
        assert r.running == sum(k == r.key and (us, i) <= (r.us, r.id) for i, us, k in data)


def test_running_values_over_all_buckets(spark):
    frame = spark.createDataFrame([(float(b), b * 3 % 11) for b in range(300)], "bucket double, doc_count bigint").repartition(4)
    want, total, before = [], 0, None
    for b in range(300):
        n = b * 3 % 11
        total += n
        want.append((float(b), total, None if before is None else n - before))
        before = n
    both = buckets.derivative(buckets.cumulative_sum(frame))
    assert sorted(tuple(r) for r in both.select("bucket", "cumulative_sum", "derivative").collect()) == want


def test_trees_of_buckets(spark):
    rng = random.Random(4)
    data = [(rng.choice(["a", "a", "b", "c", None]), rng.choice([None, *range(30)]), rng.randrange(4)) for _ in range(600)]
    df = spark.createDataFrame(data, "kind string, n int, m int").repartition(3)
    spans = [(None, 10), (5, 20), (20, None)]
    levels = [buckets.by_terms("kind", "kind", 2), buckets.by_ranges("span", "n", spans), buckets.by_histogram("m", "m", 2)]
    got = {tuple(r)[:4]: tuple(r)[4:] for r in buckets.tree(df, levels, [F.sum("m").alias("s")]).collect()}
    want = {}
    for kind_, n, m in data:
        if kind_ is None:
            continue
        spots = [f"{'*' if lo is None else lo}-{'*' if hi is None else hi}" for lo, hi in spans if n is not None and (lo is None or n >= lo) and (hi is None or n < hi)]
        paths = [(1, kind_, None, None)] + [(2, kind_, s, None) for s in spots] + [(3, kind_, s, float(m // 2 * 2)) for s in spots]
        for path in paths:
            count, total = want.get(path, (0, 0))
            want[path] = (count + 1, total + m)
    top = sorted(((-v[0], p[1]) for p, v in want.items() if p[0] == 1))[:2]
    assert got == {p: v for p, v in want.items() if p[1] in {k for _, k in top}}
    limited = buckets.tree(df, [buckets.by_filters("f", {"odd": F.col("m") % 2 == 1, "all": F.lit(True)}), buckets.by_terms("kind", "kind", 1)])
    assert sorted((r.depth, r.f, r.kind) for r in limited.collect()) == [(1, "all", None), (1, "odd", None), (2, "all", "a"), (2, "odd", "a")]
    with pytest.raises(ValueError):
        buckets.tree(df, [])


def test_stored_aggregates_are_merged(spark):
    rng = random.Random(6)
    data = [(i % 37, rng.choice([None, rng.randrange(1000) / 4]), f"u{rng.randrange(300)}") for i in range(5000)]
    df = spark.createDataFrame(data, "part int, x double, u string")
    parts = buckets.partial_aggregates(df, ["part"], ["x"])
    told = buckets.estimates(buckets.merged_aggregates(parts, ["part"], ["x"], batch=4), ["x"], [25, 50]).first()
    values = sorted(x for _, x, _ in data if x is not None)
    assert (told.doc_count, told.x_count, told.x_min, told.x_max) == (5000, len(values), values[0], values[-1])
    assert float(told.x_sum) == pytest.approx(sum(round(v, 2) for v in values), abs=0.01 * len(values))
    assert abs(told.x_cardinality - len(set(values))) <= 0.03 * len(set(values))
    for p, q in zip((25, 50), told.x_percentiles):
        assert abs(sum(v <= q for v in values) / len(values) - p / 100) < 0.05
    with pytest.raises(ValueError):
        buckets.merged_aggregates(parts, ["part"], ["x"], batch=1)
