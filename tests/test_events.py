import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from slotwise.functions.timeslice import even_slices, floor_div, prefix_scan, with_halo
from slotwise.operators import joins, patterns, windows
from slotwise.sources import delimited

S = timedelta(seconds=1)
MS = timedelta(milliseconds=1)


def events(spark, data):
    """(key, milliseconds, id, kind)"""
    df = spark.createDataFrame(data, "key string, ms bigint, id bigint, kind string")
    return df.select("key", (F.col("ms") * 1000).alias("us"), "id", "kind")


def kind(name):
    return F.col("kind") == name


def test_parse_events_keeps_malformed_lines_apart(spark):
    lines = spark.createDataFrame([("1635212345678,node5",), ("x,node5",), ("17",), ("5,",), ("7,a,b",)], "value string")
    parsed = delimited.parse_events(lines, "ms_key")
    good, bad = parsed.good, parsed.bad
    assert rows(good.select(F.unix_millis("ts"), "key")) == [(7, "a"), (1635212345678, "node5")]
    assert rows(bad) == [("17",), ("5,",), ("x,node5",)]
    orders = spark.createDataFrame([("o1+created",), ("o1",)], "value string")
    assert rows(delimited.parse_events(orders, "order_action").good) == [("o1", "created")]
    packed = spark.createDataFrame([("a-1000,b-2000",)], "value string")
    items = delimited.split_items(packed, "value").withColumnRenamed("item", "value")
    good = delimited.parse_events(items, "key_ms").good
    assert rows(good.select("key", F.unix_millis("ts"), "cnt")) == [("a", 1000, 1), ("b", 2000, 1)]


def test_floor_div_is_exact_for_large_and_negative_values(spark):
    values = [-7, -5, 0, 4, 9_007_199_254_740_993, 9_223_372_036_854_775_806]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = df.select("v", floor_div(F.col("v"), 5).alias("q")).collect()
    assert all(r.q == r.v // 5 for r in got)


def test_halo_copies_rows_only_near_edges(spark):
    df = spark.createDataFrame([(5_000_000,), (9_500_000,), (10_200_000,)], "us bigint")
    out = with_halo(df, "us", 10 * S, before=S, after=S)
    assert rows(out.select("us", "_slice", "_core")) == [
        (5_000_000, 0, True), (9_500_000, 0, True), (9_500_000, 1, False),
        (10_200_000, 0, False), (10_200_000, 1, True),
    ]


@pytest.mark.parametrize("inclusive", [True, False])
def test_prefix_scan_equals_plain_running_values(spark, inclusive):
    rng = random.Random(3)
    data = [(rng.choice(["hot", "hot", "hot", None, "b"]), i, rng.choice([None, 1, 2, 7])) for i in range(400)]
    df = spark.createDataFrame(data, "k string, pos bigint, v bigint")
    seed = spark.createDataFrame([("hot", 100)], "k string, s bigint")
    staged = df.withColumn("sl", floor_div(F.col("pos"), 37))
    spec = {"total": ("sum", F.col("v")), "top": ("max", F.col("v")), "latest": ("last", F.col("v"))}
    out = prefix_scan(staged, ["k"], "sl", ["pos"], spec, inclusive, (seed, {"latest": "s"}))
    got = {r.pos: (r.total, r.top, r.latest) for r in out.collect()}
    state = {}
    for k, pos, v in data:
        total, top, last = state.get(k, (0, None, 100 if k == "hot" else None))
        after = (total + (v or 0), max([x for x in (top, v) if x is not None], default=None), last if v is None else v)
        assert got[pos] == (after if inclusive else (total, top, last)), (k, pos)
        state[k] = after


def test_even_slices_part_a_burst(spark):
    data = [("hot", 0, 10**9, "x")] + [("hot", 5_000_000 + i, i, "x") for i in range(400)]
    df = events(spark, data).withColumn("ts", F.timestamp_micros("us"))
    sizes = df.groupBy(even_slices(df, "us", 8).alias("s")).count()
    assert sizes.agg(F.max("count")).first()[0] < 80
    fixed = windows.running_reduce(df, "key", "ts", "id", F.lit(1), S)
    even = windows.running_reduce(df, "key", "ts", "id", F.lit(1))
    assert rows(even.select("id", "running")) == rows(fixed.select("id", "running"))


def test_salted_counts_equal_plain_counts(spark):
    data = [("abc", i * 100, i, "x") for i in range(60)] + [("20_abc", 50, 99, "x")]
    df = events(spark, data).withColumn("ts", F.timestamp_micros("us"))
    plain = windows.tumbling_count(df, "key", "ts", 3 * S).select("key", "win_end", "cnt")
    for salt in (windows.salt_of("id"), windows.masked_salt("id")):
        salted = windows.salted_two_phase(df, "key", "ts", 3 * S, salt)
        assert rows(salted.select("key", "win_end", "cnt")) == rows(plain)
        first_step = windows.salted_two_phase(df, "key", "ts", 3 * S, salt, final=False)
        assert first_step.count() > plain.count()
    assert set(r[0] for r in rows(df.select(windows.masked_salt("id")))) <= {0, 2, 8, 10}


def test_two_stacked_running_reduces_count_double(spark):
    df = events(spark, [("a", i, i, "x") for i in range(4)]).withColumn("ts", F.timestamp_micros("us"))
    once = windows.running_reduce(df, "key", "ts", "id", F.lit(1), S)
    twice = windows.running_reduce(once.withColumnRenamed("running", "n"), "key", "ts", "id", F.col("n"), S)
    assert [r[0] for r in rows(once.select("running"))] == [1, 2, 3, 4]
    assert max(r[0] for r in rows(twice.select("running"))) == 10  # and not 4


def test_local_combine_emits_full_batches_and_keeps_the_rest(spark):
    data = [(i % 2, i, "a" if i % 3 else "b") for i in range(21)]
    df = spark.createDataFrame(data, "st bigint, pos bigint, item string")
    emitted, kept = windows.local_combine(df, "st", "pos", F.col("item"), F.count(F.lit(1)), batch=4, slice_rows=5)
    per_task = {0: 11, 1: 10}
    for st, n in per_task.items():
        assert emitted.filter(f"st = {st}").agg(F.sum("combined")).first()[0] == n // 4 * 4
        assert kept.filter(f"st = {st}").agg(F.sum("combined")).first()[0] == n % 4
    numbered = windows.subtask_count(df, "st", "pos", slice_rows=3)
    assert rows(numbered.filter("st = 1").select("running")) == [(i,) for i in range(1, 11)]


@pytest.mark.parametrize("array, want", [([1, 1, 2, 1, 2, 2, 8, 3, 3], 8), ([1, 1, 1, 2, 2, 2, 3], 3), ([4, 4], None)])
def test_first_unique(spark, array, want):
    df = spark.createDataFrame(list(enumerate(array)), "pos int, x int")
    assert windows.first_unique(df, "x", ["pos"]).first()[0] == want


def two_sided(spark, data):
    """(side, key, milliseconds, id, value)"""
    df = spark.createDataFrame(data, "side string, key string, ms bigint, id bigint, value string")
    df = df.withColumn("ts", F.timestamp_millis("ms"))
    return joins.two_sided(df.filter("side = 'l'"), df.filter("side = 'r'"), "key", "ts", "id", "value")


def test_consume_once_overwrites_removes_and_expires(spark):
    both = two_sided(
        spark,
        [
            ("l", "a", 0, 1, "old"), ("l", "a", 10, 2, "new"), ("r", "a", 20, 3, None), ("r", "a", 30, 4, None),
            ("l", "b", 0, 5, "x"), ("r", "b", 1000, 6, None),  # exactly the ttl: expired
            ("l", "c", 990, 7, "y"), ("r", "c", 1010, 8, None),  # across a slice edge
            ("l", "d", 0, 9, "  "), ("r", "d", 1, 10, None),  # blank
        ],
    )
    got = joins.consume_once_join(both, ttl=S, width=S)
    assert rows(got.select("key", "right_id", "left_id", "left_value")) == [("a", 3, 2, "new"), ("c", 8, 7, "y")]
    assert rows(joins.join_texts(got)) == [("输出了：>new",), ("输出了：>y",)]


def test_debounced_join_waits_for_silence(spark):
    both = two_sided(
        spark,
        [
            ("l", "a", 0, 1, "v"), ("r", "a", 10, 2, None), ("r", "a", 13, 3, None),  # at the timer: cancels
            ("l", "b", 0, 4, "w"), ("r", "b", 10, 5, None), ("r", "b", 14, 6, None),  # after it: emitted
            ("l", "c", 0, 7, "z"), ("r", "c", 9, 8, None), ("l", "c", 10, 9, "q"), ("r", "c", 11, 10, None),
        ],
    )
    got = joins.debounced_join(both, ttl=S, delay=3 * MS, width=2 * S)
    assert rows(got.select("key", "right_id", "left_value", "fire_us")) == [
        ("b", 5, "w", 13_000), ("c", 10, "q", 14_000),
    ]


def brute_consume(data, ttl, delay):
    """One row after the other, as the stored state goes."""
    out = []
    for key in {d[1] for d in data}:
        mine = sorted((d for d in data if d[1] == key), key=lambda d: (d[2], d[0] != "l", d[3]))
        stored, pending = None, None
        for side, _, ms, ident, value in mine:
            if pending and pending[0] + delay < ms:
                out.append((key, pending[1], pending[2]))
                pending = None
            if side == "l":
                stored = (ms, ident, value)
                continue
            pending = None
            if stored and ms - stored[0] < ttl:
                pending = (ms, ident, stored[1])
            stored = None
        if pending:
            out.append((key, pending[1], pending[2]))
    return sorted(out)


@pytest.mark.parametrize("width", [30, 200, 100_000])
def test_debounced_join_against_row_by_row_state(spark, width):
    rng = random.Random(width)
    data = [(rng.choice("llr"), rng.choice(["hot", "hot", "k"]), rng.randrange(3000), i, f"v{i}") for i in range(500)]
    got = joins.debounced_join(two_sided(spark, data), ttl=20 * MS, delay=7 * MS, width=width * MS)
    assert rows(got.select("key", "right_id", "left_id")) == brute_consume(data, 20, 7)


def brute_alerts(data, delay):
    out = []
    horizon = max(d[1] for d in data)
    for key in {d[0] for d in data}:
        armed = None
        for _, ms, _, what in sorted((d for d in data if d[0] == key), key=lambda d: (d[1], d[2])):
            if armed is not None and armed < ms:
                out.append((key, armed * 1000))
                armed = None
            if what == "success":
                armed = None
            elif what == "fail" and armed is None:
                armed = ms + delay
        if armed is not None and armed <= horizon:
            out.append((key, armed * 1000))
    return sorted(out)


def test_alert_timer_scenarios(spark):
    fails = [("p", 6 * i, i, "fail") for i in range(19)]
    late = [("z", 10_000, 500, "other")]
    ok = [("p", 6 * i, i, "success") for i in range(19, 30)]
    run = lambda data: rows(patterns.alert_timer(events(spark, data), kind("fail"), kind("success"), 6 * S))
    assert run(fails + ok + late) == []
    assert run(fails + late) == [("p", 6_000_000)]
    texts = patterns.alert_texts(patterns.alert_timer(events(spark, fails + late), kind("fail"), kind("success"), 6 * S))
    assert rows(texts) == [("报警啦，5秒没有成功，p",)]
    assert run(fails) == []  # the timer lies beyond the last event
    assert run([("p", 0, 1, "fail"), ("p", 6000, 2, "success"), *late]) == []  # in time
    assert run([("p", 0, 1, "fail"), ("p", 6001, 2, "success"), *late]) == [("p", 6_000_000)]


@pytest.mark.parametrize("width", [6, 17, 64, 5000])
def test_alert_timer_against_row_by_row_state(spark, width):
    rng = random.Random(width)
    data = [
        (rng.choice(["hot"] * 4 + ["a", "b"]), rng.randrange(4000), i, rng.choice(["fail"] * 12 + ["success", "other"]))
        for i in range(1500)
    ]
    df = events(spark, data).repartition(7)
    got = patterns.alert_timer(df, kind("fail"), kind("success"), 6 * MS, width=width * MS)
    assert rows(got) == brute_alerts(data, 6)


def test_whole_groups_survives_small_arrow_batches(spark):
    data = [("hot", i, i, "fail" if i % 50 else "success") for i in range(3000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        got = patterns.alert_timer(events(spark, data), kind("fail"), kind("success"), 6 * MS, width=400 * MS)
        assert rows(got) == brute_alerts(data, 6)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_strict_pattern_reports_overlaps_and_needs_adjacency(spark):
    burst = [("p", 599 * i, i, "fail") for i in range(5)]
    got = patterns.pattern_strict_next(events(spark, burst), kind("fail"), 2 * S)
    assert [r[0] for r in rows(got.select("ids"))] == [[0, 1, 2], [1, 2, 3], [2, 3, 4]]
    slow = [("p", 1000 * i, i, "fail") for i in range(3)]  # first to third: exactly 2 s
    assert patterns.pattern_strict_next(events(spark, slow), kind("fail"), 2 * S).count() == 0
    broken = [("p", 1, 1, "fail"), ("p", 2, 2, "x"), ("p", 3, 3, "fail"), ("p", 4, 4, "fail")]
    assert patterns.pattern_strict_next(events(spark, broken), kind("fail"), 2 * S).count() == 0


def test_order_pattern_matches_and_times_out(spark):
    data = [
        ("o1", 0, 1, "created"), ("o1", 10, 2, "created"), ("o1", 20, 3, "look"), ("o1", 30, 4, "PAY"),
        ("o2", 0, 5, "created"), ("o2", 10_000, 6, "pay"), ("o3", 15_000, 7, "created"),
    ]
    lowered = lambda name: F.lower("kind") == name
    found = patterns.pattern_followed_by(events(spark, data), lowered("created"), lowered("pay"), 10 * S)
    paid, late = patterns.order_texts(found)
    assert rows(paid) == [("orderId:o1 order-state:pay",)] * 2
    assert rows(late) == [("orderId:o2 orderTimeout-stamp:10000",)]


def brute_pattern(data, steps, within):
    """Open matches row by row: (steps done, start, ids)."""
    matched, late = [], []
    horizon = max(d[1] for d in data)
    for key in {d[0] for d in data}:
        live = []
        for _, ms, ident, what in sorted((d for d in data if d[0] == key), key=lambda d: (d[1], d[2])):
            keep = []
            for done, start, ids in live:
                if ms - start >= within:
                    late.append((key, ids[0]))
                elif what == steps[done][0]:
                    if done + 1 == len(steps):
                        matched.append((key, [*ids, ident]))
                    else:
                        keep.append((done + 1, start, [*ids, ident]))
                elif steps[done][1] == "followed_by":
                    keep.append((done, start, ids))
            live = keep + ([(1, ms, [ident])] if what == steps[0][0] else [])
        late += [(key, ids[0]) for _, start, ids in live if start + within <= horizon]
    return sorted(matched), sorted(late)


@pytest.mark.parametrize(
    "steps",
    [
        [("a", "next"), ("b", "followed_by")],
        [("a", "next"), ("a", "next"), ("b", "followed_by")],
        [("a", "next"), ("b", "followed_by"), ("c", "next"), ("a", "followed_by")],
    ],
)
@pytest.mark.parametrize("width", [25, 1000])
def test_pattern_match_against_row_by_row_matching(spark, steps, width):
    rng = random.Random(len(steps) * width)
    data = [(rng.choice(["hot", "hot", "k"]), rng.randrange(2000), i, rng.choice("aabc")) for i in range(600)]
    spec = [patterns.Step(kind(k), follow) for k, follow in steps]
    found = patterns.pattern_match(events(spark, data), spec, 25 * MS, width=width * MS)
    matched, late = brute_pattern(data, steps, 25)
    assert rows(found.matched.select("key", "ids")) == matched
    assert rows(found.timed_out.select("key", "id")) == late


def test_idle_window_closes_and_reopens(spark):
    data = [("a", 100, 0), ("a", 200, 5), ("a", 300, 15), ("a", 400, 26), ("a", 3100, 27)]
    df = spark.createDataFrame(data, "key string, ms bigint, arrival_ms bigint")
    df = df.select("key", (F.col("ms") * 1000).alias("us"), (F.col("arrival_ms") * 1000).alias("arrival"))
    out = patterns.idle_close_window(df, "key", "us", "arrival", 3 * S, 10 * MS)
    assert rows(out.select("win_end_us", "firing", "cnt", "close_us")) == [
        (3_000_000, 1, 3, 25_000), (3_000_000, 2, 1, 36_000), (6_000_000, 1, 1, 37_000),
    ]


def test_custom_partition_and_side_outputs(spark):
    from slotwise.operators import routing

    df = spark.createDataFrame([("1node8",), ("2node5",), ("3",)], "key string")
    placed = routing.custom_partition(df, "key", [("node8", 0), ("node5", 1)], 2)
    assert rows(placed.select("key", "partition_id")) == [("1node8", 0), ("2node5", 1), ("3", 2)]
    physical = routing.place_partitions(placed, 3).withColumn("at", F.spark_partition_id())
    assert physical.filter("at != partition_id").count() == 0
    parts = patterns.side_outputs(df, {"x": F.col("key") == "3", "all": F.lit(True)})
    assert parts["x"].count() == 1 and parts["all"].count() == 3
