"""Streams replayed from files, in one and in many micro-batches, against the batch form."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from slotwise.functions.timeslice import event_micros, micros
from slotwise.operators import joins, patterns
from slotwise.session import scratch_dir
from slotwise.streaming import batches, processors, sources

MS = timedelta(milliseconds=1)
ZERO = timedelta(0)
SCHEMA = "key string, ts timestamp, id bigint, kind string"


def replay(spark, data, files):
    """Events as files in event order, read one file per micro-batch."""
    path = scratch_dir(spark, "replay")
    data = sorted(data, key=lambda d: (d[1], d[2]))
    size = -(-len(data) // files)
    df = None
    for n in range(files):
        part = data[n * size : (n + 1) * size]
        df = spark.createDataFrame(part, "key string, ms bigint, id bigint, kind string")
        df.select("key", F.timestamp_millis("ms").alias("ts"), "id", "kind").coalesce(1).write.mode("append").parquet(path)
    return sources.stream_source(spark, path, SCHEMA, max_files=1), spark.read.schema(SCHEMA).parquet(path)


def finish(spark, stream, schema):
    out = scratch_dir(spark, "out")
    sources.run_to_files(stream, out, scratch_dir(spark, "checkpoint"))
    return sources.read_result(spark, out, schema)


def events(seed, n=240, kinds=("fail", "fail", "success", "other")):
    rng = random.Random(seed)
    times = rng.sample(range(1, 4000), n)  # distinct
    return [(rng.choice(["hot", "hot", "k"]), ms, i, rng.choice(kinds)) for i, ms in enumerate(times)]


def batch_keyed(df):
    return patterns.keyed(df, "key", "ts", "id", F.col("kind"))


@pytest.mark.parametrize("files", [1, 5])
def test_alert_timer_stream_equals_batch(spark, files):
    data = [d for d in events(1) if d[3] != "other"]
    stream, table = replay(spark, data, files)
    kind = F.when(F.col("kind") == "fail", 1).otherwise(0).alias("kind")
    keyed = sources.keyed_stream(stream, "key", "ts", "id", ZERO, kind)
    got = finish(spark, processors.transform(keyed, "key", processors.AlertTimer(micros(40 * MS)), processors.ALERT), processors.ALERT)
    want = patterns.alert_timer(batch_keyed(table), F.col("kind") == "fail", F.col("kind") == "success", 40 * MS)
    assert rows(got) == rows(want) and got.count() > 20


@pytest.mark.parametrize("files", [1, 5])
def test_debounced_join_stream_equals_batch(spark, files):
    data = events(2, kinds=("l", "r"))
    stream, table = replay(spark, data, files)
    side = F.when(F.col("kind") == "l", joins.LEFT).otherwise(joins.RIGHT).alias("side")
    value = F.concat(F.lit("v"), "id").alias("value")
    keyed = sources.keyed_stream(stream, "key", "ts", "id", ZERO, side, value)
    step = processors.ConsumeOnceJoin(micros(60 * MS), micros(20 * MS))
    got = finish(spark, processors.transform(keyed, "key", step, processors.JOINED), processors.JOINED)
    both = table.select("key", event_micros(F.col("ts")).alias("us"), side, "id", value)
    want = joins.debounced_join(both, 60 * MS, 20 * MS)
    horizon = max(d[1] for d in data) * 1000
    columns = ["key", "right_id", "left_id", "left_value", "fire_us"]
    assert rows(got.select(columns)) == rows(want.filter(F.col("fire_us") < horizon).select(columns))


def test_pattern_stream_equals_batch(spark):
    data = events(3, kinds="aab")
    stream, table = replay(spark, data, 4)
    tests = [(F.col("kind") == k).alias(f"p{i}") for i, k in enumerate("aab")]
    keyed = sources.keyed_stream(stream, "key", "ts", "id", ZERO, *tests)
    follows = ["next", "next", "followed_by"]
    step = processors.PatternMatch(follows, micros(90 * MS))
    got = finish(spark, processors.transform(keyed, "key", step, processors.MATCHED), processors.MATCHED)
    spec = [patterns.Step(F.col("kind") == k, f) for k, f in zip("aab", follows)]
    want = patterns.pattern_match(batch_keyed(table), spec, 90 * MS)
    assert rows(got.filter("side = 'match'").select("key", "ids")) == rows(want.matched.select("key", "ids"))
    assert rows(got.filter("side = 'timeout'").select("key", F.col("ids")[0])) == rows(want.timed_out.select("key", "id"))


def test_local_combine_and_running_sum_keep_state_across_batches(spark):
    data = events(4)
    stream, table = replay(spark, data, 5)
    one = F.lit(1).cast("bigint").alias("value")
    keyed = sources.keyed_stream(stream, "key", "ts", "id", ZERO, F.col("kind").alias("item"), one)
    got = finish(spark, processors.transform(keyed, "key", processors.LocalCombine(16), processors.COMBINED), processors.COMBINED)
    want = {}
    for key in ("hot", "k"):
        mine = sorted((d for d in data if d[0] == key), key=lambda d: d[1])
        for pos, d in enumerate(mine[: len(mine) // 16 * 16]):
            want[key, pos // 16, d[3]] = want.get((key, pos // 16, d[3]), 0) + 1
    assert {(r.subtask, r.flush, r.key): r.combined for r in got.collect()} == want
    stream, _ = replay(spark, data, 3)
    keyed = sources.keyed_stream(stream, "key", "ts", "id", ZERO, one)
    got = finish(spark, processors.transform(keyed, "key", processors.RunningSum(), processors.RUNNING), processors.RUNNING)
    for key in ("hot", "k"):
        assert [r[0] for r in rows(got.filter(F.col("key") == key).select("running"))] == list(range(1, sum(d[0] == key for d in data) + 1))


def test_late_split_stream_carries_the_largest_time(spark):
    path = scratch_dir(spark, "late-in")
    rng = random.Random(5)
    data = [(i, 1000 * i - rng.choice([0, 0, 500, 9000]), 1000 * i) for i in range(60)]
    for n in range(4):
        part = spark.createDataFrame(data[n * 15 : n * 15 + 15], "id bigint, us bigint, arrival bigint")
        part.coalesce(1).write.mode("append").parquet(path)
    table = spark.read.parquet(path)
    stream = sources.stream_source(spark, path, table.schema, max_files=1)
    out = scratch_dir(spark, "late-out")
    batches.write_late_split(stream, "arrival", "us", "id", 2 * MS, 10 * MS, out, scratch_dir(spark, "late-check"))
    want = patterns.late_split(table, "arrival", "us", "id", 2 * MS, 10 * MS)
    assert rows(spark.read.parquet(f"{out}/late").select("id")) == rows(want.late.select("id"))
    assert rows(spark.read.parquet(f"{out}/on_time").select("id")) == rows(want.on_time.select("id"))
    assert want.late.count() > 5


def test_restart_after_a_failure_gives_every_row_once(spark):
    data = events(6)
    stream, table = replay(spark, data, 4)
    out, checkpoint = scratch_dir(spark, "exact"), scratch_dir(spark, "exact-check")
    wide = stream.select("id", "kind")
    breaks = wide.withColumn("kind", F.when(F.col("id") == data[-1][2], F.raise_error(F.lit("boom"))).otherwise(F.col("kind")))
    with pytest.raises(Exception, match="boom"):
        sources.run_to_files(breaks, out, checkpoint)
    sources.run_to_files(wide, out, checkpoint)
    sources.run_to_files(wide, out, checkpoint)  # nothing left to do
    assert rows(sources.read_result(spark, out, wide.schema)) == rows(table.select("id", "kind"))


def test_kafka_options_are_only_built():
    options = sources.kafka_source_options(["h1:9092", "h2:9092"], ["t"], 500)
    assert options["kafka.bootstrap.servers"] == "h1:9092,h2:9092" and options["maxOffsetsPerTrigger"] == "500"


def test_windows_close_by_the_clock_without_further_rows(spark, tmp_path):
    """Two batches of rows, then silence: the timer alone closes each window, once."""
    import time

    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def arrive(rows):
        spark.createDataFrame(rows, "key string, win_end_us bigint").coalesce(1).write.mode("append").parquet(folder)

    arrive([("a", 10), ("a", 10), ("b", 10)])
    rows = sources.stream_source(spark, folder, spark.read.parquet(folder).schema).withColumn("n", F.lit(1).cast("bigint"))
    fired = processors.transform(rows, ["key", "win_end_us"], processors.IdleCloseByClock(4_000_000), processors.FIRED, "ProcessingTime")
    query = fired.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="200 milliseconds").start(out)

    def wait(count):
        end = time.time() + 90
        while time.time() < end and query.exception() is None:
            if query.lastProgress is not None and len(done := spark.read.schema(processors.FIRED).parquet(out).collect()) >= count:
                return sorted((r.key, r.win_end_us, r.cnt) for r in done)
            time.sleep(0.3)
        raise AssertionError(query.exception() or "no window closed")

    try:
        assert wait(2) == [("a", 10, 2), ("b", 10, 1)]  # nothing came after the first rows
        arrive([("a", 10), ("c", 20)])
        assert wait(4) == [("a", 10, 1), ("a", 10, 2), ("b", 10, 1), ("c", 20, 1)]  # a late row opens a new firing
    finally:
        query.stop()


def test_running_sums_go_on_from_batch_to_batch(spark, tmp_path):
    import random

    rng, want, sums = random.Random(5), {}, {}
    for number in range(5):
        rows = sorted((rng.randrange(1000) + 1000 * number, 100 * number + i, rng.choice(["hot", "hot", "hot", "k", None]), rng.randrange(50)) for i in range(60))
        for at, ident, key, value in rows:
            sums[key] = sums.get(key, 0) + value
            want[ident] = sums[key]
        rng.shuffle(rows)
        frame = spark.createDataFrame(rows, "ms bigint, id bigint, key string, value bigint").withColumn("ts", F.timestamp_millis("ms"))
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = sources.stream_source(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, max_files=1)
    batches.write_running(stream, "key", "ts", "id", "value", f"{tmp_path}/out", f"{tmp_path}/c")
    done = spark.read.option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out/rows")
    assert {r.id: r.running for r in done.collect()} == want
    assert len([p for p in (tmp_path / "out" / "rows").iterdir() if p.name.startswith("batch=")]) == 5


def test_local_combine_holds_numbers_only():
    import numpy as np
    import pandas as pd

    places = {}
    first = pd.DataFrame({"us": [5, 3], "id": [1, 2], "item": ["b", "a"], "value": [1, 1]})
    then = pd.DataFrame({"us": [4.0, None], "id": [3, 4], "item": ["a", None], "value": [1.0, None]})
    parts = [processors._numbers(pdf, places) for pdf in (first, then)]
    assert all(c.dtype == np.int64 for part in parts for c in part) and places == {"b": 0, "a": 1}
    assert [c.tolist() for c in parts[1]] == [[4, np.iinfo(np.int64).max], [3, 4], [1, -1], [1, 0]]
