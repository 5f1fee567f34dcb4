"""Streaming forms, run over the events table to the end of the available input."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from slotwise.operators import joins, windows
from slotwise.plans import event_queries as batch
from slotwise.plans.event_queries import DAY, H, MIN
from slotwise.plans.registry import ORACLES, ms, query, table, us
from slotwise.session import scratch_dir
from slotwise.sources.sinks import print_sink
from slotwise.streaming import batches, processors, sources
from slotwise.functions.timeslice import floor_div, micros

ZERO = 0 * H


def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return sources.stream_source(spark, sf, schema, glob="events.parquet")


def _finish(spark, df, schema, name):
    """Run into files and read them back."""
    out, checkpoint = scratch_dir(spark, name), scratch_dir(spark, f"{name}-checkpoint")
    sources.run_to_files(df, out, checkpoint)
    return sources.read_result(spark, out, schema)


def _keyed(spark, sf, *extra):
    return sources.keyed_stream(_stream(spark, sf), "user_id", "ts", "event_id", ZERO, *extra)


@query("stream_source", "SELECT event_id, user_id, event_type FROM events")
def _stream_source(spark, sf):
    df = _stream(spark, sf).select("event_id", "user_id", "event_type")
    return _finish(spark, df, df.schema, "stream-source")


@query("print_sink", "SELECT event_id, event_type FROM events WHERE event_type = 'error'")
def _print_sink(spark, sf):
    errors = _stream(spark, sf).filter("event_type = 'error'").select("event_id", "event_type")
    lines = scratch_dir(spark, "print")
    print_sink(errors, lines, scratch_dir(spark, "print-checkpoint")).awaitTermination()
    return spark.read.schema(errors.schema).json(lines)


@query(
    "watermark",
    """
    SELECT event_type AS key, epoch_ms(date_trunc('hour', ts)) + 3600000 AS win_end_ms, count(*) AS cnt FROM events
    GROUP BY ALL HAVING epoch_us(date_trunc('hour', ANY_VALUE(ts))) + 3600000000 <= (SELECT max(epoch_us(ts)) FROM events) - 1000000
    """,
)
def _watermark(spark, sf):
    timed = sources.with_event_time(_stream(spark, sf), "ts", MIN / 60)
    counts = windows.tumbling_count(timed, "event_type", "ts", H).select(
        F.col("event_type").alias("key"), ms(F.col("win_end")).alias("win_end_ms"), "cnt"
    )
    return _finish(spark, counts, counts.schema, "watermark")


@query(
    "cumulative_windows_stream",
    """
    WITH c AS (SELECT event_type AS key, date_trunc('hour', ts) AS h, count(*) AS cnt FROM events GROUP BY ALL)
    SELECT key, epoch_ms(h) + 3600000 AS win_end_ms, cnt, (sum(cnt) OVER (PARTITION BY key ORDER BY h))::BIGINT AS total FROM c
    WHERE epoch_us(h) + 3600000000 <= (SELECT max(epoch_us(ts)) FROM events)
    """,
)
def _cumulative_stream(spark, sf):
    timed = sources.with_event_time(_stream(spark, sf), "ts", ZERO)
    counts = windows.tumbling_count(timed.withColumn("key", F.col("event_type")), "key", "ts", H)
    totals = processors.transform(counts, "key", processors.CumulativeWindows(), processors.TOTALS)
    out = _finish(spark, totals, processors.TOTALS, "cumulative")
    return out.select("key", ms(F.col("win_end")).alias("win_end_ms"), "cnt", "total")


def _two_sided_stream(spark, sf):
    side = F.when(F.col("event_type") == "click", joins.LEFT).otherwise(joins.RIGHT).alias("side")
    both = _stream(spark, sf).filter("event_type IN ('click', 'view')")
    return sources.keyed_stream(both, "user_id", "ts", "event_id", ZERO, side, F.col("props").alias("value"))


@query("consume_once_join_stream", ORACLES["consume_once_join"])
def _consume_once_stream(spark, sf):
    joined = processors.transform(
        _two_sided_stream(spark, sf), "key", processors.ConsumeOnceJoin(micros(6 * H)), processors.JOINED
    )
    out = _finish(spark, joined, processors.JOINED, "consume-once").drop("fire_us")
    return out.withColumn("key", F.col("key").cast("bigint"))


@query(
    "debounced_join_stream",
    ORACLES["debounced_join"].rstrip() + " AND us + 7200000000 <= (SELECT max(epoch_us(ts)) FROM events WHERE event_type IN ('click', 'view'))",
)
def _debounced_stream(spark, sf):
    joined = processors.transform(
        _two_sided_stream(spark, sf), "key", processors.ConsumeOnceJoin(micros(6 * H), micros(2 * H)), processors.JOINED
    )
    out = _finish(spark, joined, processors.JOINED, "debounced")
    return out.withColumn("key", F.col("key").cast("bigint"))


@query(
    "alert_timer_stream",
    ORACLES["alert_timer"].replace(
        "(SELECT max(epoch_us(ts)) FROM events)",
        "(SELECT max(epoch_us(ts)) FROM events WHERE event_type IN ('error', 'purchase'))",
    ),
)
def _alert_stream(spark, sf):
    kind = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "purchase", 0)
    rows = _keyed(spark, sf, kind.alias("kind")).filter("kind IS NOT NULL")
    alerts = processors.transform(rows, "key", processors.AlertTimer(micros(6 * H)), processors.ALERT)
    out = _finish(spark, alerts, processors.ALERT, "alerts")
    return out.withColumn("key", F.col("key").cast("bigint"))


def _pattern_stream(spark, sf, steps, within, name):
    tests = [F.coalesce(F.col("event_type") == kind, F.lit(False)).alias(f"p{i}") for i, (kind, _) in enumerate(steps)]
    rows = _keyed(spark, sf, *tests)
    processor = processors.PatternMatch([follow for _, follow in steps], micros(within))
    found = processors.transform(rows, "key", processor, processors.MATCHED)
    return _finish(spark, found, processors.MATCHED, name).withColumn("key", F.col("key").cast("bigint"))


@query("pattern_followed_by_stream", ORACLES["pattern_followed_by"])
def _followed_by_stream(spark, sf):
    out = _pattern_stream(spark, sf, [("view", "next"), ("purchase", "followed_by")], 12 * H, "followed-by")
    return out.select("key", F.col("ids")[0].alias("id"), "start_us", "end_us", "side")


@query("pattern_strict_next_stream", ORACLES["pattern_strict_next"])
def _strict_next_stream(spark, sf):
    out = _pattern_stream(spark, sf, [("error", "next")] * 3, DAY, "strict-next").filter("side = 'match'")
    ids = F.col("ids")
    return out.select("key", "start_us", "end_us", ids[0].alias("first_id"), ids[1].alias("second_id"), ids[2].alias("third_id"))


@query("pattern_match_stream", ORACLES["pattern_match"])
def _pattern_match_stream(spark, sf):
    steps = [("click", "next"), ("view", "next"), ("purchase", "followed_by")]
    out = _pattern_stream(spark, sf, steps, 2 * DAY, "pattern").filter("side = 'match'")
    ids = F.col("ids")
    return out.select("key", "start_us", "end_us", ids[0].alias("first_id"), ids[1].alias("second_id"), ids[2].alias("third_id"))


@query(
    "idle_close_window_stream",
    "SELECT key, win_end_us, cnt, close_us FROM (" + ORACLES["idle_close_window"]
    + ") z WHERE close_us <= (SELECT max(epoch_us(ts) + (event_id % 7) * 60000000) FROM events)",
)
def _idle_close_stream(spark, sf):
    event = _stream(spark, sf)
    late = (F.col("event_id") % 7) * 60_000_000
    arrived = event.select(
        F.col("event_type").alias("key"),
        ((floor_div(us(F.col("ts")), micros(3 * H)) + 1) * micros(3 * H)).alias("win_end_us"),
        F.timestamp_micros(us(F.col("ts")) + late).alias("ts"),
    ).withColumn("arrival", us(F.col("ts")))
    timed = sources.with_event_time(arrived, "ts", ZERO)
    fired = processors.transform(timed, ["key", "win_end_us"], processors.IdleCloseWindow(micros(30 * MIN)), processors.FIRED)
    return _finish(spark, fired, processors.FIRED, "idle-close")


@query(
    "running_reduce_stream",
    """
    SELECT event_type AS key, event_id AS id,
           (sum(user_id) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS running
    FROM events
    """,
)
def _running_stream(spark, sf):
    path = scratch_dir(spark, "running")
    rows = _in_parts(spark, sf).select("event_type", "ts", "event_id", "user_id")
    batches.write_running(rows, "event_type", "ts", "event_id", "user_id", path, scratch_dir(spark, "running-checkpoint"))
    done = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/rows")
    return done.select(F.col("event_type").alias("key"), F.col("event_id").alias("id"), "running")


def _in_parts(spark, sf, parts=5):
    """The events as a stream of `parts` files in order of time, one for each micro-batch."""
    event = table(spark, sf, "events")
    at = event.withColumn("_us", us(F.col("ts")))
    cuts = at.approxQuantile("_us", [k / parts for k in range(1, parts)], 0.001)
    path = scratch_dir(spark, "events")
    for low, high in zip([None, *cuts], [*cuts, None]):
        some = at if low is None else at.filter(F.col("_us") >= low)
        some = some if high is None else some.filter(F.col("_us") < high)
        some.drop("_us").coalesce(1).write.mode("append").parquet(path)
    return sources.stream_source(spark, path, event.schema, max_files=1)


@query("local_combine_stream", ORACLES["local_combine"])
def _local_combine_stream(spark, sf):
    event = _stream(spark, sf).withColumn("subtask", F.col("user_id") % 8)
    rows = sources.keyed_stream(
        event, "subtask", "ts", "event_id", ZERO, F.col("event_type").alias("item"), F.lit(1).cast("bigint").alias("value")
    )
    out = processors.transform(rows, "key", processors.LocalCombine(16), processors.COMBINED)
    return _finish(spark, out, processors.COMBINED, "local-combine").withColumn("subtask", F.col("subtask").cast("bigint"))


@query("late_split_stream", ORACLES["late_split"])
def _late_stream(spark, sf):
    arrival = us(F.col("ts")) + (F.col("event_id") % 7) * 60_000_000
    rows = _stream(spark, sf).select("event_id", us(F.col("ts")).alias("us"), arrival.alias("arrival"))
    path = scratch_dir(spark, "late")
    batches.write_late_split(
        rows, "arrival", "us", "event_id", 2 * MIN, 10 * MIN, path, scratch_dir(spark, "late-checkpoint")
    )
    return reduce(
        lambda a, b: a.unionByName(b),
        [spark.read.parquet(f"{path}/{s}").select("event_id", "us", F.lit(s).alias("side")) for s in ("on_time", "late")],
    )


@query("side_outputs_stream", ORACLES["side_outputs"])
def _side_outputs_stream(spark, sf):
    rows = _stream(spark, sf).select("event_id", "user_id", "event_type")
    path = scratch_dir(spark, "sides")
    tags = {"fail": batch.IS("error"), "ok": ~batch.IS("error")}
    batches.write_side_outputs(rows, tags, path, scratch_dir(spark, "sides-checkpoint"))
    return reduce(
        lambda a, b: a.unionByName(b),
        [spark.read.parquet(f"{path}/{s}").select("event_id", "user_id", F.lit(s).alias("side")) for s in tags],
    )


@query("checkpointing", "SELECT event_id, user_id FROM events WHERE event_type = 'purchase'")
def _checkpointing(spark, sf):
    """Two runs over the same folders: the second finds nothing left to do."""
    rows = _stream(spark, sf).filter("event_type = 'purchase'").select("event_id", "user_id")
    out, checkpoint = scratch_dir(spark, "exactly-once"), scratch_dir(spark, "exactly-once-checkpoint")
    for _ in range(2):
        sources.run_to_files(rows, out, checkpoint)
    return sources.read_result(spark, out, rows.schema)


@query(
    "checkpointing_state",
    """
    SELECT event_type AS key, sum(user_id)::BIGINT AS total, sum(user_id)::BIGINT AS undisturbed, count(*) AS n, count(*) AS n_undisturbed
    FROM events GROUP BY 1
    """,
)
def _checkpointing_state(spark, sf):
    """A run stopped in the middle and resumed, beside an undisturbed one: state and output of both."""
    event = _in_parts(spark, sf)
    told = []
    for name in ("stopped", "whole"):
        rows = sources.keyed_stream(event, "event_type", "ts", "event_id", ZERO, F.col("user_id").alias("value"))
        running = processors.transform(rows, "key", processors.RunningSum(), processors.RUNNING)
        out, checkpoint = scratch_dir(spark, name), scratch_dir(spark, f"{name}-checkpoint")
        if name == "stopped":
            sources.run_part(running, out, checkpoint, 2)
        sources.run_to_files(running, out, checkpoint)
        state = sources.read_state(spark, checkpoint, "total").select("key.key", F.col("value.total").alias("total"))
        counts = sources.read_result(spark, out, processors.RUNNING).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        told.append(state.join(counts, "key"))
    return told[0].join(told[1].withColumnsRenamed({"total": "undisturbed", "n": "n_undisturbed"}), "key")
