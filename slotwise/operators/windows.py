"""Windowed and running aggregates over keyed events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions.timeslice import even_slices, event_micros, floor_div, micros, prefix_scan


def _interval(span: timedelta) -> str:
    return f"{micros(span)} microseconds"


def tumbling_count(df: DataFrame, key: str, ts: str, size: timedelta) -> DataFrame:
    """(key, win_end, cnt) per tumbling window [start, end). Works on streams too."""
    win = F.window(ts, _interval(size))
    return (
        df.groupBy(win.alias("_w"), F.col(key))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(key, F.col("_w.end").alias("win_end"), "cnt")
    )


def tumbling_count_all(df: DataFrame, ts: str, size: timedelta) -> DataFrame:
    """(win_end, cnt) over all rows."""
    win = F.window(ts, _interval(size))
    return (
        df.groupBy(win.alias("_w"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .select(F.col("_w.end").alias("win_end"), "cnt")
    )


def cumulative_windows(counts: DataFrame, key: str) -> DataFrame:
    """Running total per key over the window counts; one input row per (key, window), so a
    hot key costs no more than the number of windows."""
    past = W.partitionBy(key).orderBy("win_end").rowsBetween(W.unboundedPreceding, 0)
    return counts.withColumn("total", F.sum("cnt").over(past))


def salt_of(row_id: str, salts: int = 10) -> Column:
    """Salt 0..salts-1 from a row id: spreads like a random draw, but a retried task
    draws the same."""
    return F.pmod(F.xxhash64(F.col(row_id)), F.lit(salts)).cast("int")


def masked_salt(row_id: str) -> Column:
    """The `hash & 10` salt: only 0, 2, 8 and 10 occur."""
    return F.xxhash64(F.col(row_id)).bitwiseAND(F.lit(10)).cast("int")


def salted_two_phase(
    df: DataFrame, key: str, ts: str, size: timedelta, salt: Column, final: bool = True
) -> DataFrame:
    """Window count of a skewed key in two steps: per salted key, then per key.

    `final=False` stops after the first step with the salt stripped, several partial rows
    per (key, window).
    """
    salted = df.withColumn("_salted", F.concat_ws("_", F.col(key).cast("string"), salt))
    partial = tumbling_count(salted, "_salted", ts, size).withColumn(
        key, F.regexp_replace("_salted", "_[0-9]+$", "")
    )
    if not final:
        return partial.select(key, "win_end", "cnt")
    return partial.groupBy(key, "win_end").agg(F.sum("cnt").alias("cnt"))


def running_reduce(
    df: DataFrame,
    key: str,
    ts: str,
    row_id: str,
    value: Column,
    slice_width: timedelta | None = None,
    kind: str = "sum",
    seed: DataFrame | None = None,
) -> DataFrame:
    """The running `sum` or `max` of `value` per key, one output row per input row. `seed` (key,
    total) has the values to go on from.

    Time is cut into slices of `slice_width`, or without one into slices of equally many
    rows, for which the times are looked at first.
    """
    staged = df.withColumn("_us", event_micros(F.col(ts)))
    if slice_width is None:
        slices = even_slices(staged, "_us")
    else:
        slices = floor_div(F.col("_us"), micros(slice_width))
    staged = staged.withColumn("_slice", slices)
    start = None if seed is None else (seed.select(key, "total"), {"running": "total"})
    scanned = prefix_scan(staged, [key], "_slice", ["_us", row_id], {"running": (kind, value)}, seed=start)
    return scanned.drop("_us", "_slice", "_seed_running")


def numbered(df: DataFrame, group: str, order: str, slice_rows: int = 1_000_000) -> DataFrame:
    """Add `pos`, 1.. per group in the order of the integer column `order`.

    Slices are ranges of `order`, so where `order` is a row position no task numbers more
    than `slice_rows` rows, however large the group.
    """
    staged = df.withColumn("_slice", floor_div(F.col(order), slice_rows))
    return prefix_scan(staged, [group], "_slice", [order], {"pos": ("sum", F.lit(1))}).drop("_slice")


def subtask_count(df: DataFrame, subtask: str, order: str, slice_rows: int = 1_000_000) -> DataFrame:
    """Running row count per subtask, one output row per input row."""
    return numbered(df, subtask, order, slice_rows).withColumnRenamed("pos", "running")


def local_combine(
    df: DataFrame,
    subtask: str,
    order: str,
    key: Column,
    combine: Column,
    batch: int = 100,
    slice_rows: int = 1_000_000,
) -> tuple[DataFrame, DataFrame]:
    """Pre-aggregation per subtask, flushed every `batch` rows.

    Returns (emitted, kept): combined values per (subtask, flush, key) of full batches, and
    of the unfinished last one that stays in state. `combine` is an aggregate expression.
    """
    staged = (
        numbered(df, subtask, order, slice_rows)
        .withColumn("flush", floor_div(F.col("pos") - 1, batch))
        .withColumn("_key", key)
    )
    groups = staged.groupBy(subtask, "flush", F.col("_key").alias("key")).agg(
        combine.alias("combined"), F.count(F.lit(1)).alias("_rows")
    )
    # at most `batch` keys share a flush
    full = F.sum("_rows").over(W.partitionBy(subtask, "flush")) == batch
    groups = groups.withColumn("_full", full).drop("_rows")
    return groups.filter("_full").drop("_full"), groups.filter("NOT _full").drop("_full")


def batch_stats(df: DataFrame, batch: str, shard: str) -> DataFrame:
    """Per batch: rows, shards, average (integer division) and largest rows per shard."""
    per_shard = df.groupBy(batch, shard).agg(F.count(F.lit(1)).alias("n"))
    totals = per_shard.groupBy(batch).agg(
        F.sum("n").alias("items"), F.count(F.lit(1)).alias("shards"), F.max("n").alias("max_items")
    )
    return totals.select(
        batch, "items", "shards", F.expr("items div shards").alias("avg_items"), "max_items"
    )


def first_unique(df: DataFrame, value: str, order: Sequence[str]) -> DataFrame:
    """One row: the first value that occurs exactly once, null if there is none."""
    counts = df.groupBy(value).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("at")
    )
    return counts.filter("n = 1").agg(F.min_by(value, "at").alias(value))
