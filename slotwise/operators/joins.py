"""Two-sided keyed event joins, and replacing rows by key."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.functions.text import not_blank
from slotwise.functions.timeslice import event_micros, floor_div, key_slices, micros, prefix_scan

LEFT, RIGHT = 0, 1


def two_sided(left: DataFrame, right: DataFrame, key: str, ts: str, row_id: str, value: str) -> DataFrame:
    """Both sides as one frame (key, us, side, id, value)."""

    def side(df: DataFrame, tag: int) -> DataFrame:
        return df.select(
            F.col(key).alias("key"),
            event_micros(F.col(ts)).alias("us"),
            F.lit(tag).alias("side"),
            F.col(row_id).alias("id"),
            F.col(value).cast("string").alias("value"),
        )

    return side(left, LEFT).unionByName(side(right, RIGHT))


_ORDER = ["us", "side", "id"]


def _matches(events: DataFrame, ttl: timedelta, width: timedelta | None, ranges: int | None) -> DataFrame:
    """Right rows with the left row they consume, in slices.

    The stored left row is overwritten by the next left row and removed by the next right
    row. What a right row finds is therefore the row just before it, if that is a left one.
    """
    if width is None:
        sliced = key_slices(events, ["key"], _ORDER, ranges)
    else:
        sliced = events.withColumn("_slice", floor_div(F.col("us"), micros(width)))
    row = F.struct("us", "side", "id", "value")
    sliced = sliced.withColumn("_k", F.struct("key"))
    scanned = prefix_scan(sliced, ["key"], "_slice", _ORDER, {"_prev": ("last", row)}, inclusive=False)
    prev = F.col("_prev")
    found = (F.col("side") == RIGHT) & (prev["side"] == LEFT) & (F.col("us") - prev["us"] < micros(ttl))
    return scanned.withColumn("_found", F.coalesce(found, F.lit(False)))


def _output(df: DataFrame) -> DataFrame:
    return df.select(
        "key",
        F.col("id").alias("right_id"),
        F.col("us").alias("right_us"),
        F.col("_prev.id").alias("left_id"),
        F.col("_prev.value").alias("left_value"),
    )


def consume_once_join(
    events: DataFrame, ttl: timedelta, width: timedelta | None = None, ranges: int | None = None
) -> DataFrame:
    """Each right row takes (and removes) the key's stored left row, if it was written less
    than `ttl` earlier and is not blank. Input as from `two_sided`.

    Rows are worked on in slices of equal size (`ranges` of them, see `key_slices`), or of a time
    `width`; of the slices before only their last row counts.
    """
    joined = _matches(events, ttl, width, ranges)
    return _output(joined.filter(F.col("_found") & not_blank(F.col("_prev.value"))))


def debounced_join(
    events: DataFrame, ttl: timedelta, delay: timedelta, width: timedelta | None = None, ranges: int | None = None
) -> DataFrame:
    """Like `consume_once_join`, but a match is emitted `delay` later, and only if no
    further right row of the key came up to then."""
    joined = _matches(events, ttl, width, ranges)
    later = {"_next": ("last", F.when(F.col("side") == RIGHT, F.col("us")))}
    staged = prefix_scan(joined, ["key"], "_slice", _ORDER, later, inclusive=False, reverse=True)
    quiet = F.col("_next").isNull() | (F.col("_next") > F.col("us") + micros(delay))
    keep = F.col("_found") & quiet & not_blank(F.col("_prev.value"))
    return _output(staged.filter(keep)).withColumn(
        "fire_us", F.col("right_us") + micros(delay)
    )


# Fixed value: text of a joined row, followed by the left value.
JOIN_TEXT = "输出了：>"


def join_texts(joined: DataFrame) -> DataFrame:
    return joined.select(F.concat(F.lit(JOIN_TEXT), "left_value").alias("text"))


class Replaced(NamedTuple):
    table: DataFrame
    removed: DataFrame


def replace_by_key(
    base: DataFrame, incoming: DataFrame, keys: Sequence[str], part: str = "dir"
) -> Replaced:
    """Rows of `base` whose key occurs in `incoming` go, then all incoming rows are added,
    without removing duplicates among themselves.

    `removed` is one row: the number of (incoming part, key) pairs found in `base`. The
    anti join leaves both sides as plain shuffles, so adaptive execution can split a hot
    key; the count joins distinct pairs with distinct keys, where no key is hot.
    """
    if not keys:
        raise ValueError("replace needs a key")
    keys = list(keys)
    kept = base.join(incoming.select(*keys), keys, "left_anti")
    table = kept.unionByName(incoming.drop(part))
    pairs = incoming.select(part, *keys).distinct()
    removed = pairs.join(base.select(*keys).distinct(), keys, "left_semi").agg(F.count(F.lit(1)).alias("removed"))
    return Replaced(table, removed)


def check_load(key: str, dirs: str | Sequence[str], shard: int) -> list[str]:
    """The directories of a load request (a comma list or a sequence), after its checks."""
    names = dirs.split(",") if isinstance(dirs, str) else list(dirs)
    names = [n.strip() for n in names if n.strip()]
    if not names:
        raise ValueError("at least one directory is required")
    if not key:
        raise ValueError("key must not be empty")
    if shard < 0:
        raise ValueError("shard must not be negative")
    return names
