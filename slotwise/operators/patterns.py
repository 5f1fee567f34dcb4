"""Sequence patterns, alerts and late rows over keyed events, in batch.

Every function takes rows with `key`, `us` (event time, microseconds) and `id`, ordered by
(us, id) within a key. The streaming forms in `slotwise.streaming` give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.timeslice import even_slices, event_micros, floor_div, key_slices, micros, prefix_scan, with_halo
from slotwise.session import stored


def keyed(df: DataFrame, key: str, ts: str, row_id: str, *extra: Column) -> DataFrame:
    """Rename to the columns the functions here expect."""
    return df.select(
        F.col(key).alias("key"),
        event_micros(F.col(ts)).alias("us"),
        F.col(row_id).alias("id"),
        *extra,
    )


class Step(NamedTuple):
    """One step of a pattern: how it follows the one before, and what it accepts."""

    predicate: Column
    follow: str = "next"  # `next` = the very next row, `followed_by` = the first later one


class Matches(NamedTuple):
    """`found` has every match (side `match`) and every start that ran out of time (side
    `timeout`, `end_us` = when, `ids` = the start alone); the others are views of it."""

    found: DataFrame

    @property
    def matched(self) -> DataFrame:
        return self.found.filter("side = 'match'").drop("side")

    @property
    def timed_out(self) -> DataFrame:
        late = self.found.filter("side = 'timeout'")
        return late.select("key", F.col("ids")[0].alias("id"), "start_us", F.col("end_us").alias("timeout_us"))


def pattern_match(
    df: DataFrame, steps: Sequence[Step], within: timedelta, width: timedelta | None = None, ranges: int | None = None
) -> Matches:
    """All matches of a step sequence per key; every row accepted by the first step starts one.

    First and last row lie strictly less than `within` apart. A match is (key, start_us,
    end_us, ids). Starts whose time ran out unfinished are reported as far as the data
    reaches.

    Built backwards: in reverse time order each row knows, for its step, the row that the
    match goes on with. For each step that is one reverse scan over slices of equal size
    (`ranges` of them, see `key_slices`) or of a time `width`: of the slices behind only the
    nearest row that counts is handed on, so no key is held whole, however dense.
    """
    span = micros(within)
    if width is None:
        sliced = key_slices(df, ["key"], ["us", "id"], ranges)
    else:
        sliced = df.withColumn("_slice", floor_div(F.col("us"), micros(width)))

    # _r{k}: what becomes of a match standing at step k on this row. Null = it still waits
    # for a row; else where it ended and, if a `next` step was refused there, `dead`.
    last = len(steps) - 1
    us = F.col("us").alias("end_us")
    staged = sliced.withColumn("_k", F.struct("key")).withColumn(
        f"_r{last}", F.struct(us, F.array("id").alias("ids"), F.lit(False).alias("dead"))
    )
    for pos in range(last - 1, -1, -1):
        step, later = steps[pos + 1], F.col(f"_r{pos + 1}")
        if step.follow == "next":
            refused = F.struct(us, F.array("id").alias("ids"), F.lit(True).alias("dead"))
            accepted = F.coalesce(step.predicate, F.lit(False))
            target = F.struct(F.when(accepted, later).otherwise(refused).alias("to"))
        elif step.follow == "followed_by":
            target = F.when(step.predicate, F.struct(later.alias("to")))
        else:
            raise ValueError(f"unknown step relation [{step.follow}]")
        staged = prefix_scan(
            staged, ["key"], "_slice", ["us", "id"], {f"_t{pos}": ("last", target)}, inclusive=False, reverse=True
        )
        to = F.col(f"_t{pos}.to")
        staged = staged.withColumn(
            f"_r{pos}",
            F.when(
                to.isNotNull(),
                F.struct(to["end_us"].alias("end_us"), F.concat(F.array("id"), to["ids"]).alias("ids"), to["dead"].alias("dead")),
            ),
        )
        if pos > 1:  # a scan reads its rows twice: without this, n scans would do the first one 2**n times
            staged = stored(staged.drop(f"_t{pos}", f"_r{pos + 1}"), "pattern-step")
    starts = staged.filter(steps[0].predicate)
    ended = F.coalesce(F.col("_r0.end_us") - F.col("us") < span, F.lit(False))
    horizon = df.agg(F.max("us").alias("m")).scalar()
    side = F.when(ended & ~F.col("_r0.dead"), "match").when(
        ~ended & (F.col("us") + span <= horizon), "timeout"
    )
    done = F.col("side") == "match"
    found = (
        starts.withColumn("side", side)
        .filter(F.col("side").isNotNull())
        .select(
            "key",
            F.col("us").alias("start_us"),
            F.when(done, F.col("_r0.end_us")).otherwise(F.col("us") + span).alias("end_us"),
            F.when(done, F.col("_r0.ids")).otherwise(F.array("id")).alias("ids"),
            "side",
        )
    )
    return Matches(found)


def pattern_followed_by(
    df: DataFrame, first: Column, second: Column, within: timedelta, width: timedelta | None = None, ranges: int | None = None
) -> Matches:
    """`first`, then (other rows allowed) `second`; one second row completes all open firsts."""
    return pattern_match(df, [Step(first), Step(second, "followed_by")], within, width, ranges)


def pattern_strict_next(
    df: DataFrame, accept: Column, within: timedelta, times: int = 3, width: timedelta | None = None, ranges: int | None = None
) -> DataFrame:
    """`times` consecutive accepted rows; overlapping matches are all reported."""
    return pattern_match(df, [Step(accept)] * times, within, width, ranges).matched


def order_texts(matches: Matches) -> tuple[DataFrame, DataFrame]:
    """The two texts of the order job: paid orders, and timeouts with their time in ms."""
    paid = matches.matched.select(
        F.concat(F.lit("orderId:"), F.col("key"), F.lit(" order-state:pay")).alias("text")
    )
    stamp = floor_div(F.col("timeout_us"), 1000)
    late = matches.timed_out.select(
        F.concat(F.lit("orderId:"), F.col("key"), F.lit(" orderTimeout-stamp:"), stamp).alias("text")
    )
    return paid, late


# ---------------------------------------------------------------------------------------
# Alert timer


def alert_timer(
    df: DataFrame, fail: Column, success: Column, delay: timedelta, width: timedelta | None = None
) -> DataFrame:
    """(key, alert_us): the first `fail` of a key arms a timer, a `success` up to its time
    cancels it, firing makes the next fail arm again. Timers beyond the last event of the
    whole input have not fired yet.

    A fail with no other fail of its episode within `delay` settles itself, in a window over
    slices with halos. Only runs of close fails are sequential: each arms or not depending on
    the one before. There every slice reports, in parallel, up to which row it would leave
    the key waiting for each possible row it is entered with; a pass over these reports (one
    row per key and slice) finds the true entries, and the slices then emit.
    """
    wait = micros(delay)
    size = max(micros(width or 64 * delay), 2 * wait)
    kind = F.when(fail, F.lit(1)).when(success, F.lit(0))
    key_type, id_type = df.schema["key"].dataType, df.schema["id"].dataType
    sliced = with_halo(
        df.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select("key", "us", "id", "kind"),
        "us", timedelta(microseconds=size), before=delay, after=delay,
    )
    part = W.partitionBy("key", "_slice")
    forward, reverse = part.orderBy("us", "id"), part.orderBy(F.desc("us"), F.desc("id"))
    row = F.struct("us", "kind")
    win = F.last(F.when(F.col("kind") == 0, F.struct("us", "id")), ignorenulls=True)

    def close_fail(other: Column) -> Column:
        near = F.abs(other["us"] - F.col("us")) <= wait
        return F.coalesce((other["kind"] == 1) & near, F.lit(False))

    fails = (
        sliced.withColumn("_before", F.lag(row).over(forward))
        .withColumn("_after", F.lag(row).over(reverse))
        .withColumn("_win", win.over(reverse.rowsBetween(W.unboundedPreceding, -1)))
        .filter(F.col("_core") & (F.col("kind") == 1))
        .withColumn("linked", close_fail(F.col("_before")) | close_fail(F.col("_after")))
        .withColumn("cancelled", F.coalesce(F.col("_win.us") <= F.col("us") + wait, F.lit(False)))
        .select(
            "key",
            F.col("_slice").alias("slice"),
            "us",
            "id",
            "linked",
            "cancelled",
            F.when(F.col("cancelled"), F.col("_win.us")).otherwise(F.col("us") + wait).alias("until_us"),
            F.when(F.col("cancelled"), F.col("_win.id")).alias("until_id"),
        )
    )
    alone = fails.filter("NOT linked AND NOT cancelled").select("key", (F.col("us") + wait).alias("alert_us"))

    place = T.StructType([T.StructField("us", T.LongType()), T.StructField("id", id_type)])
    key_field, slice_field = T.StructField("key", key_type), T.StructField("slice", T.LongType())
    report_type = T.StructType(
        [
            key_field,
            slice_field,
            T.StructField("bounds", T.ArrayType(place)),
            T.StructField("exits", T.ArrayType(place)),
        ]
    )
    entry_type = T.StructType([key_field, slice_field, T.StructField("entry", place)])
    alert_type = T.StructType([key_field, T.StructField("alert_us", T.LongType())])
    order = ["key", "slice", "us", "id"]

    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for groups in whole_groups(batches):
            out = [(*name, *_FailRun(pdf).table(name[1] * size, size, wait)) for name, pdf in groups]
            yield pd.DataFrame(out, columns=report_type.names)

    def thread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # (key, slice, what the slice leaves)
        for pdf in batches:
            out = []
            for key, number, bounds, exits in pdf.itertuples(index=False):
                adjacent = held is not None and held[0] == key and held[1] + 1 == number
                entry = held[2] if adjacent else None
                passed = 0
                if entry is not None:
                    while passed < len(bounds) and not _after(bounds[passed], entry):
                        passed += 1
                    out.append((key, number, entry))
                held = (key, number, exits[passed])
            yield pd.DataFrame(out, columns=entry_type.names)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for groups in whole_groups(batches):
            keys: list = []
            alerts: list[int] = []
            for (key, _), pdf in groups:
                fired = _FailRun(pdf).alerts(pdf["entry"].iloc[0], wait)
                keys += [key] * len(fired)
                alerts += fired
            yield pd.DataFrame({"key": pd.Series(keys, dtype=object), "alert_us": pd.Series(alerts, dtype="int64")})

    linked = fails.filter("linked").drop("linked")
    reports = linked.repartition("key", "slice").sortWithinPartitions(*order).mapInPandas(report, report_type)
    entries = reports.repartition("key").sortWithinPartitions("key", "slice").mapInPandas(thread, entry_type)
    chained = (
        linked.join(entries, ["key", "slice"], "left")
        .repartition("key", "slice")
        .sortWithinPartitions(*order)
        .mapInPandas(emit, alert_type)
    )
    horizon = df.agg(F.max("us").alias("m")).scalar()
    return alone.unionByName(chained).filter(F.col("alert_us") <= horizon)


def _after(bound, entry) -> bool:
    """Does a fail at `bound` come after the place `entry`? A place without id is a time
    that everything up to it has passed."""
    if bound["us"] != entry["us"]:
        return bound["us"] > entry["us"]
    return entry["id"] is not None and not pd.isna(entry["id"]) and bound["id"] > entry["id"]


def _passed(us: np.ndarray, ids: np.ndarray, at_us: np.ndarray, at_ids: np.ndarray) -> np.ndarray:
    """How many of the rows, sorted by (us, id), lie at or before each of the places (us, id)."""
    code = np.unique(np.concatenate([ids, at_ids]), return_inverse=True)[1]
    place = np.concatenate([np.zeros(len(us), dtype=bool), np.ones(len(at_us), dtype=bool)])
    order = np.lexsort((place, code, np.concatenate([us, at_us])))
    rows_up_to = np.cumsum(~place[order])
    out = np.empty(len(order), dtype=np.int64)
    out[order] = rows_up_to
    return out[len(us) :]


class _FailRun:
    """Close fails of one key in one time slice, in order. Each knows until where it would
    keep the key from arming again: its deadline, or the success that cancels it.

    The fail that arms after fail i is `following[i]`, so the fails that arm form a chain of
    pointers. Chains are followed by squaring them: after k steps each pointer spans 2**k
    links, for all rows at once.
    """

    def __init__(self, pdf: pd.DataFrame):
        self.us, self.id = pdf["us"].to_numpy(), pdf["id"].to_numpy()
        self.cancelled = pdf["cancelled"].to_numpy()
        self.until = pdf["until_us"].to_numpy()
        self.until_id = pdf["until_id"].to_numpy()
        following = np.searchsorted(self.us, self.until, side="right")
        some = np.flatnonzero(self.cancelled)  # rows at the very time of the success count by id
        if len(some):
            following[some] = _passed(self.us, self.id, self.until[some], self.until_id[some].astype(self.id.dtype))
        self.following = following

    def _left(self, i: int) -> dict:
        ident = self.until_id[i]
        return {"us": int(self.until[i]), "id": None if pd.isna(ident) else ident}

    def table(self, start: int, size: int, wait: int) -> tuple[list[dict], list[dict | None]]:
        """exits[i] = the place the key waits for after the slice, if i of the rows in
        `bounds` lie before the place it is entered with; None if it waits for none."""
        n, end = len(self.us), start + size
        # the end of each chain: the row whose wait leaves the slice, n if none does
        last = np.append(np.where(self.until >= end, np.arange(n), self.following), n)
        while True:
            further = last[last]
            if (further == last).all():
                break
            last = further
        early = int(np.searchsorted(self.us, start + wait, side="right"))
        at = np.flatnonzero(last[1 : early + 1] != last[:early])
        exits = [None if i == n else self._left(i) for i in last[np.append(0, at + 1)]]
        return [{"us": int(self.us[i]), "id": self.id[i]} for i in at], exits

    def _first(self, entry) -> int:
        """The first row after a place."""
        if not isinstance(entry, dict) and (entry is None or isinstance(entry, float)):
            return 0
        low, high = (int(np.searchsorted(self.us, entry["us"], side=s)) for s in ("left", "right"))
        if entry["id"] is None or pd.isna(entry["id"]):
            return high
        return low + int(np.searchsorted(self.id[low:high], entry["id"], side="right"))

    def alerts(self, entry, wait: int) -> list[int]:
        n = len(self.us)
        jump, armed = np.append(self.following, n), np.zeros(n + 1, dtype=bool)
        armed[self._first(entry)] = True
        while True:
            reached = armed.copy()
            reached[jump[armed]] = True
            if (reached == armed).all():
                break
            armed, jump = reached, jump[jump]
        return (self.us[armed[:n] & ~self.cancelled] + wait).tolist()


def whole_groups(batches: Iterator[pd.DataFrame]) -> Iterator[Iterator[tuple]]:
    """(key, slice) groups of a partition sorted by them, each whole although Arrow batches
    cut them. Yields per batch an iterator of ((key, slice), frame)."""

    def edges(pdf: pd.DataFrame) -> np.ndarray:
        keys, slices = pdf["key"].to_numpy(), pdf["slice"].to_numpy()
        same = (keys[1:] == keys[:-1]) & (slices[1:] == slices[:-1])
        return np.concatenate([[0], np.flatnonzero(~same) + 1, [len(pdf)]])

    def groups(pdf: pd.DataFrame, cuts: np.ndarray) -> Iterator[tuple]:
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            piece = pdf.iloc[lo:hi]
            yield (piece["key"].iloc[0], int(piece["slice"].iloc[0])), piece

    held: list[pd.DataFrame] = []
    for pdf in batches:
        if pdf.empty:
            continue
        cuts = edges(pdf)
        if held and len(cuts) == 2 and tuple(pdf.iloc[0][["key", "slice"]]) == tuple(held[-1].iloc[0][["key", "slice"]]):
            held.append(pdf)  # still inside one group
            continue
        if held:
            pdf = pd.concat([*held, pdf], ignore_index=True)
            cuts = edges(pdf)
        held = [pdf.iloc[cuts[-2] :]]
        if len(cuts) > 2:
            yield groups(pdf, cuts[:-1])
    if held:
        whole = pd.concat(held, ignore_index=True)
        yield groups(whole, edges(whole))


# Fixed value: text of an alert, followed by the key.
ALERT_TEXT = "报警啦，5秒没有成功，"


def alert_texts(alerts: DataFrame) -> DataFrame:
    return alerts.select(F.concat(F.lit(ALERT_TEXT), F.col("key").cast("string")).alias("text"))


# ---------------------------------------------------------------------------------------
# Late rows, idle windows, side outputs


class SplitRows(NamedTuple):
    """`tagged` has every row with `_late`; the other two are filters of it."""

    tagged: DataFrame

    @property
    def on_time(self) -> DataFrame:
        return self.tagged.filter("NOT _late").drop("_late")

    @property
    def late(self) -> DataFrame:
        return self.tagged.filter("_late").drop("_late")


def late_split(
    df: DataFrame,
    arrival: str,
    us: str,
    row_id: str,
    delay: timedelta,
    slice_width: timedelta | None = None,
    seen: DataFrame | None = None,
) -> SplitRows:
    """Rows in arrival order against the running watermark: a row older than the largest
    event time that arrived before it, minus `delay`, is late. Allowed lateness is simply a
    larger delay. The running maximum is over all rows, so it is scanned in slices of
    `slice_width`, or without one in slices of equally many rows. `seen`
    (one row, column `seen`) is the largest event time of earlier batches."""
    slices = even_slices(df, arrival) if slice_width is None else floor_div(F.col(arrival), micros(slice_width))
    staged = df.withColumn("_all", F.lit(0)).withColumn("_slice", slices)
    scanned = prefix_scan(
        staged,
        ["_all"],
        "_slice",
        [arrival, row_id],
        {"_seen": ("max", F.col(us))},
        inclusive=False,
        seed=None if seen is None else (seen.withColumn("_all", F.lit(0)), {"_seen": "seen"}),
    ).drop("_all", "_slice", "_seed__seen")
    late = F.coalesce(F.col(us) < F.col("_seen") - micros(delay), F.lit(False))
    return SplitRows(scanned.withColumn("_late", late).drop("_seen"))


def idle_close_window(
    df: DataFrame, key: str, us: str, arrival: str, size: timedelta, idle: timedelta
) -> DataFrame:
    """Firings of tumbling windows that also close `idle` after their last arrival.

    A row that comes later opens a new firing of the same window. Arrivals are first counted
    into cells no longer than `idle`: inside a cell nothing can close, so its first and last
    arrival decide, and a hot (key, window) shrinks to one row per cell before it is shuffled.
    """
    win, gap = micros(size), micros(idle)
    cells = df.groupBy(
        F.col(key).alias("key"),
        ((floor_div(F.col(us), win) + 1) * win).alias("win_end_us"),
        floor_div(F.col(arrival), gap).alias("cell"),
    ).agg(
        F.min(arrival).alias("first"), F.max(arrival).alias("last"), F.count(F.lit(1)).alias("n")
    )
    order = W.partitionBy("key", "win_end_us").orderBy("cell")
    opens = F.coalesce(F.col("first") - F.lag("last").over(order) > gap, F.lit(True))
    numbered = cells.withColumn("_open", opens.cast("int")).withColumn(
        "firing", F.sum("_open").over(order.rowsBetween(W.unboundedPreceding, 0))
    )
    return numbered.groupBy("key", "win_end_us", "firing").agg(
        F.sum("n").alias("cnt"), (F.max("last") + gap).alias("close_us")
    )


def side_outputs(df: DataFrame, tags: dict[str, Callable[[], Column] | Column]) -> dict[str, DataFrame]:
    """One operator, several outputs: each tag is a filter over the same frame."""
    return {
        name: df.filter(rule() if callable(rule) and not isinstance(rule, Column) else rule)
        for name, rule in tags.items()
    }
