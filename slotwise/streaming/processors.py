"""Keyed state processors; each gives the rows of its batch form.

Timers fire only after all rows of a micro-batch. So every processor first works through
the rows of its key in event order, settling deadlines as it passes them, and registers a
timer only for what is still open at the end. Rows within a key come in event order across
micro-batches; older ones than the watermark are dropped by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from slotwise.functions.schema import struct
from slotwise.operators.joins import LEFT, RIGHT


def transform(
    df: DataFrame, keys: str | list[str], processor: StatefulProcessor, schema: T.StructType, mode: str = "EventTime"
) -> DataFrame:
    """Run a processor per key, its timers in event time or by the clock (`ProcessingTime`)."""
    keys = [keys] if isinstance(keys, str) else keys
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode=mode
    )


def after_ms(us: int) -> int:
    """The first millisecond after `us`: a timer there fires when `us` is surely past."""
    return us // 1000 + 1


def in_order(rows: Iterator[pd.DataFrame], by: list[str]) -> pd.DataFrame:
    """One key's rows of one micro-batch, sorted. The size of a micro-batch is bounded by
    the source options, and with it what a key can hold here."""
    return pd.concat(list(rows), ignore_index=True).sort_values(by, kind="stable").reset_index(drop=True)


def frame(schema: T.StructType, rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=schema.names)


JOINED = struct(
    key="string", right_id="bigint", right_us="bigint", left_id="bigint", left_value="string", fire_us="bigint"
)


class ConsumeOnceJoin(StatefulProcessor):
    """Right rows take the stored left row of their key, if it is younger than the ttl.

    Only the row before a right row matters, so the state is one left row, and a batch of
    rows is compared with itself shifted by one. With a delay (microseconds), a match waits
    for a quiet time without a further right row.
    """

    def __init__(self, ttl: int, delay: int | None = None):
        self.ttl, self.delay = ttl, delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stored = handle.getValueState("stored", "us bigint, id bigint, value string")
        self.pending = handle.getValueState(
            "pending", "right_id bigint, right_us bigint, left_id bigint, left_value string"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        name = key[0]
        pdf = in_order(rows, ["us", "side", "id"])
        stored = self.stored.get() if self.stored.exists() else None
        first = [(LEFT, *stored)] if stored else [(RIGHT, 0, -1, None)]
        prev = pd.concat(
            [pd.DataFrame(first, columns=["side", "us", "id", "value"]), pdf[["side", "us", "id", "value"]].iloc[:-1]],
            ignore_index=True,
        )
        found = (
            (pdf["side"] == RIGHT)
            & (prev["side"] == LEFT)
            & (pdf["us"] - prev["us"] < self.ttl)
            & prev["value"].notna()
            & (prev["value"].astype(str).str.strip() != "")
        )
        matches = pd.DataFrame(
            {
                "right_id": pdf["id"], "right_us": pdf["us"], "left_id": prev["id"], "left_value": prev["value"],
                "found": found,
            }
        )[pdf["side"] == RIGHT]
        last = pdf.iloc[-1]
        if last["side"] == LEFT:
            self.stored.update((int(last["us"]), int(last["id"]), last["value"]))
            self.handle.registerTimer(after_ms(int(last["us"]) + self.ttl))
        elif stored:
            self.stored.clear()

        if self.delay is None:
            out = matches[matches["found"]]
            fires = out["right_us"]
        else:
            out = self._settle(matches)
            fires = out["right_us"] + self.delay
        if len(out):
            yield pd.DataFrame(
                {
                    "key": name, "right_id": out["right_id"], "right_us": out["right_us"],
                    "left_id": out["left_id"], "left_value": out["left_value"], "fire_us": fires,
                }
            )

    def _settle(self, matches: pd.DataFrame) -> pd.DataFrame:
        """Matches no further right row cancels; the last one stays pending."""
        if matches.empty:
            return matches
        if self.pending.exists():
            held = pd.DataFrame([(*self.pending.get(), True)], columns=matches.columns)
            matches = pd.concat([held, matches], ignore_index=True)
            self.pending.clear()
        following = matches["right_us"].shift(-1)
        last = matches.iloc[-1]
        if last["found"]:
            self.pending.update(
                (int(last["right_id"]), int(last["right_us"]), int(last["left_id"]), last["left_value"])
            )
            self.handle.registerTimer(after_ms(int(last["right_us"]) + self.delay))
        return matches[matches["found"] & (following > matches["right_us"] + self.delay)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        if self.stored.exists() and after_ms(self.stored.get()[0] + self.ttl) <= now:
            self.stored.clear()
        if self.delay is not None and self.pending.exists():
            held = self.pending.get()
            if after_ms(held[1] + self.delay) <= now:
                self.pending.clear()
                yield frame(JOINED, [(key[0], *held, held[1] + self.delay)])

    def close(self) -> None:
        pass


ALERT = struct(key="string", alert_us="bigint")


class AlertTimer(StatefulProcessor):
    """First fail arms, success cancels, firing alerts; input column `kind`: 1 fail, 0 success."""

    def __init__(self, delay: int):
        self.delay = delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.deadline = handle.getValueState("deadline", "us bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, ["us", "id"])
        armed = self.deadline.get()[0] if self.deadline.exists() else None
        before, out = armed, []
        for us, kind in zip(pdf["us"].tolist(), pdf["kind"].tolist()):
            if armed is not None and armed < us:
                out.append((key[0], armed))
                armed = None
            if kind == 0:
                armed = None
            elif armed is None:
                armed = us + self.delay
        if armed != before:
            if before is not None:
                self.handle.deleteTimer(after_ms(before))
            if armed is None:
                self.deadline.clear()
            else:
                self.deadline.update((armed,))
                self.handle.registerTimer(after_ms(armed))
        if out:
            yield frame(ALERT, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.deadline.exists():
            armed = self.deadline.get()[0]
            if after_ms(armed) <= expiredTimerInfo.getExpiryTimeInMs():
                self.deadline.clear()
                yield frame(ALERT, [(key[0], armed)])

    def close(self) -> None:
        pass


MATCHED = struct(
    key="string", start_us="bigint", end_us="bigint", ids="array<bigint>", side="string"
)


class PatternMatch(StatefulProcessor):
    """Step sequences. Input columns p0, p1, …: does the row satisfy step 0, 1, …?

    State: the open matches of a key, none older than the time limit.
    """

    def __init__(self, follows: list[str], within: int):
        self.follows, self.within = follows, within

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "start_us bigint, step int, ids array<bigint>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, ["us", "id"])
        steps = len(self.follows)
        tests = pdf[[f"p{i}" for i in range(steps)]].fillna(False).to_numpy(dtype=bool)
        held = [(s, k, list(ids)) for s, k, ids in self.open.get()]
        out = []
        for us, ident, passes in zip(pdf["us"].tolist(), pdf["id"].tolist(), tests):
            live = []
            for start, done, ids in held:
                if us - start >= self.within:
                    out.append((key[0], start, start + self.within, ids[:1], "timeout"))
                elif passes[done + 1]:
                    if done + 2 == steps:
                        out.append((key[0], start, us, [*ids, ident], "match"))
                    else:
                        live.append((start, done + 1, [*ids, ident]))
                elif self.follows[done + 1] == "followed_by":
                    live.append((start, done, ids))
            if passes[0]:
                live.append((us, 0, [ident]))
            held = live
        self._keep(held)
        if out:
            yield frame(MATCHED, out)

    def _keep(self, held: list[tuple]) -> None:
        if held:
            self.open.put(held)
            self.handle.registerTimer(after_ms(min(h[0] for h in held) + self.within - 1))
        else:
            self.open.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        held = [(s, k, list(ids)) for s, k, ids in self.open.get()]
        due = [h for h in held if h[0] + self.within <= now * 1000]
        if due:
            self._keep([h for h in held if h[0] + self.within > now * 1000])
            yield frame(MATCHED, [(key[0], s, s + self.within, ids[:1], "timeout") for s, _, ids in due])

    def close(self) -> None:
        pass


FIRED = struct(key="string", win_end_us="bigint", cnt="bigint", close_us="bigint")


class IdleCloseWindow(StatefulProcessor):
    """Windows that close `idle` after their last arrival. Event time here is the arrival
    time, the clock the original takes from the wall; key is (key, win_end_us)."""

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "cnt bigint, last bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        arrivals = np.sort(pd.concat(list(rows))["arrival"].to_numpy())
        cnt, last = self.window.get() if self.window.exists() else (0, int(arrivals[0]))
        gaps = np.diff(np.concatenate([[last], arrivals])) > self.idle
        pieces = np.split(arrivals, np.flatnonzero(gaps))
        out = []
        for pos, piece in enumerate(pieces):
            if pos > 0:
                out.append((key[0], int(key[1]), cnt, last + self.idle))
                cnt = 0
            if len(piece):
                cnt, last = cnt + len(piece), int(piece[-1])
        self.window.update((cnt, last))
        self.handle.registerTimer(after_ms(last + self.idle))
        out = [o for o in out if o[2] > 0]
        if out:
            yield frame(FIRED, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.window.exists():
            cnt, last = self.window.get()
            if after_ms(last + self.idle) <= expiredTimerInfo.getExpiryTimeInMs():
                self.window.clear()
                yield frame(FIRED, [(key[0], int(key[1]), cnt, last + self.idle)])

    def close(self) -> None:
        pass


class IdleCloseByClock(StatefulProcessor):
    """Windows that close `idle` after their last arrival by the clock of the executors, also if no
    further row comes. Key is (key, win_end_us); rows carry how many events they stand for (`n`).
    `close_us` is the time of closing. Runs in processing-time mode."""

    def __init__(self, idle: int):
        self.idle_ms = max(1, idle // 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "cnt bigint, timer bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        cnt = sum(int(pdf["n"].sum()) for pdf in rows)
        if self.window.exists():
            held, timer = self.window.get()
            cnt += held
            self.handle.deleteTimer(timer)
        timer = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
        self.window.update((cnt, timer))
        self.handle.registerTimer(timer)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.window.exists():
            cnt, timer = self.window.get()
            if timer <= expiredTimerInfo.getExpiryTimeInMs():
                self.window.clear()
                yield frame(FIRED, [(key[0], int(key[1]), cnt, timer * 1000)])

    def close(self) -> None:
        pass


RUNNING = struct(key="string", id="bigint", running="bigint")


class RunningSum(StatefulProcessor):
    """Running sum of the integer column `value` per key, one output row per input row."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, ["us", "id"])
        start = self.total.get()[0] if self.total.exists() else 0
        running = start + pdf["value"].cumsum()
        self.total.update((int(running.iloc[-1]),))
        yield pd.DataFrame({"key": key[0], "id": pdf["id"], "running": running})

    def close(self) -> None:
        pass


COMBINED = struct(subtask="string", flush="bigint", key="string", combined="bigint")


class LocalCombine(StatefulProcessor):
    """Sum of `value` per `item` within a subtask, emitted every `batch` rows.

    Of a key's rows only numbers are held, items as their places among the distinct ones; sums go out
    in pieces.
    """

    def __init__(self, batch: int):
        self.batch = batch

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "rows bigint")
        self.kept = handle.getMapState("kept", "item string", "combined bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        places: dict[str, int] = {}
        parts = [_numbers(pdf, places) for pdf in rows]
        us, ident, item, value = (np.concatenate(c) for c in zip(*parts, strict=True))
        del parts
        order = np.lexsort((ident, us))
        item, value = item[order], value[order]
        del us, ident, order
        seen = self.seen.get()[0] if self.seen.exists() else 0
        total = seen + len(item)
        held = [(k[0], v[0]) for k, v in self.kept.iterator()]
        flush = (seen + np.arange(len(item))) // self.batch - seen // self.batch
        if held:
            old = [places.setdefault(k, len(places)) if k is not None else -1 for k, _ in held]
            flush = np.concatenate([np.zeros(len(held), np.int64), flush])
            item, value = np.concatenate([np.array(old, np.int64), item]), np.concatenate([np.array([v for _, v in held], np.int64), value])
        some = item >= 0  # a group needs an item
        width = max(len(places), 1)
        groups, at = np.unique(flush[some] * width + item[some], return_inverse=True)
        sums = np.zeros(len(groups), np.int64)
        np.add.at(sums, at, value[some])
        names = np.array(list(places), dtype=object)
        done = groups // width < total // self.batch - seen // self.batch
        self.seen.update((total,))
        self.kept.clear()
        for group, combined in zip(groups[~done], sums[~done]):
            self.kept.updateValue((names[group % width],), (int(combined),))
        groups, sums = groups[done], sums[done]
        for start in range(0, len(groups), PIECE):
            some = groups[start : start + PIECE]
            yield pd.DataFrame(
                {"subtask": key[0], "flush": seen // self.batch + some // width, "key": names[some % width], "combined": sums[start : start + PIECE]}
            )

    def close(self) -> None:
        pass


#: Rows given back at a time.
PIECE = 50_000


def _numbers(pdf: pd.DataFrame, places: dict[str, int]) -> tuple[np.ndarray, ...]:
    """Order, id, item and value of some rows; a missing number goes last, a missing item is -1."""
    last = np.iinfo(np.int64).max
    codes, names = pd.factorize(pdf["item"])
    own = np.array([places.setdefault(n, len(places)) for n in names] + [-1], np.int64)  # -1 is the last place
    whole = [pdf[c].array if pdf[c].dtype == np.int64 else [last if pd.isna(v) else int(v) for v in pdf[c]] for c in ("us", "id")]
    value = pdf["value"].fillna(0).to_numpy(np.int64)
    return (*[np.asarray(c, np.int64) for c in whole], own[codes], value)


TOTALS = struct(key="string", win_end="timestamp", cnt="bigint", total="bigint")


class CumulativeWindows(StatefulProcessor):
    """Running total per key over closed windows (columns win_end, cnt)."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = in_order(rows, ["win_end"])
        start = self.total.get()[0] if self.total.exists() else 0
        totals = start + pdf["cnt"].cumsum()
        self.total.update((int(totals.iloc[-1]),))
        yield pd.DataFrame({"key": key[0], "win_end": pdf["win_end"], "cnt": pdf["cnt"], "total": totals})

    def close(self) -> None:
        pass
