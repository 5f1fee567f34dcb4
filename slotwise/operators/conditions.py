"""Changes that depend on the sequence number or version they find.

The state of an id is (present, sequence number, version). A run of changes turns each possible
state into another one, and does so piece by piece: the pieces are told apart by presence, by
equality with the sequence numbers that conditions name, and by intervals of the version; within
a piece the run either leaves the state alone or ends with a known number and a version that is
a constant or a fixed distance from the one it began with. Such maps are composed like functions.

All changes are sorted over ranges of (id, seq). An id that begins within a range is judged at once,
from the state the base has of it. The first id of a range may have begun in an earlier one: its
changes there become a map, and so does the end of a range's last id. Maps, two a range at
most, are composed in a tree; the states its leaves are entered with come back down, and the
changes that waited for them are judged in their ranges.

A change keeps the columns that are needed of it along that way, so no join has to find it again.
Ids that begin in a batch are judged together, the first change of each, then the second.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from slotwise.session import stored

State = tuple[bool, int, int]  # present, sequence number, version
ABSENT: State = (False, -1, 0)
LOW, HIGH = -(1 << 63), (1 << 63) - 1
#: Maps composed by one task of one level of the tree.
FAN = 16
#: Fewer ids than this are not worth being judged together.
FEW = 16
#: How a version is compared.
INTERNAL, EXTERNAL, EXTERNAL_GTE = range(3)


# ---------------------------------------------------------------------------------------
# One change


def judge(op: str, inserts: bool, asked_seq: int | None, asked: int | None, kind: int, seq: int, state: State) -> tuple[str, State]:
    """Outcome of a change and the state after it."""
    present, found, version = state
    if asked_seq is not None and not (present and asked_seq == found):
        return "conflict", state
    if asked is not None:
        passed = (present and asked == version) if kind == INTERNAL else asked > version - (kind == EXTERNAL_GTE)
        if not passed:
            return "conflict", state
    after = asked if asked is not None and kind != INTERNAL else version + 1
    if op == "index":
        return ("updated" if present else "created"), (True, seq, after)
    if op == "create":
        return ("conflict", state) if present else ("created", (True, seq, after))
    if op == "delete":
        return ("deleted" if present else "not_found"), (False, seq, after)
    if present:
        return "updated", (True, seq, after)
    return ("created", (True, seq, after)) if inserts else ("not_found", state)


# ---------------------------------------------------------------------------------------
# Maps: pieces (present, seq or None, low, high, out). A piece that names a number goes before
# those that name none. `out` is None for a state left alone, else (present, seq, fixed, version),
# the version being added to the one found unless it is fixed.

Out = tuple[bool, int, bool, int] | None
Piece = tuple[bool, int | None, int, int, Out]
IDENTITY: list[Piece] = [(False, None, LOW, HIGH, None), (True, None, LOW, HIGH, None)]


def _merged(pieces: list[Piece]) -> list[Piece]:
    """Neighbouring intervals that end alike become one."""
    out: list[Piece] = []
    for p in sorted(pieces, key=lambda p: (p[0], p[1] is not None, p[1] or 0, p[2])):
        if out and out[-1][:2] == p[:2] and out[-1][4] == p[4] and out[-1][3] + 1 == p[2]:
            out[-1] = (*p[:2], out[-1][2], p[3], p[4])
        else:
            out.append(p)
    return out


class Run:
    """The map of consecutive changes of one id, grown change by change. States it may be entered
    with have numbers below that of the first change."""

    def __init__(self, first: int) -> None:
        self.first, self.pieces = first, list(IDENTITY)

    def add(self, op: str, inserts: bool, asked_seq: int | None, asked: int | None, kind: int, seq: int) -> None:
        grown: list[Piece] = []
        for piece in self.pieces:
            for present, named, low, high, out in self._split(piece, asked_seq, asked, kind):
                at, number, fixed, version = out or (present, named, False, 0)
                found = version if fixed else low + version  # one that stands for the whole interval
                known = number if number is not None else LOW
                result, after = judge(op, inserts, asked_seq, asked, kind, seq, (at, known, found))
                if result == "conflict" or (result == "not_found" and op == "update"):
                    grown.append((present, named, low, high, out))
                elif asked is not None and kind != INTERNAL:
                    grown.append((present, named, low, high, (after[0], seq, True, asked)))
                else:
                    grown.append((present, named, low, high, (after[0], seq, fixed, version + 1)))
        self.pieces = _merged(grown)

    def _split(self, piece: Piece, asked_seq: int | None, asked: int | None, kind: int) -> list[Piece]:
        """Parts of a piece for each of which the change passes or fails as a whole."""
        present, named, low, high, out = piece
        parts = [piece]
        if asked_seq is not None and out is None and present and named is None and asked_seq < self.first:
            own = [p[2:4] for p in self.pieces if p[0] and p[1] == asked_seq]
            parts += [(present, asked_seq, a, b, out) for a, b in _rest(low, high, own)]
        if asked is None or (out is not None and out[2]):
            return parts
        turn = asked - (out[3] if out else 0)  # the version found at which the answer changes
        edges = {INTERNAL: (turn, turn + 1), EXTERNAL: (turn,), EXTERNAL_GTE: (turn + 1,)}[kind]
        for edge in edges:
            cut = []
            for p, n, a, b, o in parts:
                cut += [(p, n, a, edge - 1, o), (p, n, edge, b, o)] if a < edge <= b else [(p, n, a, b, o)]
            parts = cut
        return parts


def _rest(low: int, high: int, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What is left of an interval without some disjoint ones."""
    out = []
    for a, b in sorted(taken):
        if a <= high and b >= low:
            if a > low:
                out.append((low, a - 1))
            low = b + 1
    return [*out, (low, high)] if low <= high else out


def _view(pieces: list[Piece], present: bool, seq: int | None) -> list[tuple[int, int, Out]]:
    """Intervals of the version and their ends, for states with a number (None: any not named)."""
    own = [p[2:] for p in pieces if seq is not None and p[:2] == (present, seq)]
    taken = [o[:2] for o in own]
    plain = [p[2:] for p in pieces if p[:2] == (present, None)]
    return own + [(a, b, end) for low, high, end in plain for a, b in _rest(low, high, taken)]


def followed(first: list[Piece], then: list[Piece], start: int) -> list[Piece]:
    """The map of one run after another; `start` is the number of the first change of all."""
    names = {p[1] for p in first if p[1] is not None} | {p[1] for p in then if p[1] is not None and p[1] < start}
    out: list[Piece] = []
    for present in (False, True):
        for seq in (None, *(sorted(names) if present else ())):
            for low, high, end in _view(first, present, seq):
                at, number, fixed, version = end or (present, seq, False, 0)
                for a, b, last in _view(then, at, number):
                    if fixed:
                        x, y = (low, high) if a <= version <= b else (0, -1)
                    else:
                        x, y = max(low, a - version), min(high, b - version)
                    if x > y:
                        continue
                    if last is None:
                        whole = end
                    elif last[2]:
                        whole = last
                    else:
                        whole = (last[0], last[1], fixed, version + last[3])
                    out.append((present, seq, x, y, whole))
    return _merged(out)


def applied(pieces: list[Piece], state: State) -> State:
    present, seq, version = state
    for low, high, end in _view(pieces, present, seq if present else None):
        if low <= version <= high:
            return state if end is None else (end[0], end[1], end[3] if end[2] else version + end[3])
    raise ValueError("a map covers every state")


# ---------------------------------------------------------------------------------------
# Many ids at once

RESULTS = ["created", "updated", "deleted", "not_found", "conflict"]
CREATED, UPDATED, DELETED, NOT_FOUND, CONFLICT = range(5)
OPS = ["index", "create", "delete"]
INDEX, CREATE, DELETE, UPDATE = range(4)
#: Outcome of a change whose conditions hold, by operation, presence and whether it inserts.
OUTCOME = np.array(
    [
        [[CREATED, CREATED], [UPDATED, UPDATED]],
        [[CREATED, CREATED], [CONFLICT, CONFLICT]],
        [[NOT_FOUND, NOT_FOUND], [DELETED, DELETED]],
        [[NOT_FOUND, CREATED], [UPDATED, UPDATED]],
    ]
)
JUDGED_BY = ["op", "inserts", "asked_seq", "asked", "kind", "seq"]


def _begins(ids: pa.Array) -> np.ndarray:
    """Places of the rows with another id than the row before; the first row is not among them."""
    if pa.types.is_nested(ids.type):
        values = ids.to_pylist()
        return np.flatnonzero([a != b for a, b in zip(values, values[1:])]) + 1
    before, after = ids.slice(0, max(len(ids) - 1, 0)), ids.slice(1)
    differ = pc.or_(pc.fill_null(pc.not_equal(before, after), False), pc.xor(before.is_valid(), after.is_valid()))
    return np.flatnonzero(differ.to_numpy(zero_copy_only=False)) + 1


def _rows(batch: pa.RecordBatch, low: int, high: int) -> Iterator[tuple]:
    """The arguments of `judge`, but for the state, from some rows."""
    return zip(*[batch.column(c).slice(low, high - low).to_pylist() for c in JUDGED_BY], strict=True)


class Judged:
    """Outcomes of a batch: `result` (-1: none yet), whether the change took effect, the version after it."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        size = batch.num_rows
        self.batch = batch
        self.result, self.took, self.after = np.full(size, -1, "int8"), np.zeros(size, bool), np.zeros(size, "int64")

    def one_id(self, low: int, high: int, state: State) -> State:
        """Judge consecutive rows of one id; the state after them."""
        for at, change in enumerate(_rows(self.batch, low, high), low):
            result, after = judge(*change, state)
            self.result[at] = RESULTS.index(result)
            if after is not state:
                self.took[at], self.after[at] = True, after[2]
            state = after
        return state

    def many_ids(self, begins: np.ndarray) -> State:
        """Judge the rows from the first of `begins` on, at each of which an id begins; the state
        after the last row."""
        batch = self.batch

        def column(name: str, missing: int | bool = 0) -> np.ndarray:
            return batch.column(name).fill_null(missing).to_numpy(zero_copy_only=False)

        op = pc.index_in(batch.column("op"), pa.array(OPS, batch.column("op").type)).fill_null(UPDATE).to_numpy(zero_copy_only=False)
        inserts, kind, seq = column("inserts", False).astype("int8"), column("kind"), column("seq")
        asked_seq, asked = column("asked_seq"), column("asked")
        names_seq, names = (batch.column(c).is_valid().to_numpy(zero_copy_only=False) for c in ("asked_seq", "asked"))
        sizes = np.diff(begins, append=batch.num_rows)
        order = np.argsort(-sizes, kind="stable")
        at, sizes = begins[order], sizes[order]
        present, number, version = column("present0", False)[at], column("seq0")[at], column("version0")[at]
        few = FEW if batch.column("seq").null_count == 0 else len(at) + 1  # a missing number equals none

        done, going = 0, len(at)
        while (going := int(np.searchsorted(-sizes, -done))) >= few:
            row = at[:going] + done
            here, found, known = present[:going], version[:going], names[row]
            a, how, what = asked[row], kind[row], op[row]
            passed = ~names_seq[row] | (here & (asked_seq[row] == number[:going]))
            fits = np.where(how == INTERNAL, here & (a == found), np.where(how == EXTERNAL, a > found, a >= found))
            passed &= ~known | fits
            result = np.where(passed, OUTCOME[what, here.astype("int8"), inserts[row]], CONFLICT)
            took = (result != CONFLICT) & ((result != NOT_FOUND) | (what == DELETE))
            given = known & (how != INTERNAL)
            if (took & ~given & (found == HIGH)).any():
                raise OverflowError("a version does not fit 64 bits")
            after = np.where(given, a, found + 1)
            self.result[row], self.took[row], self.after[row] = result, took, after
            present[:going] = np.where(took, what != DELETE, here)
            number[:going] = np.where(took, seq[row], number[:going])
            version[:going] = np.where(took, after, found)
            done += 1
        last = int(np.argmax(at))
        state = (bool(present[last]), int(number[last]), int(version[last]))
        for i in range(going):
            left = self.one_id(int(at[i]) + done, int(at[i] + sizes[i]), (bool(present[i]), int(number[i]), int(version[i])))
            state = left if i == last else state
        return state

    def columns(self) -> tuple[pa.Array, pa.Array]:
        """The outcome and, where the change took effect, the version after it."""
        result = pa.array(RESULTS).take(pa.array(self.result, mask=self.result < 0))
        return result, pa.array(self.after, mask=~self.took)


# ---------------------------------------------------------------------------------------
# All changes

_CHANGE = "seq long, op string, inserts boolean, asked_seq long, asked long, kind int, present0 boolean, seq0 long, version0 long"
_RESULT = "result string, after long, map string"


def _schema(kind: StructField, ddl: str) -> StructType:
    return StructType([StructField("id", kind.dataType), *StructType.fromDDL(ddl)])


def judged(
    ops: DataFrame, base: DataFrame, id_col: str, inserts: Column, ranges: int | None = None, carried: Sequence[str] = ()
) -> DataFrame:
    """(id, seq, op, result, _in_base, _after and the columns `carried`) for each change: its outcome,
    whether the base has its id, and the version after it where it took effect. `ranges` is the
    number of ranges (Spark's default for shuffles if not given)."""
    external = F.col("version_type")
    kind = F.when(external == "external", EXTERNAL).when(external == "external_gte", EXTERNAL_GTE).otherwise(INTERNAL)
    kept = [f"carried{i}" for i in range(len(carried))]  # so that no name is taken twice
    changes = ops.select(
        "id", "seq", "op", inserts.alias("inserts"), F.col("if_seq_no").cast("long").alias("asked_seq"),
        F.col("version").cast("long").alias("asked"), kind.alias("kind"), *[F.col(c).alias(k) for c, k in zip(carried, kept)],
    )
    start = base.select(
        F.col(id_col).alias("id"), F.lit(True).alias("present0"), F.col("_seq_no").cast("long").alias("seq0"),
        F.col("_version").cast("long").alias("version0"),
    )
    rows = changes.join(start, "id", "left").withColumn("present0", F.coalesce("present0", F.lit(False)))
    rows = rows.withColumns({"seq0": F.coalesce("seq0", F.lit(ABSENT[1])), "version0": F.coalesce("version0", F.lit(ABSENT[2]))})
    order = ["id", "seq"]
    ranged = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    names = [f.name for f in StructType.fromDDL(_CHANGE).fields]
    kinds = [StructField(k, ops.schema[c].dataType) for c, k in zip(carried, kept)]
    schema = StructType([*_schema(ops.schema["id"], f"part int, {_CHANGE}, {_RESULT}").fields, *kinds])
    entry = ["present0", "seq0", "version0"]

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)

        def at(batch: pa.RecordBatch, row: int) -> State:
            return tuple(batch.column(c)[row].as_py() for c in entry)

        now, begun, state, run, first, part = None, False, None, None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            done, begins = Judged(batch), _begins(batch.column("id"))
            end = int(begins[0]) if len(begins) else batch.num_rows  # of the rows of the batch's first id
            waits = False
            if not begun:
                part, begun, waits = batch.column("part")[0].as_py(), True, True
                now, first, run = batch.column("id")[0].as_py(), at(batch, 0), Run(batch.column("seq")[0].as_py())
            elif batch.column("id")[0].as_py() != now:
                begins, end = np.insert(begins, 0, 0), 0
            else:
                waits = run is not None
            if waits:
                for change in _rows(batch, 0, end):
                    run.add(*change)
            elif end:
                state = done.one_id(0, end, state)
            if len(begins):
                if run is not None:  # the first id of the range ends here
                    yield _end(now, part, run, None, first, arrow)
                    run = None
                state = done.many_ids(begins)
                now, first = batch.column("id")[-1].as_py(), at(batch, int(begins[-1]))
            result, after = done.columns()
            out = dict(zip(batch.schema.names, batch.columns, strict=True)) | {"result": result, "after": after}
            # only maps need the state, only changes that wait what they are judged by
            spare = {"map", "seq0", "version0"} if waits else {"map", "seq0", "version0", "inserts", "asked_seq", "asked", "kind"}
            columns = [pa.nulls(batch.num_rows, f.type) if f.name in spare else out[f.name] for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, names=arrow.names)
        if begun:
            yield _end(now, part, run, state, first, arrow)

    done = stored(ranged.select("id", "part", *names, *kept).mapInArrow(first_pass, schema), "judged")
    maps = done.where("map IS NOT NULL").select("id", "part", *entry, "map")
    entries = _entries(maps).select(F.struct("id", "part").alias("key"), F.col("state.*"))
    fields = ["part", "inserts", "asked_seq", "asked", "kind", "id", "seq", "op", "present0", *kept]
    waiting = done.where("map IS NULL AND result IS NULL").select(F.struct("id", "part").alias("key"), *fields)
    late = StructType(
        [*_schema(ops.schema["id"], "seq long, op string, _in_base boolean, result string, _after long").fields, *kinds]
    )

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done, parts = Judged(batch), batch.column("part")
            begins = [0, *_begins(parts).tolist()] if batch.num_rows else []
            for low, high in zip(begins, [*begins[1:], batch.num_rows]):
                if parts[low].as_py() != now:
                    now, state = parts[low].as_py(), tuple(batch.column(c)[low].as_py() for c in ("present", "number", "version"))
                state = done.one_id(low, high, state)
            result, after = done.columns()
            columns = [batch.column(c) for c in ("id", "seq", "op", "present0")] + [result, after] + [batch.column(k) for k in kept]
            yield pa.RecordBatch.from_arrays(columns, names=late.names)

    # one id of a range waits, so the range stands for both
    later = waiting.join(entries, "key").repartition("part").sortWithinPartitions("part", "seq")
    later = later.select(*fields, "present", "number", "version").mapInArrow(second_pass, late)
    at_once = done.where("map IS NULL AND result IS NOT NULL")
    at_once = at_once.select("id", "seq", "op", F.col("present0").alias("_in_base"), "result", F.col("after").alias("_after"), *kept)
    return at_once.unionByName(later).withColumnsRenamed(dict(zip(kept, carried)))


def _end(ident, part: int, run: Run | None, state: State | None, entry: State, schema: pa.Schema) -> pa.RecordBatch:
    """The row of a map: that of the run, or the constant state that an id was left with."""
    pieces = run.pieces if run is not None else [(p, None, LOW, HIGH, (state[0], state[1], True, state[2])) for p in (False, True)]
    body = json.dumps([run.first if run is not None else LOW, pieces])
    given = {"id": ident, "part": part, "present0": entry[0], "seq0": entry[1], "version0": entry[2], "map": body}
    return pa.RecordBatch.from_arrays([pa.array([given.get(f.name)], f.type) for f in schema], schema=schema)


def _read(body: str) -> tuple[int, list[Piece]]:
    first, pieces = json.loads(body)
    return first, [(p, n, a, b, None if o is None else tuple(o)) for p, n, a, b, o in pieces]


def _entries(maps: DataFrame) -> DataFrame:
    """(id, part, state) for each map: the state its range is entered with.

    Maps of `FAN` neighbouring ranges are composed, the compositions again, until one is left for
    an id; then states go down the tree. Levels follow from the number of ranges.
    """
    most = maps.agg(F.max("part")).first()[0] or 0
    level = maps.withColumn("state", F.struct(F.col("present0").alias("present"), F.col("seq0").alias("number"), F.col("version0").alias("version")))
    level = level.select("id", "part", "state", "map")
    group = F.struct("id", F.expr(f"part div {FAN}").cast("int").alias("above")).alias("group")
    state = "state struct<present: boolean, number: long, version: long>"

    def composed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        whole = None
        for start, pieces in map(_read, rows["map"].to_pylist()):
            whole = (start, pieces) if whole is None else (whole[0], followed(whole[1], pieces, whole[0]))
        return rows.slice(0, 1).drop_columns(["group", "map", "part"]).append_column(
            "part", pa.array([rows["group"][0].as_py()["above"]], pa.int32())
        ).append_column("map", pa.array([json.dumps(whole)], pa.string()))

    def entered(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        now, out = tuple(rows["state"][0].as_py().values()), []
        for _, pieces in map(_read, rows["map"].to_pylist()):
            out.append(dict(zip(("present", "number", "version"), now)))
            now = applied(pieces, now)
        kind = rows.schema.field("state").type
        return rows.select(["id", "part"]).append_column("state", pa.array(out, kind))

    levels = [level]
    while most >= FAN:
        schema = StructType([*_schema(maps.schema["id"], f"{state}, part int, map string").fields])
        above = levels[-1].withColumn("group", group).groupBy("group").applyInArrow(composed, schema)
        levels.append(stored(above, "maps"))
        most //= FAN
    top = levels[-1].withColumn("group", F.struct("id"))
    found_schema = _schema(maps.schema["id"], f"part int, {state}")
    found = top.groupBy("group").applyInArrow(entered, found_schema)
    for level in reversed(levels[:-1]):
        given = found.select(F.struct("id", F.col("part").alias("above")).alias("group"), "state")
        below = level.withColumn("group", group).drop("state").join(given, "group")
        found = below.groupBy("group").applyInArrow(entered, found_schema)
    return found
