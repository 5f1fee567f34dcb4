"""Conversation structure repair by aligning turns to the grammar (system? (user assistant)+)?.

Turns are kept (K), given another role (R), deleted (D), and empty turns are inserted (I) such that
the initials of the roles follow the grammar at the least cost; of equally cheap repairs the one
with the ASCII-least audit counts, an audit being the initials of its edits in order.

Every grammar string is a prefix of one of two alternating strings, with and without a system
turn. One Wagner-Fischer table against such a string holds the alignment to each feasible length
in its last row. Only a band around its diagonal is filled (Ukkonen): cells that cannot lie on a
path as cheap as the incumbent, which starts as a greedy repair and falls with every length
looked at. The cheapest lengths are traced back to their least audits, which are compared.

A conversation may hold any share of the rows. Turns are sorted over ranges of (conv_id, turn) and
cut into segments of at most `SEGMENT` alignable turns. For each segment the cheapest ways from
every grammar state to every other are found on their own; a conversation only has to chain 16
numbers a segment. Inserts belong to the turn that follows them, so audits of one segment are
never prefixes of each other and the least whole audit is made of least parts.

Defined results: rows of one turn number are ordered by role and by the digest of (role, text),
null numbers come first; null roles and texts count as one blank; rows without conv_id form one
conversation; a conversation without rows has no segment. Columns other than conv_id, turn, role
and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from slotwise.llm.common import batches, stored

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
SEGMENT, NEVER = 512, 1 << 40

#: States of the grammar; 0 is its start, and the code of a role that fits nowhere.
START, SYSTEM, USER, ASSISTANT = range(4)
CODE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Inserts that close a conversation left in a state.
CLOSING = ["", "II", "I", ""]
CLOSE = [INSERT * len(c) for c in CLOSING]
#: Bits of a turn's code beside its role.
CUT = 4
LEGAL = {"su", "ua", "au"}


# ---------------------------------------------------------------------------------------
# Alignment of one run of turns


def _state(first: int, j: int, entry: int) -> int:
    """The state after j characters of the grammar string that opens with `first`."""
    if j == 0:
        return entry
    if first == SYSTEM:
        return SYSTEM if j == 1 else USER if j % 2 == 0 else ASSISTANT
    return first if j % 2 else USER + ASSISTANT - first


def _strings(entry: int) -> list[int]:
    """Openings of the strings that may follow a state."""
    return {START: [USER, SYSTEM], SYSTEM: [USER], USER: [ASSISTANT], ASSISTANT: [USER]}[entry]


def _fixed(first: int) -> int:
    """How many leading characters cannot be inserted: a system turn is only ever kept."""
    return 1 if first == SYSTEM else 0


def _turn_cost(code: int, want: int) -> int:
    """Of a turn that becomes the wanted one: kept, or given its role."""
    cut = TRUNCATED if code & CUT else 0
    if code & 3 == want:
        return cut
    return NEVER if want == SYSTEM else REROLE + cut


def greedy(codes: bytes, entry: int) -> tuple[int, int]:
    """(cost, state) of a plain repair from left to right: the first incumbent."""
    cost, at = 0, entry
    for code in codes:
        cost += TRUNCATED if code & CUT else 0
        role = code & 3
        if role == SYSTEM and at == START:
            at = SYSTEM
        elif role in (USER, ASSISTANT):
            following = ASSISTANT if at == USER else USER
            cost += 0 if role == following else INSERT
            at = role
        else:
            cost += REROLE
            at = ASSISTANT if at == USER else USER
    return cost, at


def table(codes: bytes, first: int, limit: int) -> list[dict[int, int]]:
    """Costs by turns consumed and characters written, within the band that `limit` leaves.
    Characters written without a turn stand before one, so none is in the last row."""
    slack = limit - sum(TRUNCATED for c in codes if c & CUT)
    if slack < 0:
        return []
    ins, dels = slack // INSERT, slack // (DELETE - TRUNCATED)
    rows: list[dict[int, int]] = [{0: 0}]
    for i, code in enumerate(codes):
        here, low, high = rows[-1], max(0, i - dels), i + ins
        for j in range(max(low, _fixed(first)) + 1, high + 1):  # inserts before this turn
            cost = here.get(j - 1, NEVER) + INSERT
            if cost <= limit and cost < here.get(j, NEVER):
                here[j] = cost
        below: dict[int, int] = {}
        costs = [_turn_cost(code, w) for w in range(4)]
        for j, cost in here.items():
            if cost + DELETE <= limit and cost + DELETE < below.get(j, NEVER) and j >= i + 1 - dels:
                below[j] = cost + DELETE
            step = cost + costs[_state(first, j + 1, START)]
            if step <= limit and step < below.get(j + 1, NEVER):
                below[j + 1] = step
        rows.append(below)
    return rows


def least_audit(codes: bytes, first: int, rows: list[dict[int, int]], length: int) -> str:
    """The ASCII-least audit among the cheapest paths of a table to one length."""
    marked: list[set[int]] = [set() for _ in rows]
    marked[-1] = {length}
    for i in range(len(codes) - 1, -1, -1):  # back along all cheapest paths
        here, code = rows[i], codes[i]
        for j in marked[i + 1]:
            cost = rows[i + 1][j]
            if here.get(j, NEVER) + DELETE == cost:
                marked[i].add(j)
            if j and here.get(j - 1, NEVER) + _turn_cost(code, _state(first, j, START)) == cost:
                marked[i].add(j - 1)
        for j in range(max(marked[i], default=0), _fixed(first), -1):
            if j in marked[i] and here.get(j - 1, NEVER) + INSERT == here[j]:
                marked[i].add(j - 1)
    audit, i, j = [], 0, 0
    while i < len(codes):
        cost = rows[i][j]
        if j in marked[i + 1] and rows[i + 1][j] == cost + DELETE:
            audit.append("D")
            i += 1
        elif j >= _fixed(first) and j + 1 in marked[i] and rows[i][j + 1] == cost + INSERT:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if codes[i] & 3 == _state(first, j + 1, START) else "R")
            i, j = i + 1, j + 1
    return "".join(audit)


def aligned(codes: bytes, entry: int, close: list[int]) -> tuple[int, str, int]:
    """(cost, audit, state) of the best repair of turns that follow the state `entry`; `close` has
    the cost of what comes after each state. The cost is that of these turns alone."""
    cost, at = greedy(codes, entry)
    best = cost + close[at]
    ties: list[tuple[int, list[dict[int, int]], int]] = []
    for first in _strings(entry):
        rows = table(codes, first, best)
        for length, cost in (rows[-1] if rows else {}).items():
            total = cost + close[_state(first, length, entry)]
            if total < best:
                best, ties = total, []
            if total == best:
                ties.append((first, rows, length))
    found = {}  # the empty string opens either way
    for first, rows, length in ties:
        audit = least_audit(codes, first, rows, length)
        found[audit] = (rows[-1][length], audit, _state(first, length, entry))
    return found[min(found)]


def ways(codes: bytes, entry: int) -> list[int]:
    """The least cost to get from `entry` to each state. States that cost over 5 more than the
    cheapest are left out (`NEVER`): at most two inserts and a deletion lead from there to all
    that they allow."""
    limit = greedy(codes, entry)[0] + 6
    out = [NEVER] * 4
    for first in _strings(entry):
        rows = table(codes, first, limit)
        for length, cost in (rows[-1] if rows else {}).items():
            state = _state(first, length, entry)
            out[state] = min(out[state], cost)
    return out


# ---------------------------------------------------------------------------------------
# Segments


def _faults(text: Column) -> list[Column]:
    return [
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    ]


def _rows(turns: DataFrame) -> DataFrame:
    """Turns without nulls in role and text, with the digest that stands for both."""
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text")]
    plain = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    both = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    return plain.withColumn("digest", F.unhex(F.sha2(both, 256)))


def _narrow(rows: DataFrame) -> DataFrame:
    """One row for each distinct turn, without its text: copies counted, `later` where its role
    and text stand under an earlier number too."""
    group = ["conv_id", "turn", "role", "digest"]
    flags = rows.select(*group, *_faults(F.col("text")))
    turns = stored(flags.groupBy(*group, "blank", "cut").agg(F.count("*").alias("copies")), "turns")
    said = F.struct("conv_id", "digest").alias("said")
    first = turns.groupBy(said).agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1")
    marked = turns.withColumn("said", said).join(stored(first.drop("n"), "repeated"), "said", "left")
    later = F.coalesce(F.struct("turn") != F.col("first"), F.lit(False)).alias("later")
    return marked.select(*group, "blank", "cut", "copies", later)


_STATS = ["blank", "duplicate", "truncated", "illegal", "turns", "low", "high"]


class _Segment:
    def __init__(self, conv, span: int, number: int) -> None:
        self.conv, self.span, self.number, self.lead = conv, span, number, 0
        self.codes, self.runs, self.places, self.digests = bytearray(), [], [], []
        self.stats = dict.fromkeys(_STATS[:5], 0) | {"low": None, "high": None}
        self.first = self.last = None

    def add(self, turn, role: str, digest: bytes, blank: bool, cut: bool, copies: int, later: bool) -> None:
        initial, stats = role[:1], self.stats
        if self.first is None:
            self.first = initial
        else:
            stats["illegal"] += self.last + initial not in LEGAL
        self.last = initial
        stats["illegal"] += copies - 1
        if turn is not None:
            stats["turns"] += turn != stats["high"]
            stats["low"] = turn if stats["low"] is None else stats["low"]
            stats["high"] = turn
        gone = copies if blank or later else copies - 1
        stats["blank" if blank else "duplicate"] += gone
        if gone < copies:
            stats["truncated"] += cut
            self.codes.append(CODE.get(initial, START) | (CUT if cut else 0))
            self.runs.append(0)
            self.places.append(turn)
            self.digests.append(digest)
        if self.runs:
            self.runs[-1] += gone
        else:
            self.lead += gone

    def row(self, alone: bool) -> list:
        codes = bytes(self.codes)
        cost, audit, state = aligned(codes, START, CLOSE) if alone else (None, None, START)
        between = None if alone else [w for e in range(4) for w in ways(codes, e)]
        return [
            self.conv, self.span, self.number, self.lead, codes, self.runs, self.places, self.digests,
            [self.stats[s] for s in _STATS], [self.first, self.last], cost + CLOSE[state] if alone else None, audit + CLOSING[state] if alone else None, between,
        ]


_FIELDS = (
    "span int, seg long, lead long, codes binary, runs array<long>, places array<long>, digests array<binary>, "
    "stats array<long>, ends array<string>, cost long, audit string, ways array<long>"
)


def _with_key(df: DataFrame, fields: str) -> StructType:
    return StructType([StructField("conv_id", df.schema["conv_id"].dataType), *StructType.fromDDL(fields)])


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def segments(turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Runs of at most `size` alignable turns, in order of (span, seg). Those that are a whole
    conversation are repaired at once; a range's first and last conversation may go on elsewhere
    and, like longer ones, only get their costs between states."""
    narrow = _narrow(turns)
    order = ["conv_id", "turn", "role", "digest"]
    ranges = narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("span", F.spark_partition_id())
    schema = _with_key(turns, _FIELDS)

    def cut(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, out, now, number, begun, whole = _arrow(schema), [], None, 0, False, False
        for batch in batches_in:
            for conv, turn, role, digest, blank, short, copies, later, span in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is not None and now.conv != conv:
                    out.append(now.row(alone=whole))
                    now, begun = None, True
                    whole = True
                elif now is not None and len(now.codes) >= size and not (blank or later):
                    out.append(now.row(alone=False))
                    now, whole = None, False
                if now is None:
                    now, number = _Segment(conv, span, number), number + 1
                    whole = whole and begun
                now.add(turn, role, digest, blank, short, copies, later)
                if len(out) >= 256:
                    yield _batch(out, arrow)
                    out = []
        if now is not None:
            out.append(now.row(alone=False))
        if out:
            yield _batch(out, arrow)

    columns = [*order, "blank", "cut", "copies", "later", "span"]
    return stored(ranges.select(*columns).mapInArrow(cut, schema), "segments")


def _chained(found: DataFrame) -> DataFrame:
    """Segments of conversations with several of them, each with its state on entry and its audit."""
    place = "span int, seg long"

    def ahead(rows: pa.Table) -> pa.Table:
        """What each state costs from a segment's end on, from the last segment back."""
        rows = rows.sort_by([("span", "ascending"), ("seg", "ascending")])
        close, out = CLOSE, []
        for k, w in enumerate(reversed(rows["ways"].to_pylist())):
            out.append((close, k == 0))
            close = [min(NEVER, *(w[4 * e + x] + close[x] for x in range(4))) for e in range(4)]
        return rows.select(["span", "seg"]).append_column("close", pa.array([c for c, _ in out[::-1]], pa.list_(pa.int64()))).append_column(
            "last", pa.array([x for _, x in out[::-1]])
        )

    open_ = found.where("ways IS NOT NULL")
    close = open_.select("conv_id", "span", "seg", "ways").groupBy("conv_id").applyInArrow(ahead, f"{place}, close array<long>, last boolean")

    def each(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            out = []
            for codes, after in zip(batch["codes"].to_pylist(), batch["close"].to_pylist(), strict=True):
                out.append([aligned(codes, e, after) for e in range(4)])
            columns = [pa.array([[w[k] for w in row] for row in out], pa.list_(t)) for k, t in enumerate((pa.int64(), pa.string(), pa.int32()))]
            names = ["conv_id", "span", "seg", "last"]
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], *columns], names=[*names, "costs", "audits", "exits"])

    todo = open_.select("conv_id", "span", "seg", "codes").join(close, ["span", "seg"]).select("conv_id", "span", "seg", "codes", "close", "last")
    solved = stored(
        todo.mapInArrow(each, _with_key(found, f"{place}, last boolean, costs array<long>, audits array<string>, exits array<int>")), "solved"
    )

    def forth(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("span", "ascending"), ("seg", "ascending")])
        state, entries = START, []
        for exits in rows["exits"].to_pylist():
            entries.append(state)
            state = exits[state]
        return rows.select(["span", "seg"]).append_column("entry", pa.array(entries, pa.int32()))

    entry = solved.select("conv_id", "span", "seg", "exits").groupBy("conv_id").applyInArrow(forth, f"{place}, entry int")
    exit_ = F.get("exits", "entry")
    closing = F.when(F.col("last"), F.get(F.array(*[F.lit(c) for c in CLOSING]), exit_)).otherwise("")
    chosen = solved.join(entry, ["span", "seg"]).select(
        "span", "seg", "entry", F.concat(F.get("audits", "entry"), closing).alias("audit"),
        (F.get("costs", "entry") + INSERT * F.length(closing)).alias("cost"),
    )
    return open_.drop("audit", "cost", "ways").join(chosen, ["span", "seg"])


def repairs(turns: DataFrame, size: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """(rows, segments): the turns as they are read, and all segments with entry, cost and audit,
    both without the deletions that blank and repeated turns require, which `runs` and `lead`
    count."""
    batches(turns.sparkSession)
    rows = _rows(turns)
    found = segments(rows, size)
    alone = found.where("ways IS NULL").drop("ways").withColumn("entry", F.lit(START))
    return rows, stored(alone.unionByName(_chained(found)), "repairs")


# ---------------------------------------------------------------------------------------
# Results


def _whole_audit(lead: int, runs: list[int], audit: str) -> str:
    """With the required deletions, which stand before any insert."""
    out, i = ["D" * lead], 0
    for edit in audit:
        out.append(edit)
        if edit != "I":
            out.append("D" * runs[i])
            i += 1
    return "".join(out)


def audits(found: DataFrame) -> DataFrame:
    """(conv_id, span, seg, stats, ends, cost, audit): segments with their whole audits and costs."""
    schema = _with_key(found, "span int, seg long, stats array<long>, ends array<string>, cost long, audit string")

    def whole(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = _arrow(schema)
        for batch in batches_in:
            conv, span, seg, stats, ends, cost, audit, lead, runs = [c.to_pylist() for c in batch.columns]
            cost = [c + DELETE * (n + sum(r)) for c, n, r in zip(cost, lead, runs, strict=True)]
            audit = [_whole_audit(n, r, a) for n, r, a in zip(lead, runs, audit, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip([conv, span, seg, stats, ends, cost, audit], arrow, strict=True)], schema=arrow
            )

    return found.select("conv_id", "span", "seg", "stats", "ends", "cost", "audit", "lead", "runs").mapInArrow(whole, schema)


def _edits(found: DataFrame) -> DataFrame:
    """(conv_id, span, seg, i, edit, new_role, turn, digest): a row for each turn of the result."""
    schema = _with_key(found, "span int, seg long, i int, edit string, new_role string, turn long, digest binary")

    def spell(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, out = _arrow(schema), []
        for batch in batches_in:
            for conv, span, seg, entry, codes, places, digests, audit in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                state, i = entry, 0
                for n, edit in enumerate(audit):
                    if edit != "D":
                        kept_system = edit == "K" and codes[i] & 3 == SYSTEM
                        state = SYSTEM if kept_system else ASSISTANT if state == USER else USER
                        own = (None, None) if edit == "I" else (places[i], digests[i])
                        out.append([conv, span, seg, n, edit, None if edit == "K" else ROLE[state], *own])
                    i += edit != "I"
                if len(out) >= 1000:
                    yield _batch(out, arrow)
                    out = []
        if out:
            yield _batch(out, arrow)

    return found.select("conv_id", "span", "seg", "entry", "codes", "places", "digests", "audit").mapInArrow(spell, schema)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, span, seg, i, turn, edit, role, text): the turns of all repaired conversations, in
    order of (span, seg, i) within each; inserted ones have no number and an empty text."""
    edits = _edits(found)
    key = F.struct("conv_id", "turn", "digest").alias("key")
    texts = rows.select(key, "role", "text").groupBy("key").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    kept = edits.where("digest IS NOT NULL").withColumn("key", key).join(texts, "key")
    kept = kept.withColumn("role", F.coalesce("new_role", "role"))
    new = edits.where("digest IS NULL").withColumn("role", F.col("new_role")).withColumn("text", F.lit(""))
    columns = ["conv_id", "span", "seg", "i", "turn", "edit", "role", "text"]
    return kept.select(*columns).unionByName(new.select(*columns))


def report(conversations: DataFrame, found: DataFrame, lines: DataFrame) -> DataFrame:
    """One row for each conv_id of `conversations`: gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256 (of `role:text`, joined by line feeds).

    Rows are sorted by conversation and read as a stream, so that a long conversation is hashed
    without being held. A conversation that nothing is left of has zeros, an empty audit and the
    hash of an empty text.
    """
    none = "CAST(NULL AS {}) AS {}".format
    ids = conversations.select("conv_id").distinct().selectExpr(
        "conv_id", "0 AS kind", "0 AS span", "0L AS seg", "0 AS i", none("STRING", "line"), none("ARRAY<BIGINT>", "stats"),
        none("ARRAY<STRING>", "ends"), "0L AS cost",
    )
    parts = audits(found).selectExpr("conv_id", "1 AS kind", "span", "seg", "0 AS i", "audit AS line", "stats", "ends", "cost")
    said = lines.selectExpr(
        "conv_id", "2 AS kind", "span", "seg", "i", "concat(role, ':', text) AS line", none("ARRAY<BIGINT>", "stats"),
        none("ARRAY<STRING>", "ends"), "0L AS cost",
    )
    rows = ids.unionByName(parts).unionByName(said).repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "kind", "span", "seg", "i")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = _with_key(conversations, ", ".join(f"{n} long" for n in numbers) + ", audit string, repaired_sha256 string")

    def read(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow, out, now = _arrow(schema), [], None
        for batch in batches_in:
            for conv, kind, line, stats, ends, cost in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now is None or now.conv != conv:
                    if now is not None:
                        out.append(now.row())
                    now = _Told(conv)
                if len(out) >= 1000:
                    yield _batch(out, arrow)
                    out = []
                if kind == 1:
                    now.segment(stats, ends, cost, line)
                elif kind == 2:
                    now.said(line)
        if now is not None:
            out.append(now.row())
        if out:
            yield _batch(out, arrow)

    return rows.select("conv_id", "kind", "line", "stats", "ends", "cost").mapInArrow(read, schema)


class _Told:
    """The sums of one conversation."""

    def __init__(self, conv) -> None:
        self.conv, self.audit, self.hash, self.lines = conv, [], hashlib.sha256(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = self.cost = 0
        self.low = self.high = self.last = None

    def segment(self, stats: list, ends: list, cost: int, audit: str) -> None:
        blank, duplicate, truncated, illegal, turns, low, high = stats
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self.illegal += illegal + (self.last is not None and self.last + ends[0] not in LEGAL)
        self.last = ends[1]
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high
        self.cost += cost
        self.audit.append(audit)

    def said(self, line: str) -> None:
        self.hash.update((("\n" if self.lines else "") + line).encode())
        self.lines += 1

    def row(self) -> list:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return [
            self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest(),
        ]
