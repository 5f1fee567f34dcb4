"""Maps of changes against judging them one by one; hot ids; rounds of conditional changes."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slotwise.operators import changes, conditions

FIELDS = "seq bigint, op string, id string, a bigint, b string, doc_as_upsert boolean, if_seq_no bigint, version bigint, version_type string"


def some_changes(rnd, first, n, span=12):
    out = []
    for seq in range(first, first + n):
        op = rnd.choice(["index", "create", "update", "update", "delete"])
        asked_seq = rnd.randrange(max(-1, seq - span), seq + 1) if rnd.random() < 0.4 else None
        asked = rnd.randrange(0, 9) if asked_seq is None and op != "create" and rnd.random() < 0.5 else None
        out.append((op, rnd.random() < 0.3, asked_seq, asked, rnd.randrange(3) if asked is not None and op != "update" else 0, seq))
    return out


def one_by_one(rows, state):
    for row in rows:
        state = conditions.judge(*row, state)[1]
    return state


def as_map(rows):
    run = conditions.Run(rows[0][-1])
    for row in rows:
        run.add(*row)
    return run.pieces


def test_maps_like_judging_one_by_one():
    rnd = random.Random(1)
    for _ in range(300):
        first, n = rnd.randrange(5, 30), rnd.randrange(1, 12)
        rows = some_changes(rnd, first, n)
        pieces = as_map(rows)
        for present in (False, True):
            for seq in range(-1, first):
                for version in range(-1, 12):
                    state = (present, seq, version)
                    assert conditions.applied(pieces, state) == one_by_one(rows, state)


def test_composed_maps_like_the_whole():
    rnd = random.Random(2)
    for _ in range(150):
        first = rnd.randrange(3, 20)
        rows = some_changes(rnd, first, 15, span=25)
        cuts = sorted(rnd.sample(range(1, 15), 2))
        parts = [rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] :]]
        a, b, c = [as_map(p) for p in parts]
        left = conditions.followed(conditions.followed(a, b, first), c, first)
        right = conditions.followed(a, conditions.followed(b, c, parts[1][0][-1]), first)
        for present in (False, True):
            for seq in range(-1, first):
                for version in range(0, 11):
                    state = (present, seq, version)
                    assert conditions.applied(left, state) == conditions.applied(right, state) == one_by_one(rows, state)


def mixed(seed, n, hot=0.9, start=0):
    """Changes of which one id has nine of ten, mixing versions of all kinds with other writes."""
    rnd, out = random.Random(seed), []
    for seq in range(start, start + n):
        op, inserts, asked_seq, asked, kind, _ = some_changes(rnd, seq, 1)[0]
        if asked is not None:
            asked = rnd.randrange(max(0, (seq - start) // 3 - 4), (seq - start) // 2 + 3)
        how = None if asked is None else ["internal", "external", "external_gte"][kind]
        ident = "hot" if rnd.random() < hot else f"k{rnd.randrange(5)}"
        out.append((seq, op, ident, seq, rnd.choice([None, "x"]), inserts, asked_seq, asked, how))
    return out


def fold(ops, states, rows):
    outcomes = {}
    for seq, op, ident, a, b, inserts, asked_seq, asked, how in ops:
        kind = {"external": 1, "external_gte": 2}.get(how, 0)
        before = states.get(ident, conditions.ABSENT)
        result, states[ident] = conditions.judge(op, inserts, asked_seq, asked, kind, seq, before)
        if result in ("created", "updated") and (op != "update" or result == "created"):
            rows[ident] = (a, b)
        elif result == "updated":
            rows[ident] = tuple(new if new is not None else old for new, old in zip((a, b), rows[ident]))
        elif states[ident] is not before and op == "delete":
            rows.pop(ident, None)
        outcomes[seq] = result
    return outcomes


@pytest.mark.parametrize("seed, ranges", [(0, 60), (1, 20), (2, 3), (3, None)])
def test_one_id_with_nine_of_ten_changes(spark, seed, ranges):
    ops = mixed(seed, 900)
    base = spark.createDataFrame([("hot", 1, "z", 4, 7), ("k1", 1, "z", -1, 0), ("still", 5, "q", 3, 9)], "id string, a bigint, b string, _seq_no bigint, _version bigint")
    states = {"hot": (True, 4, 7), "k1": (True, -1, 0), "still": (True, 3, 9)}
    rows = {"hot": (1, "z"), "k1": (1, "z"), "still": (5, "q")}
    want = fold(ops, states, rows)
    out = changes.apply_changes(base, spark.createDataFrame(ops, FIELDS), "id", ["a", "b"], conditional=True, ranges=ranges)
    assert {r.seq: r.result for r in out.outcomes.collect()} == want
    assert {r.id: (r.a, r.b, r["_seq_no"], r["_version"]) for r in out.table.collect()} == {k: (*v, *states[k][1:]) for k, v in rows.items()}


def test_no_range_holds_a_hot_id_alone(spark):
    ops = spark.createDataFrame(mixed(5, 5000), FIELDS).repartition(3)
    ranged = ops.repartitionByRange(60, "id", "seq").groupBy(F.spark_partition_id().alias("p")).count()
    assert ranged.agg(F.max("count")).first()[0] < 5000 / 20


@pytest.mark.parametrize("seed", range(3))
def test_rounds_follow_each_other(spark, seed):
    table = spark.createDataFrame([("hot", 1, "z")], "id string, a bigint, b string")
    states, rows = {"hot": (True, -1, 0)}, {"hot": (1, "z")}
    for round_ in range(3):
        ops = mixed(10 * seed + round_, 120, hot=0.5, start=200 * round_)
        want = fold(ops, states, rows)
        out = changes.apply_changes(table, spark.createDataFrame(ops, FIELDS), "id", ["a", "b"], conditional=True, ranges=7)
        assert {r.seq: r.result for r in out.outcomes.collect()} == want
        states = {k: s for k, s in states.items() if s[0]}  # deleted ids are forgotten after a set
        table = spark.createDataFrame(out.table.collect(), out.table.schema)
        assert {r.id: (r.a, r.b, r["_seq_no"], r["_version"]) for r in table.collect()} == {k: (*v, *states[k][1:]) for k, v in rows.items()}


def test_no_changes(spark):
    base = spark.createDataFrame([("k", 1, "z")], "id string, a bigint, b string")
    out = changes.apply_changes(base, spark.createDataFrame([], FIELDS), "id", ["a", "b"], conditional=True)
    assert out.outcomes.count() == 0 and [tuple(r) for r in out.table.select("id", "a", "_seq_no", "_version").collect()] == [("k", 1, -1, 0)]


def test_ids_may_share_a_sequence_number(spark):
    ops = [(seq, "index" if k % 2 else "create", f"k{k}", k, "x", False, None, None, None) for seq in (1, 2) for k in range(40)]
    ops += [(2, "delete", "k40", None, None, False, None, None, None), (None, "index", "k41", 1, "x", False, None, None, None)]
    base = spark.createDataFrame([("k40", 1, "z")], "id string, a bigint, b string")
    out = changes.apply_changes(base, spark.createDataFrame(ops, FIELDS), "id", ["a", "b"], conditional=True, ranges=6)
    want = {(1, f"k{k}", "created") for k in range(40)} | {(2, f"k{k}", "updated" if k % 2 else "conflict") for k in range(40)}
    told = [(r.seq, r.id, r.result) for r in out.outcomes.collect()]
    assert len(told) == 81 and set(told) == want | {(2, "k40", "deleted")}
    table = {r.id: (r.a, r["_seq_no"], r["_version"]) for r in out.table.collect()}
    assert table == {f"k{k}": (k, 1 + k % 2, 1 + k % 2) for k in range(40)}


@pytest.mark.parametrize("seed, ids, missing", [(0, 200, False), (1, 200, True), (2, 20, False), (3, 1, False)])
def test_many_ids_at_once_as_one_by_one(seed, ids, missing):
    rnd, rows, begins = random.Random(seed), [], []
    for _ in range(ids):
        start = rnd.choice([conditions.ABSENT, (True, rnd.randrange(len(rows) + 1), rnd.randrange(9))])
        begins.append(len(rows))
        for op, *asks, seq in some_changes(rnd, len(rows), rnd.choice([1, 2, 3, 4, 90])):
            rows.append((rnd.choice([op, op, None]), *asks, None if missing and rnd.random() < 0.1 else seq, *start))
    names = [*conditions.JUDGED_BY, "present0", "seq0", "version0"]
    kinds = [pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
    batch = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)
    done = conditions.Judged(batch)
    last = done.many_ids(np.array(begins))
    want, state = [], None
    for at, row in enumerate(rows):
        before = row[6:] if at in begins else state
        result, state = conditions.judge(*row[:6], before)
        want.append((result, state[2] if state is not before else None))
    assert list(zip(*[c.to_pylist() for c in done.columns()])) == want and last == state
