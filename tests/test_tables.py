import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from slotwise.functions.skew import hot_keys, lookup_join
from slotwise.operators import changes, entities, joins, predicates, routing
from slotwise.plans import datasets
from slotwise.sources import catalog, mapping, sinks, slots


# ---- slots ------------------------------------------------------------------------------


def test_slots_stay_inside_their_shards_and_prune(spark, tmp_path):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 37).cast("string").alias("r"))
    placed = routing.assign_slot(df, "id", 4, 18, "r", batch="b1")
    got = placed.collect()
    assert all(r.slot * 4 <= r.shard < r.slot * 4 + 4 for r in got)
    assert max(r.shard for r in got) <= 15  # the two left-over shards stay unused
    assert len({r.shard - r.slot * 4 for r in got}) == 1  # one draw per batch
    path = str(tmp_path / "t")
    slots.write_slots(placed, path)
    pruned = slots.read_slots(spark, path, ["5", "8"], 4)
    assert "PartitionFilters: [slot" in pruned._jdf.queryExecution().executedPlan().toString()
    exact = pruned.filter(F.col("r").isin("5", "8"))
    assert rows(exact.select("id")) == rows(df.filter(F.col("r").isin("5", "8")).select("id"))
    assert pruned.count() > exact.count()  # other values of the same slots come along
    assert slots.read_slots(spark, path).count() == 500
    with pytest.raises(ValueError):
        routing.slot_prune(placed, ["5"], -1)
    with pytest.raises(ValueError):
        routing.require_routing([])


def test_slices_partition_the_whole(spark):
    df = spark.range(1000)
    parts = [set(r.id for r in routing.slice_rows(df, "id", i, 3).collect()) for i in range(3)]
    assert set.union(*parts) == set(range(1000)) and sum(map(len, parts)) == 1000


def test_least_loaded_shard(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (3,)], "shard int")
    assert tuple(routing.pick_least_loaded(df, spark, [0, 1, 3]).first()) == (1, 1)
    assert tuple(routing.pick_least_loaded(df, spark, [0, 1, 2, 3]).first()) == (2, 0)


# ---- joins ------------------------------------------------------------------------------


def test_lookup_join_salts_hot_keys_and_keeps_all_rows(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert [r.k for r in hot_keys(left, ["k"], 0.1).collect()] == [7]
    for how in ("left", "inner"):
        salted = lookup_join(left, right, ["k"], ["id"], how, share=0.1, salts=8)
        plain = left.join(right, "k", how)
        order = lambda r: (r[1], r[0])
        got = sorted(map(tuple, salted.select("k", "id", "v").collect()), key=order)
        assert got == sorted(map(tuple, plain.select("k", "id", "v").collect()), key=order)


def test_replace_by_key_keeps_incoming_duplicates(spark):
    base = spark.createDataFrame([(1, "old"), (2, "old"), (3, "old")], "k int, v string")
    incoming = spark.createDataFrame(
        [(1, "a", "d1"), (1, "b", "d1"), (2, "c", "d1"), (2, "c", "d2"), (9, "n", "d2")], "k int, v string, dir string"
    )
    out = joins.replace_by_key(base, incoming, ["k"])
    assert rows(out.table) == [(1, "a"), (1, "b"), (2, "c"), (2, "c"), (3, "old"), (9, "n")]
    assert out.removed.first()[0] == 3  # (d1,1), (d1,2), (d2,2)
    empty = joins.replace_by_key(base.limit(0), incoming, ["k"])
    assert empty.removed.first()[0] == 0
    assert joins.check_load("k", "a, b,", 0) == ["a", "b"]
    for bad in [("", "a", 0), ("k", "", 0), ("k", "a", -1)]:
        with pytest.raises(ValueError):
            joins.check_load(*bad)


# ---- changes ----------------------------------------------------------------------------


def fold(base, ops, detect_noop=False):
    """The state after each change, one after the other."""
    table = {k: dict(v) for k, v in base.items()}
    outcomes = {}
    meta = {k: (-1, 0) for k in base}
    for op in sorted(ops, key=lambda o: o["seq"]):
        ident, kind, doc = op["id"], op["op"], {f: op.get(f) for f in ("a", "b")}
        present = ident in table
        seq, version = meta.get(ident, (-1, 0))
        cas, asked, how = op.get("if_seq_no"), op.get("version"), op.get("version_type")
        result = None
        if cas is not None and not (present and cas == seq):
            result = "conflict"
        elif asked is not None:
            if how == "external":
                ok = asked > version
            elif how == "external_gte":
                ok = asked >= version
            else:
                ok = present and asked == version
            result = None if ok else "conflict"
        if result is None:
            if kind == "index":
                result = "updated" if present else "created"
                table[ident] = doc
            elif kind == "create":
                result = "conflict" if present else "created"
                if not present:
                    table[ident] = doc
            elif kind == "delete":
                result = "deleted" if present else "not_found"
                table.pop(ident, None)
            elif present:
                new = {**table[ident], **{f: v for f, v in doc.items() if v is not None}}
                result = "noop" if detect_noop and new == table[ident] else "updated"
                table[ident] = new
            elif op.get("doc_as_upsert"):
                result = "created"
                table[ident] = doc
            else:
                result = "not_found"
            if result not in ("conflict", "noop") and not (result == "not_found" and kind == "update"):
                external = asked is not None and how in ("external", "external_gte")
                meta[ident] = (op["seq"], asked if external else version + 1)
        outcomes[op["seq"]] = result
    return table, outcomes


SCHEMA = (
    "seq bigint, op string, id string, a bigint, b string, doc_as_upsert boolean, "
    "if_seq_no bigint, version bigint, version_type string"
)


def random_ops(rng, n, conditional):
    ops = []
    for seq in range(n):
        ident = rng.choice(["hot"] * 3 + [f"k{rng.randrange(8)}"])
        op = {
            "seq": seq, "op": rng.choice(["index", "create", "update", "update", "update", "delete"]), "id": ident,
            "a": rng.choice([None, 1, 2]), "b": rng.choice([None, "x", "y"]), "doc_as_upsert": rng.random() < 0.2,
            "if_seq_no": None, "version": None, "version_type": None,
        }
        if conditional:
            if ident == "k7":
                op.update(op=rng.choice(["index", "delete"]), version=rng.randrange(60), version_type=rng.choice(["external", "external_gte"]))
            elif ident == "k6":
                op.update(version=rng.choice([None, 1, 2, 3]), op=rng.choice(["index", "update", "delete"]))
            elif op["op"] != "create" and rng.random() < 0.5:
                op["if_seq_no"] = max(-1, seq - rng.randrange(4))
        ops.append(op)
    return ops


def as_frames(spark, base, ops):
    base_df = spark.createDataFrame([(k, v["a"], v["b"]) for k, v in base.items()], "id string, a bigint, b string")
    names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
    return base_df, spark.createDataFrame([tuple(o[n] for n in names) for o in ops], SCHEMA)


@pytest.mark.parametrize("slice_rows", [7, 1000])
@pytest.mark.parametrize("detect_noop", [False, True])
def test_changes_against_one_by_one(spark, slice_rows, detect_noop):
    base = {"hot": {"a": 5, "b": "z"}, "k1": {"a": None, "b": "x"}, "untouched": {"a": 0, "b": None}}
    ops = random_ops(random.Random(slice_rows), 300, conditional=False)
    base_df, ops_df = as_frames(spark, base, ops)
    out = changes.apply_changes(base_df, ops_df, "id", ["a", "b"], detect_noop, slice_rows=slice_rows)
    table, outcomes = fold(base, ops, detect_noop)
    assert {r.id: {"a": r.a, "b": r.b} for r in out.table.collect()} == table
    assert {r.seq: r.result for r in out.outcomes.collect()} == outcomes
    assert out.outcomes.filter("status IS NULL").count() == 0


@pytest.mark.parametrize("slice_rows, ranges", [(7, 40), (60, 7), (1000, None)])
def test_conditional_changes_against_one_by_one(spark, slice_rows, ranges):
    base = {"hot": {"a": 5, "b": "z"}, "k7": {"a": 1, "b": "q"}, "k6": {"a": 1, "b": "q"}}
    ops = random_ops(random.Random(slice_rows + 1), 400, conditional=True)
    base_df, ops_df = as_frames(spark, base, ops)
    out = changes.apply_changes(base_df, ops_df, "id", ["a", "b"], conditional=True, slice_rows=slice_rows, ranges=ranges)
    table, outcomes = fold(base, ops)
    assert {r.seq: r.result for r in out.outcomes.collect()} == outcomes
    assert {r.id: {"a": r.a, "b": r.b} for r in out.table.collect()} == table


@pytest.mark.parametrize("seed", range(4))
def test_long_chains_of_conditions_on_one_id(spark, seed):
    """Each change names the one before, some come late or name a lost one."""
    rng = random.Random(seed)
    base = {"hot": {"a": 1, "b": "z"}} if seed % 2 else {}
    ops, names = [], [f.split(" ")[0] for f in SCHEMA.split(", ")]
    for seq in range(300):
        op = dict.fromkeys(names) | {"seq": seq, "id": "hot", "a": seq, "doc_as_upsert": rng.random() < 0.02}
        op["op"] = rng.choice(["update"] * 8 + ["index", "index", "delete", "create"])
        if op["op"] != "create" and rng.random() < 0.93:
            op["if_seq_no"] = seq - rng.choice([1, 1, 1, 1, 1, 2, 3, 9, -4])
        ops.append(op)
    base_df, ops_df = as_frames(spark, base, ops)
    table, outcomes = fold(base, ops)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = changes.apply_changes(base_df, ops_df, "id", ["a", "b"], conditional=True, ranges=11)
        assert {r.seq: r.result for r in out.outcomes.collect()} == outcomes
        assert {r.id: {"a": r.a, "b": r.b} for r in out.table.collect()} == table
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("seed", range(3))
def test_hot_id_with_external_versions(spark, seed):
    rng = random.Random(seed)
    base = {"hot": {"a": 1, "b": "z"}} if seed % 2 else {}
    names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
    ops = []
    for seq in range(200):
        op = dict.fromkeys(names) | {"seq": seq, "id": "hot", "a": seq, "doc_as_upsert": False}
        op.update(op=rng.choice(["index", "delete"]), version=rng.randrange(1, 4 + seq // 3))
        op["version_type"] = rng.choice(["external", "external_gte"])
        ops.append(op)
    base_df, ops_df = as_frames(spark, base, ops)
    table, outcomes = fold(base, ops)
    out = changes.apply_changes(base_df, ops_df, "id", ["a", "b"], conditional=True, ranges=5)
    assert {r.seq: r.result for r in out.outcomes.collect()} == outcomes
    assert {r.id: {"a": r.a, "b": r.b} for r in out.table.collect()} == table


def test_changes_in_two_batches_equal_one(spark):
    base = {"hot": {"a": 5, "b": "z"}}
    ops = random_ops(random.Random(9), 120, conditional=False)
    base_df, ops_df = as_frames(spark, base, ops)
    whole = changes.apply_changes(base_df, ops_df, "id", ["a", "b"]).table
    first = changes.apply_changes(base_df, ops_df.filter("seq < 60"), "id", ["a", "b"]).table
    second = changes.apply_changes(first, ops_df.filter("seq >= 60"), "id", ["a", "b"]).table
    key = lambda r: r.id
    assert sorted(second.collect(), key=key) == sorted(whole.collect(), key=key)


def test_update_inserts_its_upsert_document(spark):
    base = spark.createDataFrame([("p", 1)], "id string, a bigint")
    ops = spark.createDataFrame(
        [(1, "update", "p", 2, (9,)), (2, "update", "q", 3, (7,)), (3, "update", "q", 4, None), (4, "update", "z", 1, None)],
        "seq bigint, op string, id string, a bigint, upsert struct<a: bigint>",
    )
    out = changes.apply_changes(base, ops, "id", ["a"])
    assert rows(out.table) == [("p", 2), ("q", 4)]
    assert [r[0] for r in rows(out.outcomes.select("seq", "result").select("result"))] == ["created", "not_found", "updated", "updated"]


def test_validation_rules(spark):
    ops = spark.createDataFrame(
        [
            ("create", "1", 3, None, None, None, "{}", None, 0, False),
            ("create", "1", None, "external", 4, None, "{}", None, 0, False),
            ("delete", None, None, None, None, None, "{}", None, 0, False),
            ("index", "", None, None, None, "", "{}", None, 0, False),
            ("index", "é" * 257, None, None, None, None, "{}", None, 0, False),
            ("index", None, 4, None, None, None, "{}", None, 0, False),
            ("update", "1", None, None, None, None, None, None, 0, True),
            ("update", "1", None, None, 3, None, "{}", "s", 2, True),
            ("index", None, None, None, None, None, "{}", None, 0, False),
        ],
        "op string, id string, version bigint, version_type string, if_seq_no bigint, pipeline string, doc string, script string, "
        "retry_on_conflict int, doc_as_upsert boolean",
    )
    checked = changes.validate_ops(ops)
    assert checked.good.count() == 1
    found = sorted(tuple(sorted(r.errors)) for r in checked.bad.collect())
    assert ("a version needs an id",) in found
    assert ("an id is required",) in found
    assert ("id is too long",) in found
    assert ("id must not be empty", "pipeline must not be empty") in found
    assert ("create does not support explicit versions",) in found
    assert ("create does not support compare and set", "create supports only internal versioning") in found
    assert ("doc_as_upsert needs a doc", "script or doc is missing") in found
    assert ("compare and set excludes retries", "compare and set excludes upsert", "script and doc exclude each other") in found


def test_pre_transforms_use_defaults_and_report(spark):
    ops = spark.createDataFrame([(1, None, 5), (2, "_none", 5), (3, "fail", 5), (4, "gone", 5)], "seq bigint, pipeline string, v bigint")
    registry = {
        "twice": lambda df: df.withColumn("v", F.col("v") * 2),
        "fail": lambda df: df.withColumn("failure", F.lit("broken")),
    }
    out = changes.pre_transforms(ops, registry, table_default="twice", template_default="fail")
    assert rows(out.rows.select("seq", "v")) == [(1, 10), (2, 5)]
    assert rows(out.outcomes.select("seq", "result")) == [(3, "failed"), (4, "failed")]


def test_auto_ids_repeat(spark):
    df = spark.createDataFrame([(None, "f", 1), (None, "f", 2), ("x", "f", 3)], "id string, file string, pos bigint")
    first = rows(changes.auto_id(df, "id", "file", "pos"))
    assert first == rows(changes.auto_id(df.repartition(3), "id", "file", "pos"))
    assert len({r[0] for r in first}) == 3 and ("x", "f", 3) in first


def test_reindex_reports_conflicts(spark):
    source = spark.createDataFrame([("t1", 1, 0), ("t1", 2, 0), ("t2", 2, 0), ("t2", 3, 0)], "_table string, id int, ord int")
    dest = spark.createDataFrame([(3,)], "id int")
    out = changes.reindex(source, dest, "id", ["ord"])
    assert rows(out.added.select("_table", "id")) == [("t1", 1), ("t1", 2)]
    assert rows(out.conflicts.select("_table", "id", "reason")) == [
        ("t2", 2, "earlier source row"), ("t2", 3, "in destination"),
    ]


# ---- entities ---------------------------------------------------------------------------


def people(spark):
    return spark.createDataFrame(
        [(1, 1, "ann", 3), (2, 0, "bob", 4), (3, 1, "", 5)], "id bigint, valid int, user_name string, age int"
    )


def test_conditions_and_examples(spark):
    df = people(spark)
    where = lambda *c: [r[0] for r in rows(predicates.where_conditions(df, c).select("id"))]
    assert where(("EQ", "userName", "ann")) == [1]
    assert where(("GE", "age", None), ("GT", "age", True)) == [1, 2, 3]  # skipped values
    assert where(("IN", "age", [3, None, 5])) == [1, 3]
    assert where(("IN", "userName", [])) == [3]
    assert where(("LIKE", "userName", "%b%"), ("LT", "age", 10)) == [2]
    assert where(("EQ", "userName", "x' OR '1'='1")) == []
    with pytest.raises(ValueError):
        predicates.by_example(df, {"userName": None})
    assert predicates.by_example(df, {}, [("SORT_DESC", "age", None)], allow_empty=True).count() == 3
    sorted_ids = [r.id for r in predicates.by_example(df, {"valid": 1}, [("SORT_DESC", "age", None)]).collect()]
    assert sorted_ids == [3, 1]
    assert predicates.select_by_id(df, 2).count() == 1  # the flag does not matter


def test_entity_writes(spark):
    df = people(spark)
    assert rows(entities.update_selective_by_id(df, {"age": 9}, 2).filter("id = 2"))[0][3] == 4  # not valid
    assert rows(entities.update_by_id(df, {"age": None, "id": 8}, 1).filter("id = 1"))[0][3] is None
    with pytest.raises(ValueError):
        entities.update_selective_by_id(df, {"age": None, "id": 3}, 1)
    with pytest.raises(ValueError):
        entities.update_selective(df, {"age": 1}, {})
    with pytest.raises(ValueError):
        entities.delete_by_example(df, {"valid": 1}, ["user_name", "age"])
    assert entities.delete_by_example(df, {"age": 4}, ["age"]).count() == 2
    assert entities.delete_by_id_logically(df, 2).filter("valid = 0").count() == 1
    assert entities.delete_by_id(df, 1).count() == 2
    assert entities.insert_one(df, {"id": 4, "userName": "dan"}).filter("id = 4 AND valid IS NULL").count() == 1
    with pytest.raises(ValueError):
        entities.insert_one(df, {"noSuch": 1})


# ---- sources, catalog, datasets -----------------------------------------------------------


def test_mapping_types(spark):
    schema = mapping.mapping_to_struct(
        '{"doc": {"dynamic": false, "properties": {"n": {"type": "long"}, "f": {"type": "half_float"}, "o": {"properties": '
        '{"x": {"type": "keyword"}}}, "l": {"type": "nested", "properties": {"y": {"type": "integer"}}}, "raw": {"type": "object"}}}}'
    )
    assert schema.simpleString() == "struct<n:bigint,f:float,o:struct<x:string>,l:array<struct<y:int>>,raw:string>"
    assert isinstance(mapping.mapping_to_struct({"properties": {"d": {"type": "date"}}})["d"].dataType, T.TimestampType)
    with pytest.raises(ValueError):
        mapping.mapping_to_struct({"properties": {"g": {"type": "geo_shape"}}})


MAPPED = {
    "properties": {
        "n": {"type": "long"}, "t": {"type": "date"}, "d": {"type": "date", "format": "date_time"},
        "s": {"type": "date", "format": "epoch_second"}, "p": {"type": "date", "format": "dd/MM/yyyy||epoch_millis"},
        "b": {"type": "boolean"}, "l": {"type": "nested", "properties": {"y": {"type": "integer"}}},
        "o": {"properties": {"x": {"type": "double"}}}, "k": {"type": "keyword"},
    }
}


def test_mapping_reads_numbers_quoted_numbers_dates_and_single_objects(spark):
    docs = [
        '{"n": "5", "t": 1635212345678, "d": "2021-10-26T01:39:05.678Z", "s": 1635212345, "p": "26/10/2021", "b": "true",'
        ' "l": {"y": "7"}, "o": {"x": "1.5"}, "k": 12}',
        '{"n": 5.9, "t": "2021-10-26T01:39:05.678Z", "d": "2021-10-26T03:39:05.678+02:00", "p": "1635212345678", "b": false,'
        ' "l": [{"y": 1}, {"y": 2}], "k": "twelve"}',
        "{}",
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, doc string")
    out = mapping.read_with_mapping(df, MAPPED)
    assert out.schema["t"].dataType == T.TimestampType() and out.columns[0] == "id"
    millis = [F.unix_millis(c).alias(c) for c in ("t", "d", "s", "p")]
    one, two, none = out.select("id", "n", *millis, "b", "l", "o", "k").orderBy("id").collect()
    at = 1635212345678
    day = 1635206400000
    assert (one.n, one.t, one.d, one.s, one.p, one.b) == (5, at, at, 1635212345000, day, True)
    assert [v.y for v in one.l] == [7] and one.o.x == 1.5 and one.k == "12"
    assert (two.n, two.t, two.d, two.s, two.p, two.b) == (5, at, at, None, at, False)
    assert [v.y for v in two.l] == [1, 2] and two.o is None and two.k == "twelve"
    assert all(v is None for v in list(none)[1:])
    assert mapping.unfit(df, MAPPED).count() == 0


def test_mapping_names_fields_that_do_not_fit(spark):
    docs = ['{"n": "many", "t": 5, "l": [{"y": 1}, {"y": "x"}], "o": {"x": "y"}}', '{"d": 5, "b": 1, "n": 99999999999999999999}', '{"l": 3}']
    df = spark.createDataFrame(list(enumerate(docs)), "id int, doc string")
    got = {r.id: sorted(r.fields) for r in mapping.unfit(df, MAPPED).collect()}
    assert got == {0: ["l", "n", "o"], 1: ["b", "d", "n"], 2: ["l"]}
    assert mapping.read_with_mapping(df, MAPPED).filter("id = 1").first().n is None


def test_routes_and_unknown_apps(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "app string, v int")
    out = sinks.route_sink(df, "app", F.col("v"), {"a": (["h1", "h2"], "t")})
    assert rows(out.good) == [("h1,h2", "t", None, "1")] and rows(out.bad) == [("b", 2)]


def test_alias_routing_algebra():
    free = catalog.Alias("x", ("t1", "t2"))
    bound = catalog.Alias("x", ("t1",), routing=frozenset({"1", "2"}))
    assert catalog.effective_routing(free, None) == {"t1": None, "t2": None}
    assert catalog.effective_routing(free, ["9"]) == {"t1": {"9"}, "t2": {"9"}}
    assert catalog.effective_routing(bound, None) == {"t1": {"1", "2"}}
    assert catalog.effective_routing(bound, ["2", "3"]) == {"t1": {"2"}}
    assert catalog.effective_routing(bound, ["3"]) == {}
    assert catalog.resolve_names("a*,x", ["ab", "ac", "b"], [free]) == ["ab", "ac", "t1", "t2"]
    with pytest.raises(ValueError):
        catalog.resolve_names("nope", ["ab"])


def test_result_formats_and_parameters(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5), "a"), (datetime(2024, 1, 2), "o'b")], "t timestamp, s string")
    shown = datasets.format_result(df.limit(1), datasets.ResultFormat(zone="GMT+8"))
    assert rows(shown) == [("2024-01-02 11:04:05", "a")]
    number = datasets.format_result(df.limit(1), datasets.ResultFormat(timestamp=datasets.NUMBER))
    assert rows(number)[0][0] == 1704164645000
    assert datasets.format_result(df, datasets.ResultFormat(timestamp=datasets.NONE)).schema == df.schema
    df.createOrReplaceTempView("sw_test_dataset")
    ds = datasets.DataSet("d", "SELECT s FROM sw_test_dataset WHERE array_contains(:names, s)")
    assert rows(datasets.dataset_query(spark, ds, {"names": ["o'b", "x"]})) == [("o'b",)]
    ds = datasets.DataSet("d", "SELECT s FROM sw_test_dataset WHERE s IN (:names) AND size(:names) < 3", {"names": []})
    assert rows(datasets.dataset_query(spark, ds, {"names": ["o'b", "x"]})) == [("o'b",)]
    assert rows(datasets.dataset_query(spark, datasets.DataSet("e", "SELECT s FROM sw_test_dataset WHERE s IN (:n)", {"n": []}))) == []
    with pytest.raises(ValueError):
        datasets.chart_query(spark, [datasets.ChartSeries("nope", "x", "y")], {}, {})
