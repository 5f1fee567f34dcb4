import json
import random

import pytest

from slotwise.sources.bulk_ndjson import read_bulk_ndjson


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def test_bulk_lines_become_changes(spark, tmp_path):
    text = "\r\n".join(
        [
            '{"index":{"_id":"1","routing":"r","version":7,"version_type":"external"}}',
            '{"a":1}',
            "",
            '{"delete":{"_id":"2"}}',
            '{"create":{"_id":"3"}}',
            '{"delete":{"_id":"looks like an action"}}',
            '{"update":{"_id":"4","_retry_on_conflict":3,"if_seq_no":5}}',
            '{"doc":{"a":2},"doc_as_upsert":true}',
            '{"index":{"_id":"5","opType":"create","_source":{"includes":["a"]}}}',
            '{"b":[1,2]}',
            '{"index":{}}',
            '{"no":"id"}',
        ]
    )
    parsed = read_bulk_ndjson(spark, write(tmp_path, "a.ndjson", text + "\r\n"))
    got = [
        (r.line, r.op, r.id, r.routing, r.version, r.if_seq_no, r.retry_on_conflict, r.doc, r.doc_as_upsert)
        for r in parsed.changes.orderBy("line").collect()
    ]
    assert got == [
        (1, "index", "1", "r", 7, None, None, '{"a":1}', None),
        (4, "delete", "2", None, None, None, None, None, None),
        (5, "create", "3", None, None, None, None, '{"delete":{"_id":"looks like an action"}}', None),
        (7, "update", "4", None, None, 5, 3, '{"a":2}', True),
        (9, "create", "5", None, None, None, None, '{"b":[1,2]}', None),
        (11, "index", None, None, None, None, None, '{"no":"id"}', None),
    ]
    assert parsed.bad.count() == 0


def test_bad_actions_keep_their_document(spark, tmp_path):
    lines = [
        '{"merge":{"_id":"1"}}', '{"a":1}',
        '{"index":{"_id":"2","colour":"red"}}', '{"a":2}',
        '{"index":{"_id":"3","_shard_no":"4"}}', '{"a":3}',
        "not json", '{"a":4}',
        '{"index":{"_id":"5"}}',
    ]
    parsed = read_bulk_ndjson(spark, write(tmp_path, "b.ndjson", "\n".join(lines)))
    bad = [(r.line, r.doc, r.reason) for r in parsed.bad.orderBy("line").collect()]
    assert bad == [
        (1, '{"a":1}', "unknown action"),
        (3, '{"a":2}', "unknown key colour"),
        (5, '{"a":3}', "shard is set by the request only"),
        (7, '{"a":4}', "malformed action"),
        (9, None, "document line missing"),
    ]
    assert parsed.changes.count() == 0
    allowed = read_bulk_ndjson(spark, str(tmp_path / "b.ndjson"), default_shard="1")
    assert [r.id for r in allowed.changes.collect()] == ["3"]


@pytest.mark.parametrize("seed", [1, 2])
def test_roles_survive_any_block_cut(spark, tmp_path, seed):
    rng = random.Random(seed)
    want = {}
    for name in ("x", "y"):
        lines, expected = [], []
        for i in range(700):
            op = rng.choice(["index", "create", "update", "delete", "delete"] if i > 250 else ["index", "create"])
            if i > 250 and rng.random() < 0.1:
                lines.append("")
            meta = {"_id": f"{name}{i}", "routing": "r" * rng.randrange(40)}
            lines.append(json.dumps({op: meta}, separators=(",", ":")))
            doc = None
            if op != "delete":
                doc = json.dumps({rng.choice(["index", "delete", "v"]): {"n": i}}, separators=(",", ":"))
                lines.append(json.dumps({"doc": json.loads(doc)}) if op == "update" else doc)
            expected.append((op, f"{name}{i}", doc))
        want[name] = expected
        write(tmp_path, f"{name}.ndjson", "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        parsed = read_bulk_ndjson(spark, str(tmp_path))
        out = parsed.changes.orderBy("file", "line").collect()
        assert parsed.bad.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name in ("x", "y"):
        got = [(r.op, r.id, r.doc) for r in out if r.file.endswith(f"{name}.ndjson")]
        assert got == want[name]
