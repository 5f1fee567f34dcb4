"""Queries over tables: slots, changes, entities, catalog, datasets."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions.skew import spread
from slotwise.operators import changes, entities, joins, predicates, routing, windows
from slotwise.plans import datasets
from slotwise.plans.registry import ORACLES, cents, ms, query, table
from slotwise.session import scratch_dir, stored
from slotwise.sources import bulk_ndjson, catalog, mapping, sinks, slots

SLOTS, SHARDS = 8, 34
HASH = "('0x' || substr(md5({0}::VARCHAR), 1, 8))::BIGINT"


def sql_slot(column: str, n: int = SLOTS) -> str:
    return f"({HASH.format(column)} % {n})"


def _orders(spark, sf):
    return table(spark, sf, "orders")


def _placed(spark, sf):
    return routing.assign_slot(
        _orders(spark, sf), "o_orderkey", SLOTS, SHARDS, "o_custkey", batch=F.date_trunc("month", "o_orderdate").cast("date"), method="md5"
    )


PLACED_SQL = f"""
    WITH p AS (SELECT *, {sql_slot('o_custkey')}::INTEGER AS slot,
                      (({HASH.format("strftime(o_orderdate, '%Y-%m-01')")} % 100) % 4) AS rank FROM orders),
    q AS (SELECT *, (slot * 4 + rank)::INTEGER AS shard FROM p)
"""


@query("assign_slot", PLACED_SQL + "SELECT o_orderkey, slot, shard FROM q")
def _assign_slot(spark, sf):
    return _placed(spark, sf).select("o_orderkey", "slot", "shard")


@query(
    "slot_prune",
    PLACED_SQL
    + f"""SELECT o_orderkey, o_custkey, slot FROM q
    WHERE slot IN (SELECT {sql_slot('r')} FROM (SELECT unnest(['7', '21', '400']) AS r))""",
)
def _slot_prune(spark, sf):
    pruned = routing.slot_prune(_placed(spark, sf), ["7", "21", "400"], SLOTS, "md5")
    return pruned.select("o_orderkey", "o_custkey", "slot")


@query(
    "write_slots",
    PLACED_SQL
    + f"""SELECT o_orderkey, slot, shard FROM q
    WHERE slot IN (SELECT {sql_slot('r')} FROM (SELECT unnest(['7', '21']) AS r)) AND o_custkey IN (7, 21)""",
)
def _write_slots(spark, sf):
    path = scratch_dir(spark, "slots")
    slots.write_slots(_placed(spark, sf).select("o_orderkey", "o_custkey", "slot", "shard"), path)
    back = slots.read_slots(spark, path, ["7", "21"], SLOTS, "md5")
    return back.filter(F.col("o_custkey").isin(7, 21)).select("o_orderkey", "slot", "shard")


@query(
    "pick_least_loaded",
    PLACED_SQL
    + """,
    s AS (SELECT unnest(range(32)) AS shard),
    c AS (SELECT s.shard, count(q.o_orderkey) AS doc_count FROM s LEFT JOIN q ON q.shard = s.shard GROUP BY s.shard)
    SELECT shard::INTEGER AS shard, doc_count FROM c ORDER BY doc_count, shard LIMIT 1""",
)
def _pick_least_loaded(spark, sf):
    return routing.pick_least_loaded(_placed(spark, sf), spark, range(32))


@query("fixed_shard", "SELECT o_orderkey, 5::INTEGER AS shard FROM orders")
def _fixed_shard(spark, sf):
    return routing.fixed_shard(_orders(spark, sf).select("o_orderkey"), 5)


@query(
    "custom_partition",
    """SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '%URGENT' THEN 0 WHEN o_orderpriority LIKE '%LOW' THEN 1 ELSE 2 END
       AS partition_id FROM orders""",
)
def _custom_partition(spark, sf):
    ruled = routing.custom_partition(_orders(spark, sf), "o_orderpriority", [("URGENT", 0), ("LOW", 1)], 2)
    return routing.place_partitions(ruled.select("o_orderkey", "partition_id"), 3)


@query(
    "slice",
    f"""SELECT o_orderkey, ({HASH.format('o_orderkey')} % 3)::INTEGER AS part FROM orders""",
)
def _slice(spark, sf):
    orders = _orders(spark, sf).select("o_orderkey")
    parts = [routing.slice_rows(orders, "o_orderkey", i, 3, "md5").withColumn("part", F.lit(i)) for i in range(3)]
    return reduce(DataFrame.unionByName, parts)


@query(
    "batch_stats",
    PLACED_SQL
    + """,
    s AS (SELECT epoch_ms(date_trunc('month', o_orderdate)) AS batch_ms, slot, count(*) AS n FROM q GROUP BY ALL)
    SELECT batch_ms, sum(n)::BIGINT AS items, count(*) AS shards, (sum(n) // count(*))::BIGINT AS avg_items, max(n) AS max_items
    FROM s GROUP BY batch_ms""",
)
def _batch_stats(spark, sf):
    placed = _placed(spark, sf).withColumn("batch_ms", ms(F.date_trunc("month", "o_orderdate")))
    return windows.batch_stats(placed, "batch_ms", "slot")


# ---------------------------------------------------------------------------------------
# Sources and sinks


@query(
    "route_sink",
    """
    SELECT CASE event_type WHEN 'error' THEN 'h1:9092,h2:9092' ELSE 'h3:9092' END AS brokers,
           CASE event_type WHEN 'error' THEN 'alerts' ELSE 'sales' END AS topic,
           NULL::VARCHAR AS key, event_id::VARCHAR AS value
    FROM events WHERE event_type IN ('error', 'purchase')
    """,
)
def _route_sink(spark, sf):
    routes = {"error": (["h1:9092", "h2:9092"], "alerts"), "purchase": (["h3:9092"], "sales")}
    return sinks.route_sink(table(spark, sf, "events"), "event_type", F.col("event_id"), routes).good


MAPPING = {
    "properties": {
        "id": {"type": "long"},
        "day": {"type": "date"},
        "buyer": {"properties": {"key": {"type": "long"}, "vip": {"type": "boolean"}}},
        "tags": {"type": "nested", "properties": {"name": {"type": "keyword"}}},
        "extra": {"type": "object"},
    }
}


@query(
    "read_with_mapping",
    """
    SELECT o_orderkey, o_orderkey AS id, epoch_ms(o_orderdate) AS day_ms, o_custkey AS buyer_key, o_custkey % 2 = 0 AS vip,
           o_orderstatus AS first_tag, '{"p":"' || o_orderpriority || '"}' AS extra
    FROM orders
    """,
)
def _read_with_mapping(spark, sf):
    doc = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("day"),
            F.struct(F.col("o_custkey").alias("key"), (F.col("o_custkey") % 2 == 0).alias("vip")).alias("buyer"),
            F.array(F.struct(F.col("o_orderstatus").alias("name"), F.lit(1).alias("ignored"))).alias("tags"),
            F.struct(F.col("o_orderpriority").alias("p")).alias("extra"),
            F.col("o_totalprice").alias("not_mapped"),
        )
    )
    docs = _orders(spark, sf).select("o_orderkey", doc.alias("doc"))
    out = mapping.read_with_mapping(docs, MAPPING)
    return out.select(
        "o_orderkey", "id", ms(F.col("day")).alias("day_ms"), F.col("buyer.key").alias("buyer_key"),
        F.col("buyer.vip").alias("vip"), F.col("tags")[0]["name"].alias("first_tag"), "extra",
    )


def _views(spark, sf):
    """Views under names of their own, so that other views of the session stay as they are."""
    table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment")
    ).createOrReplaceTempView("sw_party_customer")
    table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    ).createOrReplaceTempView("sw_party_supplier")
    table(spark, sf, "part").createOrReplaceTempView("sw_item_part")


@query(
    "multi_scan",
    """
    SELECT 'sw_party_customer' AS _table, c_custkey AS key, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer
    UNION ALL SELECT 'sw_party_supplier', s_suppkey, s_name, s_nationkey, NULL FROM supplier
    """,
)
def _multi_scan(spark, sf):
    _views(spark, sf)
    return catalog.multi_scan(spark, "sw_party_*")


@query(
    "alias_view",
    """
    SELECT 'sw_party_customer' AS _table, c_custkey AS key, c_nationkey AS nation FROM customer WHERE c_nationkey IN (3, 4) AND c_custkey >= 10
    UNION ALL SELECT 'sw_party_supplier', s_suppkey, s_nationkey FROM supplier WHERE s_nationkey IN (3, 4) AND s_suppkey >= 10
    """,
)
def _alias_view(spark, sf):
    _views(spark, sf)
    alias = catalog.Alias(
        "parties", ("sw_party_customer", "sw_party_supplier"), F.col("key") >= 10, frozenset({"3", "4", "5"})
    )
    return catalog.alias_view(spark, alias, "nation", ["3", "4", "9"]).select("_table", "key", "nation")


@query(
    "table_stats",
    """
    SELECT 'sw_item_part' AS table_name, count(*) AS row_count FROM part
    UNION ALL SELECT 'sw_party_customer', count(*) FROM customer
    UNION ALL SELECT 'sw_party_supplier', count(*) FROM supplier
    """,
)
def _table_stats(spark, sf):
    _views(spark, sf)
    return catalog.table_stats(spark, "sw_party_*,sw_item_*")


# ---------------------------------------------------------------------------------------
# Changes


@query(
    "replace_by_key",
    """
    WITH b AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
    i AS (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))
    SELECT o_orderkey, o_totalprice FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM i)
    UNION ALL SELECT o_orderkey, o_totalprice FROM i
    """,
)
def _replace_by_key(spark, sf):
    base, incoming = _base_and_incoming(spark, sf)
    return joins.replace_by_key(base, incoming, ["o_orderkey"]).table


@query(
    "replace_by_key_removed",
    """SELECT count(*) AS removed FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'P'""",
)
def _replace_removed(spark, sf):
    base, incoming = _base_and_incoming(spark, sf)
    return joins.replace_by_key(base, incoming, ["o_orderkey"]).removed


def _base_and_incoming(spark, sf):
    orders = _orders(spark, sf)
    base = orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice")
    incoming = orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        "o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), F.col("o_orderstatus").alias("dir")
    )
    return base, incoming


def _change_set(spark, sf):
    """Base rows and ordered changes cut out of lineitem: each line is a change of its order,
    the operation follows from the line number and the order key."""
    line = spread(table(spark, sf, "lineitem"))
    base = _orders(spark, sf).filter("o_orderstatus <> 'O'").select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("flag")
    )
    kind = (F.col("l_orderkey") + F.col("l_linenumber") * 3 + F.col("l_partkey")) % 7
    op = (
        F.when(kind == 0, "index").when(kind == 1, "create").when(kind.isin(2, 3, 4), "update")
        .when(kind == 5, "delete").otherwise("update")
    )
    seq = (
        (cents("l_extendedprice") * 100).cast("bigint") * 100_000 + F.col("l_partkey") % 100_000
    ) * 8000 + F.col("l_suppkey") % 1000 * 8 + F.col("l_linenumber")
    ops = line.select(
        seq.alias("seq"),
        op.alias("op"),
        F.col("l_orderkey").alias("id"),
        F.when(F.col("l_partkey") % 3 > 0, F.col("l_extendedprice")).alias("price"),
        F.when(F.col("l_partkey") % 4 > 0, F.col("l_returnflag")).alias("flag"),
        (kind == 6).alias("doc_as_upsert"),
        F.when(F.col("l_suppkey") % 5 == 0, F.col("l_partkey")).alias("pick"),
        F.col("l_partkey").alias("part"),
    )
    return base, ops


OPS_SQL = f"""
    k AS (SELECT *, (l_orderkey + l_linenumber * 3 + l_partkey) % 7 AS kind,
        ((l_extendedprice::DECIMAL(18,2) * 100)::BIGINT * 100000 + l_partkey % 100000) * 8000
            + l_suppkey % 1000 * 8 + l_linenumber AS seq
        FROM lineitem),
    o AS (SELECT seq, CASE kind WHEN 0 THEN 'index' WHEN 1 THEN 'create' WHEN 5 THEN 'delete' ELSE 'update' END AS op,
                 l_orderkey AS id, CASE WHEN l_partkey % 3 > 0 THEN l_extendedprice END AS price,
                 CASE WHEN l_partkey % 4 > 0 THEN l_returnflag END AS flag, kind = 6 AS ups,
                 l_suppkey, l_partkey,
                 row_number() OVER (PARTITION BY l_orderkey ORDER BY seq) AS pos FROM k),
    b AS (SELECT o_orderkey AS k, o_totalprice AS price, o_orderstatus AS flag FROM orders WHERE o_orderstatus <> 'O')
"""

# One change after the other, per id: the plainest statement of what must come out.
FOLD_SQL = f"""
    WITH RECURSIVE {OPS_SQL},
    run(id, pos, alive, price, flag, seq, result) AS (
        SELECT i.id, 0::BIGINT, b.k IS NOT NULL, b.price, b.flag, NULL::BIGINT, NULL::VARCHAR
        FROM (SELECT DISTINCT id FROM o) i LEFT JOIN b ON b.k = i.id
        UNION ALL
        SELECT o.id, o.pos,
            CASE WHEN o.op IN ('index', 'create') THEN true WHEN o.op = 'delete' THEN false ELSE r.alive OR o.ups END,
            CASE WHEN o.op = 'index' OR (NOT r.alive AND (o.op = 'create' OR (o.op = 'update' AND o.ups))) THEN o.price
                 WHEN o.op = 'delete' THEN NULL WHEN r.alive AND o.op = 'update' THEN coalesce(o.price, r.price) ELSE r.price END,
            CASE WHEN o.op = 'index' OR (NOT r.alive AND (o.op = 'create' OR (o.op = 'update' AND o.ups))) THEN o.flag
                 WHEN o.op = 'delete' THEN NULL WHEN r.alive AND o.op = 'update' THEN coalesce(o.flag, r.flag) ELSE r.flag END,
            o.seq,
            CASE WHEN o.op = 'index' THEN CASE WHEN r.alive THEN 'updated' ELSE 'created' END
                 WHEN o.op = 'create' THEN CASE WHEN r.alive THEN 'conflict' ELSE 'created' END
                 WHEN o.op = 'delete' THEN CASE WHEN r.alive THEN 'deleted' ELSE 'not_found' END
                 WHEN r.alive THEN CASE WHEN (o.price IS NULL OR o.price IS NOT DISTINCT FROM r.price)
                                         AND (o.flag IS NULL OR o.flag IS NOT DISTINCT FROM r.flag) THEN 'noop' ELSE 'updated' END
                 WHEN o.ups THEN 'created' ELSE 'not_found' END
        FROM run r JOIN o ON o.id = r.id AND o.pos = r.pos + 1)
"""


@query(
    "apply_changes",
    FOLD_SQL
    + """,
    last AS (SELECT id, arg_max(alive, pos) AS alive, max(pos) AS pos FROM run GROUP BY id)
    SELECT r.id AS k, r.price, r.flag FROM run r JOIN last l ON l.id = r.id AND l.pos = r.pos WHERE r.alive
    UNION ALL SELECT k, price, flag FROM b WHERE k NOT IN (SELECT id FROM o)
    """,
)
def _apply_changes(spark, sf):
    base, ops = _change_set(spark, sf)
    return changes.apply_changes(base, ops, "k", ["price", "flag"]).table


def _bucketed(spark, df, id_col):
    """The table laid out by id, in as many buckets as there are partitions for shuffles."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return slots.write_buckets(df, f"slotwise_{uuid.uuid4().hex}", scratch_dir(spark, "buckets"), id_col, buckets)


@query("apply_changes_bucketed", ORACLES["apply_changes"])
def _apply_changes_bucketed(spark, sf):
    base, ops = _change_set(spark, sf)
    return changes.apply_changes(_bucketed(spark, base, "k"), ops, "k", ["price", "flag"]).table


@query(
    "apply_changes_outcomes",
    FOLD_SQL
    + """SELECT seq, id, result, CASE result WHEN 'created' THEN 201 WHEN 'not_found' THEN 404 WHEN 'conflict' THEN 409 ELSE 200 END AS status
    FROM run WHERE pos > 0""",
)
def _apply_outcomes(spark, sf):
    base, ops = _change_set(spark, sf)
    out = changes.apply_changes(base, ops, "k", ["price", "flag"], detect_noop=True).outcomes
    return out.select("seq", "id", "result", "status")


def _conditional_set(spark, sf):
    """The same changes with conditions: some name the sequence number of the change before,
    some a wrong one; every tenth id takes only external versions."""
    base, ops = _change_set(spark, sf)
    before = F.lag("seq").over(W.partitionBy("id").orderBy("seq"))
    part = F.col("part")
    external = F.col("id") % 10 == 3
    cas = F.when(F.col("op") == "create", F.lit(None)).when(part % 4 == 0, before).when(part % 9 == 0, F.lit(-5))
    conditional = ops.select(
        "seq",
        F.when(external, F.when(part % 5 == 0, "delete").otherwise("index")).otherwise(F.col("op")).alias("op"),
        "id", "price", "flag", "doc_as_upsert",
        F.when(~external, cas).cast("bigint").alias("if_seq_no"),
        F.when(external, part).alias("version"),
        F.when(external, F.when(part % 2 == 0, "external").otherwise("external_gte")).alias("version_type"),
    )
    return base, conditional


CONDITIONAL_SQL = f"""
    WITH RECURSIVE {OPS_SQL},
    c AS (SELECT seq, id, pos, ups, id % 10 = 3 AS ext, l_partkey AS part, l_partkey % 2 = 1 AS gte,
                 CASE WHEN id % 10 = 3 THEN CASE WHEN l_partkey % 5 = 0 THEN 'delete' ELSE 'index' END ELSE op END AS op,
                 CASE WHEN id % 10 = 3 OR op = 'create' THEN NULL
                      WHEN l_partkey % 4 = 0 THEN lag(seq) OVER (PARTITION BY id ORDER BY seq)
                      WHEN l_partkey % 9 = 0 THEN -5 END AS cas FROM o),
    run(id, pos, alive, sq, ver, seq, result) AS (
        SELECT i.id, 0::BIGINT, b.k IS NOT NULL, -1::BIGINT, 0::BIGINT, NULL::BIGINT, NULL::VARCHAR
        FROM (SELECT DISTINCT id FROM o) i LEFT JOIN b ON b.k = i.id
        UNION ALL
        SELECT id, pos,
               CASE WHEN result IN ('conflict', 'not_found') AND op <> 'delete' OR result = 'conflict' THEN alive ELSE op <> 'delete' END,
               CASE WHEN result IN ('conflict', 'not_found') AND op <> 'delete' OR result = 'conflict' THEN sq ELSE seq END,
               CASE WHEN result = 'conflict' OR (result = 'not_found' AND op <> 'delete') THEN ver WHEN ext THEN part ELSE ver + 1 END, seq, result
        FROM (SELECT c.id, c.pos, c.op, c.ext, c.part, c.seq, r.alive, r.sq, r.ver,
              CASE WHEN c.cas IS NOT NULL AND NOT (r.alive AND c.cas = r.sq) THEN 'conflict'
                   WHEN c.ext AND NOT (c.part > r.ver OR (c.gte AND c.part = r.ver)) THEN 'conflict'
                   WHEN c.op = 'index' THEN CASE WHEN r.alive THEN 'updated' ELSE 'created' END
                   WHEN c.op = 'create' THEN CASE WHEN r.alive THEN 'conflict' ELSE 'created' END
                   WHEN c.op = 'delete' THEN CASE WHEN r.alive THEN 'deleted' ELSE 'not_found' END
                   WHEN r.alive THEN 'updated' WHEN c.ups THEN 'created' ELSE 'not_found' END AS result
              FROM run r JOIN c ON c.id = r.id AND c.pos = r.pos + 1) x)
"""


@query("apply_changes_conditional", CONDITIONAL_SQL + "SELECT seq, id, result FROM run WHERE pos > 0")
def _apply_conditional(spark, sf):
    base, ops = _conditional_set(spark, sf)
    out = changes.apply_changes(base, ops, "k", ["price", "flag"], conditional=True).outcomes
    return out.select("seq", "id", "result")


@query(
    "apply_changes_two_rounds",
    CONDITIONAL_SQL
    + """,
    c2 AS (SELECT id, p.pos, 200000000000000000 + id * 10 + p.pos AS seq, CASE p.pos WHEN 1 THEN 'update' WHEN 2 THEN 'index' ELSE 'delete' END AS op,
                  CASE WHEN p.pos = 1 THEN last END AS cas, CASE p.pos WHEN 2 THEN 1 + id % 4 WHEN 3 THEN 2 + id % 4 END AS want
           FROM (SELECT id, max(seq) AS last FROM o GROUP BY id), (SELECT unnest([1, 2, 3]) AS pos) p),
    run2(id, pos, alive, sq, ver) AS (
        SELECT id, 0, alive, CASE WHEN alive THEN sq ELSE -1 END, CASE WHEN alive THEN ver ELSE 0 END
        FROM (SELECT id, arg_max(alive, pos) AS alive, arg_max(sq, pos) AS sq, arg_max(ver, pos) AS ver FROM run GROUP BY id)
        UNION ALL
        SELECT r.id, c2.pos,
               CASE WHEN passed THEN c2.op <> 'delete' ELSE alive END, CASE WHEN passed THEN c2.seq ELSE sq END, CASE WHEN passed THEN ver + 1 ELSE ver END
        FROM run2 r JOIN c2 ON c2.id = r.id AND c2.pos = r.pos + 1,
             LATERAL (SELECT coalesce(alive AND (cas IS NULL OR cas = sq) AND (want IS NULL OR want = ver), false) AS passed) x)
    SELECT id AS k, sq AS seq_no, ver AS version FROM run2 WHERE pos = 3 AND alive
    UNION ALL SELECT k, -1, 0 FROM b WHERE k NOT IN (SELECT id FROM o)""",
)
def _apply_two_rounds(spark, sf):
    base, ops = _conditional_set(spark, sf)
    fields = ["price", "flag"]
    first = stored(changes.apply_changes(base, ops, "k", fields, conditional=True).table, "round")
    last = ops.groupBy("id").agg(F.max("seq").alias("last")).withColumn("pos", F.explode(F.array(*[F.lit(p) for p in (1, 2, 3)])))
    pos, null = F.col("pos"), F.lit(None).cast("bigint")
    second = last.select(
        (200_000_000_000_000_000 + F.col("id") * 10 + pos).alias("seq"),
        F.when(pos == 1, "update").when(pos == 2, "index").otherwise("delete").alias("op"), "id",
        *[F.lit(None).cast(ops.schema[f].dataType).alias(f) for f in fields],
        F.when(pos == 1, F.col("last")).alias("if_seq_no"),
        F.when(pos == 2, 1 + F.col("id") % 4).when(pos == 3, 2 + F.col("id") % 4).otherwise(null).alias("version"),
    )
    table = changes.apply_changes(first, second, "k", fields, conditional=True).table
    return table.select("k", F.col("_seq_no").alias("seq_no"), F.col("_version").alias("version"))


@query(
    "read_bulk_ndjson",
    """
    WITH k AS (SELECT *, o_orderkey % 7 AS kind, '{"p":' || o_custkey || '}' AS doc FROM orders)
    SELECT o_orderkey::VARCHAR AS id, 'good' AS side,
           CASE kind WHEN 1 THEN 'create' WHEN 2 THEN 'update' WHEN 3 THEN 'delete' ELSE 'index' END AS op,
           CASE kind WHEN 0 THEN o_custkey::VARCHAR END AS routing,
           CASE kind WHEN 4 THEN o_custkey END AS version,
           CASE kind WHEN 3 THEN NULL ELSE doc END AS doc FROM k WHERE kind < 5
    UNION ALL
    SELECT NULL, CASE kind WHEN 5 THEN 'unknown action' ELSE 'unknown key colour' END, NULL, NULL, NULL, doc FROM k WHERE kind >= 5
    """,
)
def _read_bulk(spark, sf):
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    kind = F.col("o_orderkey") % 7
    doc = F.concat(F.lit('{"p":'), cust, F.lit("}"))
    named = {0: "index", 1: "create", 2: "update", 3: "delete", 4: "index", 5: "merge", 6: "index"}
    extra = {0: F.concat(F.lit(',"routing":"'), cust, F.lit('"')), 4: F.concat(F.lit(',"version":'), cust), 6: F.lit(',"colour":1')}
    text = None
    for number, op in named.items():
        action = F.concat(F.lit(f'{{"{op}":{{"_id":"'), key, F.lit('"'), extra.get(number, F.lit("")), F.lit("}}"))
        body = F.concat(F.lit('{"doc":'), doc, F.lit("}")) if op == "update" else doc
        lines = F.concat(action, F.lit("\r\n\n")) if op == "delete" else F.concat(action, F.lit("\n"), body)
        text = F.when(kind == number, lines) if text is None else text.when(kind == number, lines)
    path = scratch_dir(spark, "bulk")
    _orders(spark, sf).select(text.alias("value")).write.text(path)
    parsed = bulk_ndjson.read_bulk_ndjson(spark, path).parsed
    good = F.col("reason").isNull()
    return parsed.select(
        *[F.when(good, F.col(c)).alias(c) for c in ("id", "op", "routing", "version")],
        F.coalesce("reason", F.lit("good")).alias("side"),
        "doc",
    )


@query(
    "validate_ops",
    f"""
    WITH {OPS_SQL},
    v AS (SELECT seq, op, CASE WHEN l_suppkey % 5 = 0 THEN l_partkey END AS version,
                 CASE WHEN l_partkey % 11 = 0 THEN 4 END AS cas, l_partkey % 13 = 0 AS no_id, ups FROM o)
    SELECT seq, (op = 'create' AND version IS NOT NULL)::INTEGER + (op = 'create' AND cas IS NOT NULL)::INTEGER
              + (op <> 'index' AND no_id)::INTEGER + (no_id AND version IS NOT NULL)::INTEGER
              + (cas IS NOT NULL AND version IS NOT NULL)::INTEGER
              + (op = 'update' AND cas IS NOT NULL AND ups)::INTEGER AS errors
    FROM v
    """,
)
def _validate_ops(spark, sf):
    _, ops = _change_set(spark, sf)
    part = F.col("part")
    checked = changes.validate_ops(
        ops.withColumn("version", F.col("pick"))
        .withColumn("if_seq_no", F.when(part % 11 == 0, F.lit(4)).cast("bigint"))
        .withColumn("id", F.when(part % 13 != 0, F.col("id").cast("string")))
        .withColumn("doc", F.lit("{}"))
    )
    return checked.tagged.select("seq", F.size("errors").alias("errors"))


@query(
    "auto_id",
    """SELECT CASE WHEN doc_id % 2 = 0 THEN doc_id::VARCHAR ELSE substr(sha256(source || '#' || doc_id), 1, 20) END AS id,
              source, doc_id FROM documents""",
)
def _auto_id(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string")).alias("id"), "source", "doc_id"
    )
    return changes.auto_id(docs, "id", "source", "doc_id")


@query(
    "pre_transforms",
    """
    WITH c AS (SELECT o_orderkey AS seq, o_totalprice AS price,
                      CASE o_orderstatus WHEN 'F' THEN 'half' WHEN 'O' THEN 'big_only' WHEN 'P' THEN 'no_such' END AS pipe FROM orders)
    SELECT seq, 'written' AS result, CASE pipe WHEN 'half' THEN price / 2 ELSE price END AS price FROM c
    WHERE pipe = 'half' OR (pipe = 'big_only' AND price >= 100000)
    UNION ALL SELECT seq, 'noop', NULL FROM c WHERE pipe = 'big_only' AND price < 100000
    UNION ALL SELECT seq, 'failed', NULL FROM c WHERE pipe = 'no_such'
    """,
)
def _pre_transforms(spark, sf):
    status = F.col("o_orderstatus")
    named = F.when(status == "F", "half").when(status == "O", "big_only").when(status == "P", "no_such")
    ops = _orders(spark, sf).select(F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("price"), named.alias("pipeline"))
    registry = {
        "half": lambda df: df.withColumn("price", F.col("price") / 2),
        "big_only": lambda df: df.filter("price >= 100000"),
    }
    prepared = changes.pre_transforms(ops, registry)
    written = prepared.rows.select("seq", F.lit("written").alias("result"), "price")
    return written.unionByName(prepared.outcomes.select("seq", "result", F.lit(None).cast("double").alias("price")))


@query(
    "reindex",
    """
    WITH s AS (SELECT 'a' AS _table, l_orderkey AS id, l_partkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY _table, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos FROM s)
    SELECT id, l_partkey, l_suppkey,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'in destination' WHEN pos > 1 THEN 'earlier source row' ELSE 'added' END AS side
    FROM r LEFT JOIN orders ON o_orderkey = id
    """,
)
def _reindex(spark, sf):
    source = table(spark, sf, "lineitem").select(
        F.lit("a").alias("_table"), F.col("l_orderkey").alias("id"), "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"
    )
    dest = _orders(spark, sf).filter("o_orderpriority = '5-LOW'").select(F.col("o_orderkey").alias("id"))
    out = changes.reindex(source, dest, "id", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    return out.judged.select("id", "l_partkey", "l_suppkey", F.coalesce("reason", F.lit("added")).alias("side"))


# ---------------------------------------------------------------------------------------
# Entities


def _entities(spark, sf):
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_custkey") % 10 == 0, 0).otherwise(1).alias("valid"),
        F.col("c_name").alias("cust_name"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("acct_bal"),
        F.col("c_mktsegment").alias("segment"),
    )


ENTITY_SQL = """
    WITH e AS (SELECT c_custkey AS id, (CASE WHEN c_custkey % 10 = 0 THEN 0 ELSE 1 END)::INTEGER AS valid, c_name AS cust_name,
                      c_nationkey AS nation_key, c_acctbal AS acct_bal, c_mktsegment AS segment FROM customer)
"""


@query(
    "where_conditions",
    ENTITY_SQL
    + """SELECT * FROM e WHERE valid = 1 AND acct_bal > 100 AND acct_bal <= 9000.5 AND nation_key <> 7
         AND cust_name LIKE '%1%' AND segment IN ('BUILDING', 'MACHINERY') AND nation_key IN (1, 2, 3, 4, 5)""",
)
def _where_conditions(spark, sf):
    return predicates.where_conditions(
        _entities(spark, sf),
        [
            ("EQ", "valid", 1), ("GT", "acctBal", 100), ("LE", "acctBal", 9000.5), ("NE", "nationKey", 7),
            ("LIKE", "custName", "%1%"), ("IN", "segment", ["BUILDING", None, "MACHINERY"]),
            ("IN", "nationKey", [1, 2, 3, 4, 5]), ("GE", "acctBal", None), ("SORT_DESC", "acctBal", None),
        ],
    )


@query(
    "by_example",
    ENTITY_SQL + "SELECT * FROM e WHERE segment = 'BUILDING' AND valid = 1 AND acct_bal < 500",
)
def _by_example(spark, sf):
    return predicates.by_example(
        _entities(spark, sf), {"segment": "BUILDING", "valid": 1, "custName": None}, [("LT", "acctBal", 500)]
    )


@query(
    "order_by_conditions",
    ENTITY_SQL + "SELECT * FROM e WHERE segment = 'FURNITURE' ORDER BY nation_key, acct_bal DESC, id",
)
def _order_by_conditions(spark, sf):
    return predicates.by_example(
        _entities(spark, sf), {"segment": "FURNITURE"},
        [("SORT_ASC", "nationKey", None), ("SORT_DESC", "acctBal", None), ("SORT_ASC", "id", None)],
    )


@query("select_by_id", ENTITY_SQL + "SELECT * FROM e WHERE id = 40")
def _select_by_id(spark, sf):
    return predicates.select_by_id(_entities(spark, sf), 40)


@query(
    "insert_rows",
    ENTITY_SQL
    + """SELECT * FROM e
    UNION ALL SELECT -1, NULL, 'one', NULL, 1.5, NULL
    UNION ALL SELECT -2, 1, 'two', NULL, NULL, NULL
    UNION ALL SELECT 1000000 + s_suppkey, 1, s_name, s_nationkey, NULL, NULL FROM supplier""",
)
def _insert_rows(spark, sf):
    out = entities.insert_one(_entities(spark, sf), {"id": -1, "custName": "one", "acctBal": 1.5})
    out = entities.insert_selective(out, {"id": -2, "custName": "two", "valid": None}, {"valid": 1})
    rows = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1000000).alias("id"), F.col("s_name").alias("cust_name"), F.col("s_nationkey").alias("nation_key")
    )
    return entities.insert_list(out, rows, {"valid": 1})


@query(
    "update_rows",
    ENTITY_SQL
    + """SELECT id, valid, CASE WHEN id = 11 THEN 'eleven' WHEN id = 13 THEN NULL ELSE cust_name END AS cust_name,
         CASE WHEN id = 13 THEN 1 ELSE nation_key END AS nation_key,
         CASE WHEN segment = 'MACHINERY' AND nation_key = 3 AND acct_bal < 100 THEN 0.0 ELSE acct_bal END AS acct_bal, segment
    FROM e""",
)
def _update_rows(spark, sf):
    out = entities.update_selective(
        _entities(spark, sf), {"id": 5, "acctBal": 0.0, "custName": None}, {"segment": "MACHINERY", "nationKey": 3},
        [("LT", "acctBal", 100)],
    )
    out = entities.update_selective_by_id(out, {"custName": "eleven", "nationKey": None}, 11)
    out = entities.update_selective_by_id(out, {"custName": "not valid"}, 20)
    return entities.update_by_id(out, {"custName": None, "nationKey": 1}, 13)


@query(
    "delete_rows",
    ENTITY_SQL
    + """SELECT id, (CASE WHEN id IN (20, 21) THEN 0 ELSE valid END)::INTEGER AS valid, cust_name, nation_key, acct_bal, segment
    FROM e WHERE NOT (segment = 'BUILDING' AND nation_key = 2) AND id <> 17""",
)
def _delete_rows(spark, sf):
    out = entities.delete_by_example(
        _entities(spark, sf), {"segment": "BUILDING", "nationKey": 2, "valid": 0}, ["segment", "nationKey"]
    )
    out = entities.delete_by_id(out, 17)
    for row_id in (20, 21):
        out = entities.delete_by_id_logically(out, row_id)
    return out


# ---------------------------------------------------------------------------------------
# Datasets


def _daily(spark, sf):
    _orders(spark, sf).createOrReplaceTempView("sw_orders")
    return datasets.DataSet(
        "daily",
        """SELECT CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status, count(*) AS n,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
           FROM sw_orders WHERE o_orderstatus IN (:status) GROUP BY 1, 2""",
        {"status": ["F", "O", "P"]},
    )


DAILY_SQL = """
    SELECT {day} AS day, o_orderstatus AS status, count(*) AS n, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total
    FROM orders WHERE o_orderstatus IN ({status}) GROUP BY 1, 2
"""


@query("dataset_query", DAILY_SQL.format(day="strftime(o_orderdate, '%Y-%m-%d')", status="'F', 'P'"))
def _dataset_query(spark, sf):
    return datasets.dataset_query(spark, _daily(spark, sf), {"status": ["F", "P"]}, datasets.ResultFormat())


@query(
    "format_result",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, strftime(ts, '%Y-%m-%d') AS day,
              strftime(ts + INTERVAL 8 HOUR, '%H:%M:%S') AS clock, epoch_us(ts) // 1000 AS ts_ms FROM events""",
)
def _format_result(spark, sf):
    ev = table(spark, sf, "events")
    shown = ev.select("event_id", "ts", F.col("ts").cast("date").alias("day"))
    text = datasets.format_result(shown, datasets.ResultFormat())
    clock = datasets.format_result(
        ev.select("event_id", F.col("ts").cast("timestamp").alias("clock")), datasets.ResultFormat(zone="GMT+8"), times=["clock"]
    )
    numbers = datasets.format_result(
        ev.select("event_id", F.col("ts").alias("ts_ms")), datasets.ResultFormat(timestamp=datasets.NUMBER)
    )
    return text.join(clock, "event_id").join(numbers, "event_id")


@query(
    "chart_query",
    """
    SELECT 0 AS position, 'daily' AS dataset, (o_orderdate::DATE)::VARCHAR AS x, o_orderstatus AS series,
           sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS y FROM orders WHERE o_orderstatus = 'P' GROUP BY 3, 4
    UNION ALL
    SELECT 1, 'priorities', o_orderpriority, NULL, count(*)::DOUBLE FROM orders GROUP BY o_orderpriority
    """,
)
def _chart_query(spark, sf):
    known = {
        "daily": _daily(spark, sf),
        "priorities": datasets.DataSet("priorities", "SELECT o_orderpriority AS priority, count(*) AS n FROM sw_orders GROUP BY 1"),
    }
    chart = [datasets.ChartSeries("daily", "day", "total", "status"), datasets.ChartSeries("priorities", "priority", "n")]
    frames = datasets.chart_query(spark, chart, known, {"daily": {"status": ["P"]}})
    return datasets.chart_long(chart, frames)
