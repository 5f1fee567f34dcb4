"""Ordered change sets over a table: index, create, update and delete with outcomes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.timeslice import even_slices, floor_div, prefix_scan
from slotwise.operators import conditions
from slotwise.session import stored

# Outcome of an operation and its status code.
STATUS = {"created": 201, "updated": 200, "deleted": 200, "noop": 200, "not_found": 404, "conflict": 409}
MAX_ID_BYTES = 512  # fixed value: longest id

# Optional columns of a change table and what stands for their absence.
OPTIONAL = {
    "doc_as_upsert": "boolean",
    "detect_noop": "boolean",
    "version": "bigint",
    "version_type": "string",
    "if_seq_no": "bigint",
}


class Applied(NamedTuple):
    table: DataFrame
    outcomes: DataFrame


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    id_col: str,
    fields: Sequence[str],
    detect_noop: bool = False,
    conditional: bool = False,
    slice_rows: int | None = None,
    ranges: int | None = None,
) -> Applied:
    """Apply `changes` (seq, op, id, fields…) in `seq` order; one outcome row per change.

    `index` replaces, `create` fails on a present id, `update` merges its non-null fields
    (on a missing id it inserts the `upsert` struct or, with doc_as_upsert, itself, else it
    fails), `delete` removes. A failed change stops no other. With `detect_noop`, an update
    that changes nothing reports `noop`. `conditional` honours if_seq_no, version and
    version_type (`internal`, `external`, `external_gte`) against the `_seq_no` and
    `_version` columns of `base` (absent: -1 and 0) and writes both back, so that further
    conditional changes can follow; see `conditions` for how ids of any size are judged, in
    `ranges` (Spark's default for shuffles if not given). A deleted id is forgotten after the set.

    Whether the id is present before a change is a running value, scanned in slices of
    `slice_rows` sequence numbers, or without that in slices of equally many changes; the final row of an id is one aggregate over its effective
    changes, combined map-side. An id with a third of all changes is no special case.
    """
    ops = _with_optional(changes, fields)
    if detect_noop or not conditional:
        slices = even_slices(changes, "seq") if slice_rows is None else floor_div(F.col("seq"), slice_rows)
        ops = ops.withColumn("_slice", slices)
    base_ids = base.select(F.col(id_col).alias("id"), F.lit(True).alias("_in_base"))

    if conditional:
        base = base.withColumns({c: F.lit(v).cast("bigint") for c, v in (("_seq_no", -1), ("_version", 0)) if c not in base.columns})
        needed = [*fields, *[c for c in ("upsert", "detect_noop") if c in changes.columns], *["_slice"] * detect_noop]
        results = conditions.judged(ops, base, id_col, _inserts(), ranges, needed).filter("seq IS NOT NULL")
        results = _with_optional(results, fields)
    else:
        results = _plain_results(ops, base_ids)

    effective = F.col("result").isin("created", "updated", "deleted")
    reset = effective & ((F.col("op") != "update") | (F.col("result") == "created"))
    staged = results.withColumn("_reset", reset).withColumn("_merge", effective & ~reset)
    staged = staged.withColumns({f"_w_{f}": _written(f) for f in fields})

    if detect_noop:
        staged = _mark_noops(base, staged, id_col, fields)

    told = staged
    if conditional:  # a number that an id has more than once tells each of its outcomes for each change
        found = staged.select(F.col("id").alias("_id"), F.col("seq").alias("_seq"), "result")
        same = (F.col("seq") == F.col("_seq")) & F.col("id").eqNullSafe(F.col("_id"))
        told = ops.select("seq", "id", "op").join(found, same)

    outcomes = told.select(
        "seq",
        "id",
        _status(F.col("result")).alias("status"),
        "result",
        F.when(F.col("result") == "conflict", "version conflict or id present")
        .when((F.col("result") == "not_found") & (F.col("op") == "update"), "id missing")
        .alias("error"),
    )
    return Applied(_final_table(base, staged, id_col, fields, conditional), outcomes)


def _with_optional(changes: DataFrame, fields: Sequence[str]) -> DataFrame:
    out = changes
    for name, kind in OPTIONAL.items():
        if name not in out.columns:
            out = out.withColumn(name, F.lit(None).cast(kind))
    if "upsert" not in out.columns:
        empty = T.StructType([T.StructField(f, changes.schema[f].dataType) for f in fields])
        out = out.withColumn("upsert", F.lit(None).cast(empty))
    return out


def _inserts() -> Column:
    return F.coalesce("doc_as_upsert", F.lit(False)) | F.col("upsert").isNotNull()


def _presence() -> Column:
    """What an unconditional change makes of the id's presence; null leaves it as it was."""
    op = F.col("op")
    return (
        F.when(op.isin("index", "create"), F.lit(True))
        .when(op == "delete", F.lit(False))
        .when((op == "update") & _inserts(), F.lit(True))
    )


def _plain_results(ops: DataFrame, base_ids: DataFrame) -> DataFrame:
    scanned = prefix_scan(
        ops,
        ["id"],
        "_slice",
        ["seq"],
        {"_present": ("last", _presence())},
        inclusive=False,
        seed=(base_ids, {"_present": "_in_base"}),
        null_keys=False,
    )
    known = F.coalesce("_seed__present", F.lit(False))
    return (
        scanned.withColumn("result", _result(F.coalesce("_present", F.lit(False))))
        .withColumn("_in_base", known)
        .drop("_present", "_seed__present")
    )


def _result(present: Column) -> Column:
    op = F.col("op")
    return (
        F.when(op == "index", F.when(present, "updated").otherwise("created"))
        .when(op == "create", F.when(present, "conflict").otherwise("created"))
        .when(op == "delete", F.when(present, "deleted").otherwise("not_found"))
        .when(op == "update", F.when(present, "updated").when(_inserts(), "created").otherwise("not_found"))
    )


def _status(result: Column) -> Column:
    codes = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])
    return F.try_element_at(codes, result)


def _written(field: str) -> Column:
    """The value a change writes to a field, as a struct; null if it does not write it."""
    own = F.struct(F.col(field).alias("v"))
    inserted = F.struct(F.coalesce(F.col("upsert")[field], F.when(F.col("upsert").isNull(), F.col(field))).alias("v"))
    return (
        F.when(F.col("_reset") & (F.col("op") == "update"), inserted)
        .when(F.col("_reset"), own)
        .when(F.col("_merge") & F.col(field).isNotNull(), own)
    )


def _mark_noops(base: DataFrame, staged: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    seed = base.select(
        F.col(id_col).alias("id"), *[F.struct(F.col(f).alias("v")).alias(f"_b_{f}") for f in fields]
    )
    scanned = prefix_scan(
        staged,
        ["id"],
        "_slice",
        ["seq"],
        {f"_cur_{f}": ("last", F.col(f"_w_{f}")) for f in fields},
        inclusive=False,
        seed=(seed, {f"_cur_{f}": f"_b_{f}" for f in fields}),
        null_keys=False,
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(f).isNull() | F.col(f).eqNullSafe(F.col(f"_cur_{f}.v")) for f in fields],
    )
    wanted = F.coalesce("detect_noop", F.lit(True))
    return scanned.withColumn(
        "result", F.when(F.col("_merge") & same & wanted, "noop").otherwise(F.col("result"))
    ).drop(*[f"_cur_{f}" for f in fields])


def _final_table(base: DataFrame, staged: DataFrame, id_col: str, fields: Sequence[str], conditional: bool) -> DataFrame:
    """Base rows with the last written values, without the deleted, with the inserted; after
    conditional changes with the number and version of the last effective one.

    A left join and a union rather than a full join: few changes can then be broadcast and
    a large base stays where it is. Both parts read the one shuffle of the changes.
    """
    last = F.max(F.when(F.col("_reset") | F.col("_merge"), F.col("seq")))
    marks = [F.max_by("_after", F.when(F.col("_after").isNotNull(), F.col("seq"))).alias("_new_version")] if conditional else []
    state = staged.groupBy("id").agg(
        last.alias("_last"),
        F.first("_in_base").alias("_in_base"),
        F.max_by(F.col("op") != "delete", F.when(F.col("_reset"), F.col("seq"))).alias("_alive"),
        *[
            F.max_by(F.col(f"_w_{f}"), F.when(F.col(f"_w_{f}").isNotNull(), F.col("seq"))).alias(f"_w_{f}")
            for f in fields
        ],
        *marks,
    )
    state = state.filter(F.col("_last").isNotNull() & F.col("id").isNotNull())
    merged = base.join(state.withColumnRenamed("id", id_col), id_col, "left")
    # `_in_base` always holds here; naming it keeps both parts on the same shuffle
    stays = F.coalesce(F.col("_alive") | ~F.col("_in_base"), F.lit(True))
    kept = merged.filter(stays).withColumns(
        {f: F.when(F.col(f"_w_{f}").isNotNull(), F.col(f"_w_{f}.v")).otherwise(F.col(f)) for f in fields}
    )
    written = {"_seq_no": "_last", "_version": "_new_version"} if conditional else {}
    kept = kept.withColumns({c: F.coalesce(new, c) for c, new in written.items()})
    added = state.filter("_alive AND NOT _in_base").select(
        F.col("id").alias(id_col), *[F.col(f"_w_{f}.v").alias(f) for f in fields], *[F.col(new).alias(c) for c, new in written.items()]
    )
    return kept.select(*base.columns).unionByName(added, allowMissingColumns=True)


# ---------------------------------------------------------------------------------------
# Before a change is applied


class Checked(NamedTuple):
    """`tagged` has every change with its `errors`; the other two are filters of it."""

    tagged: DataFrame

    @property
    def good(self) -> DataFrame:
        return self.tagged.filter(F.size("errors") == 0).drop("errors")

    @property
    def bad(self) -> DataFrame:
        return self.tagged.filter(F.size("errors") > 0)


def operation_errors(has: Callable[[str], bool]) -> Column:
    """All rule violations of a change, as an array of texts. `has` tells which optional
    columns (pipeline, retry_on_conflict, script, if_primary_term, …) the frame carries."""

    def col(name: str, kind: str) -> Column:
        return F.col(name) if has(name) else F.lit(None).cast(kind)

    op, ident = F.col("op"), F.col("id").cast("string")
    version, kind = col("version", "bigint"), F.coalesce(col("version_type", "string"), F.lit("internal"))
    cas = col("if_seq_no", "bigint").isNotNull()
    cas = cas | col("if_primary_term", "bigint").isNotNull()
    upsert = F.coalesce(col("doc_as_upsert", "boolean"), F.lit(False))
    has_upsert = col("upsert_doc", "string").isNotNull()
    retry = F.coalesce(col("retry_on_conflict", "int"), F.lit(0)) > 0
    script, doc = col("script", "string").isNotNull(), col("doc", "string").isNotNull()
    create, update = op == "create", op == "update"
    rules = [
        (create & (kind != "internal"), "create supports only internal versioning"),
        (create & version.isNotNull(), "create does not support explicit versions"),
        (create & cas, "create does not support compare and set"),
        ((op != "index") & (ident.isNull()), "an id is required"),
        (ident == "", "id must not be empty"),
        (F.octet_length(ident) > MAX_ID_BYTES, "id is too long"),
        (ident.isNull() & ((kind != "internal") | version.isNotNull()), "a version needs an id"),
        (col("pipeline", "string") == "", "pipeline must not be empty"),
        (cas & version.isNotNull(), "compare and set excludes a version"),
        (update & (kind != "internal"), "update supports only internal versioning"),
        (update & ~script & ~doc, "script or doc is missing"),
        (update & script & doc, "script and doc exclude each other"),
        (update & ~doc & upsert, "doc_as_upsert needs a doc"),
        (update & has_upsert & version.isNotNull(), "upsert excludes a version"),
        (update & cas & retry, "compare and set excludes retries"),
        (update & cas & upsert, "compare and set excludes upsert"),
        (update & version.isNotNull() & retry, "a version excludes retries"),
    ]
    found = F.array(*[F.when(broken, F.lit(text)) for broken, text in rules])
    return F.filter(found, lambda e: e.isNotNull())


def validate_ops(changes: DataFrame) -> Checked:
    """Changes that may be applied, and the others with all their errors."""
    return Checked(changes.withColumn("errors", operation_errors(lambda c: c in changes.columns)))


def auto_id(df: DataFrame, id_col: str, file: str, position: str) -> DataFrame:
    """Fill missing ids from the row's place in its file: a rerun gives the same ids."""
    made = F.substring(F.sha2(F.concat_ws("#", F.col(file), F.col(position).cast("string")), 256), 1, 20)
    return df.withColumn(id_col, F.coalesce(F.col(id_col), made))


class Prepared(NamedTuple):
    rows: DataFrame
    outcomes: DataFrame


Transform = Callable[[DataFrame], DataFrame]


def pre_transforms(
    changes: DataFrame,
    registry: dict[str, Transform],
    request: str = "pipeline",
    table_default: str | None = None,
    template_default: str | None = None,
) -> Prepared:
    """Run named transforms over changes before they are written.

    A change uses the transform its `request` column names, else the table's default, else
    the template's; `_none` or nothing means unchanged. A transform may change rows, leave
    some out (outcome `noop`), or set a column `failure` (outcome `failed`). `rows` are the
    changes still to be written, `outcomes` one row per other change, in `seq` order.
    """
    default = table_default or template_default or "_none"
    named = changes.withColumn("_name", F.coalesce(F.col(request), F.lit(default)))
    frames = [named.filter(F.col("_name") == "_none").withColumn("failure", F.lit(None).cast("string"))]
    for name, transform in registry.items():
        done = transform(named.filter(F.col("_name") == name))
        if "failure" not in done.columns:
            done = done.withColumn("failure", F.lit(None).cast("string"))
        frames.append(done)
    known = F.col("_name").isin("_none", *registry)
    unknown = named.filter(~known).withColumn("failure", F.concat(F.lit("no such transform: "), "_name"))
    frames.append(unknown)
    after = reduce(lambda a, b: a.unionByName(b), frames)
    dropped = named.select("seq").join(after.select("seq"), "seq", "left_anti")
    outcomes = dropped.select("seq", F.lit("noop").alias("result"), F.lit(None).cast("string").alias("error")).unionByName(
        after.filter("failure IS NOT NULL").select("seq", F.lit("failed").alias("result"), F.col("failure").alias("error"))
    )
    return Prepared(after.filter("failure IS NULL").drop("failure", "_name"), outcomes)


class Reindexed(NamedTuple):
    """`judged` has every source row with a `reason`, null for the rows that go in."""

    judged: DataFrame

    @property
    def added(self) -> DataFrame:
        return self.judged.filter("reason IS NULL").drop("reason")

    @property
    def conflicts(self) -> DataFrame:
        return self.judged.filter("reason IS NOT NULL")


def reindex(source: DataFrame, dest: DataFrame, id_col: str, order: Sequence[str]) -> Reindexed:
    """Copy the rows of `source` (with `_table`) whose id `dest` lacks; of several rows with
    one id the first by (_table, order) goes in, the rest are conflicts with `reason`.

    The winner per id is an aggregate, not a numbering, so copies of one id are combined
    map-side. It is written before it is joined: the source is read twice in all, and both sides
    of the join are dealt anew, so that Spark can split a hot id.
    """
    place = F.struct("_table", *order)
    first = source.groupBy(id_col).agg(F.min(place).alias("_first"))
    known = dest.select(id_col).withColumn("_known", F.lit(True))
    first = stored(first.join(known, id_col, "left"), "first-rows")
    reason = F.when(F.col("_known"), "in destination").when(place != F.col("_first"), "earlier source row")
    return Reindexed(source.join(first, id_col).withColumn("reason", reason).drop("_first", "_known"))
