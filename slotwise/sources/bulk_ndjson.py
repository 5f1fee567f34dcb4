"""Files of action and document lines as a change table."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions.schema import struct
from slotwise.session import stored

# Actions, which of them a document line follows, and the metadata keys.
ACTIONS = ("index", "create", "update", "delete")
META = {
    "_index": "string",
    "_type": "string",
    "_id": "string",
    "routing": "string",
    "shard_no": "string",
    "parent": "string",
    "op_type": "string",
    "version": "bigint",
    "version_type": "string",
    "if_seq_no": "bigint",
    "if_primary_term": "bigint",
    "retry_on_conflict": "int",
    "pipeline": "string",
    "fields": "string",
    "_source": "string",
}
# Other spellings of the metadata keys.
SPELLINGS = {
    "_routing": "routing",
    "_shard_no": "shard_no",
    "_parent": "parent",
    "opType": "op_type",
    "_version": "version",
    "_version_type": "version_type",
    "_versionType": "version_type",
    "versionType": "version_type",
    "_retry_on_conflict": "retry_on_conflict",
    "_retryOnConflict": "retry_on_conflict",
}

LINES = struct(
    file="string", block="bigint", line="bigint", value="string", before="string", role_a="string", role_d="string"
)
BLOCKS = struct(
    file="string", block="bigint", n="bigint", end_a="boolean", end_d="boolean", tail="string"
)

ACTION_NAME = r'^\s*\{\s*"([^"]*)"\s*:'


class BulkChanges(NamedTuple):
    """`parsed` has every change with a `reason` that is null for good ones; `changes` and
    `bad` are filters of it. Work on `parsed` to read the files once for both."""

    parsed: DataFrame

    @property
    def changes(self) -> DataFrame:
        return self.parsed.filter("reason IS NULL").drop("reason", "action")

    @property
    def bad(self) -> DataFrame:
        bad = self.parsed.filter("reason IS NOT NULL")
        return bad.select("file", "line", "action", "doc", "reason")


def read_bulk_ndjson(
    spark: SparkSession, path: str | list[str], default_shard: str | None = None
) -> BulkChanges:
    """Change rows (file, line, op, id, routing, …, doc, upsert_doc) of bulk files.

    An action line is followed by a document line unless it deletes; blank lines between
    them are skipped only where an action is expected. Malformed actions and unknown actions
    or metadata keys go to `bad`, each with its document line. `line` is the position of the
    action in its file, and (file, line) the order of the changes.

    Files are read in blocks like any text. A block does not know whether it starts with an
    action or a document, so it labels its lines for both cases; which case holds follows
    from the blocks before it, one summary row per block. Lines themselves are never
    shuffled: a document line already carries the line before it.
    """
    # Only a line feed ends a line: a lone carriage return is white space inside a document.
    text = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.regexp_replace("value", "\r$", "").alias("value"),
    )
    kind = F.regexp_extract("value", ACTION_NAME, 1)
    marked = text.withColumn(
        "kind",
        F.when(F.trim("value") == "", "blank").when(kind == "delete", "delete").otherwise("action"),
    )
    lines = marked.mapInPandas(_label, LINES)
    # one row per block, which several parts of the plan need: written once
    blocks = stored(marked.mapInPandas(_summarise, BLOCKS), "bulk-blocks")

    # end_a / end_d: does the block end expecting an action, if it began expecting an action
    # / a document? Equal ends fix the state; otherwise the block keeps it or turns it round.
    order = W.partitionBy("file").orderBy("block")
    past = order.rowsBetween(W.unboundedPreceding, -1)
    turned = (F.col("end_a") != F.col("end_d")) & ~F.col("end_a")
    fix = F.when(
        F.col("end_a") == F.col("end_d"), F.struct("_turns", F.col("end_a").alias("state"))
    )
    turns_before = F.coalesce(F.lag("_turns").over(order), F.lit(0))
    even = (F.col("_turns_before") - F.coalesce("_last._turns", F.lit(0))) % 2 == 0
    placed = (
        blocks.withColumn(
            "_turns", F.sum(turned.cast("int")).over(order.rowsBetween(W.unboundedPreceding, 0))
        )
        .withColumn("_last", F.last(fix, ignorenulls=True).over(past))
        .withColumn("_turns_before", turns_before)
        .withColumn("expects_action", F.coalesce("_last.state", F.lit(True)) == even)
        .withColumn("first_line", F.coalesce(F.sum("n").over(past), F.lit(0)))
        .withColumn("tail_before", F.lag("tail").over(order))
    )
    unfinished = (
        placed.withColumn("_next", F.lead("block").over(order))
        .filter(F.col("_next").isNull())
        .filter(~F.when(F.col("expects_action"), F.col("end_a")).otherwise(F.col("end_d")))
        .select(
            "file",
            (F.col("first_line") + F.col("n")).alias("line"),
            F.col("tail").alias("action"),
            F.lit(None).cast("string").alias("doc"),
            F.lit("document line missing").alias("reason"),
        )
    )
    starts = placed.select("file", "block", "first_line", "expects_action", "tail_before")
    role = F.when(F.col("expects_action"), F.col("role_a")).otherwise(F.col("role_d"))
    staged = (
        lines.join(starts, ["file", "block"])
        .withColumn("role", role)
        .filter(F.col("role").isin("doc", "delete"))
    )
    is_doc = F.col("role") == "doc"
    number = F.col("first_line") + F.col("line")
    action = F.when(
        is_doc, F.when(F.col("line") == 1, F.col("tail_before")).otherwise(F.col("before"))
    ).otherwise(F.col("value"))
    pairs = staged.select(
        "file",
        F.when(is_doc, number - 1).otherwise(number).alias("line"),
        action.alias("action"),
        F.when(is_doc, F.col("value")).alias("doc"),
    )
    parsed = _parse_actions(pairs, default_shard)
    return BulkChanges(parsed.unionByName(unfinished, allowMissingColumns=True))


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Pieces of blocks, in order: (piece, first line number, lines of `action` kind before
    each line without a break, does that run reach back to the start of the block, the line
    before the piece).

    A line that is no action leaves an action expected, whatever it was itself. After it,
    lines of action kind alternate: action, document, action, … So the length of the run
    before a line is all its role depends on.
    """
    where, line, run, whole, before = None, 0, 0, True, None
    for pdf in batches:
        place = pdf["file"] + "#" + pdf["block"].astype(str)
        cuts = np.flatnonzero((place != place.shift()).to_numpy())
        for lo, hi in zip(cuts, [*cuts[1:], len(pdf)]):
            piece = pdf.iloc[lo:hi]
            if place.iloc[lo] != where:
                where, line, run, whole, before = place.iloc[lo], 0, 0, True, None
            n = len(piece)
            stops = (piece["kind"] != "action").to_numpy()
            at = np.where(stops, np.arange(n), -1)
            last = np.concatenate([[-1], np.maximum.accumulate(at)[:-1]])
            open_run = last < 0  # no break yet in this piece
            length = np.arange(n) - last - 1 + np.where(open_run, run, 0)
            reaches = open_run & whole
            yield piece, line + 1, length, reaches, before
            whole = bool(whole and not stops.any())
            run = 0 if stops[-1] else int(length[-1]) + 1
            line, before = line + n, piece["value"].iloc[-1]


def _label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines that end a change, with their number in the block, the line before, and their
    role for both possible states at the start of the block."""
    for piece, first, length, reaches, before in _runs(batches):
        kind = piece["kind"].to_numpy()
        odd = length % 2 == 1
        role_a = np.where(odd, "doc", kind)
        role_d = np.where(reaches & ~odd, "doc", np.where(reaches, kind, role_a))
        ends = np.isin(role_a, ["doc", "delete"]) | np.isin(role_d, ["doc", "delete"])
        out = pd.DataFrame(
            {
                "file": piece["file"],
                "block": piece["block"],
                "line": first + np.arange(len(piece)),
                "value": piece["value"],
                "before": piece["value"].shift(1),
                "role_a": role_a,
                "role_d": role_d,
            }
        )
        out.iloc[0, out.columns.get_loc("before")] = before
        yield out[ends]


def _summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per block: lines, the state at its end for both states, its last line."""
    held = None
    for piece, first, length, reaches, _ in _runs(batches):
        file, block, value, kind = piece.iloc[-1]
        after_a = kind != "action" or length[-1] % 2 == 1
        after_d = after_a if kind != "action" or not reaches[-1] else not after_a
        if held is not None and held[:2] != (file, block):
            yield pd.DataFrame([held], columns=BLOCKS.names)
        held = (file, block, int(first) + len(piece) - 1, bool(after_a), bool(after_d), value)
    if held is not None:
        yield pd.DataFrame([held], columns=BLOCKS.names)


def _parse_actions(pairs: DataFrame, default_shard: str | None) -> DataFrame:
    inner = F.call_function("get_json_object", F.col("action"), F.concat(F.lit("$."), F.col("op")))
    meta = F.from_json(inner, "map<string,string>")
    staged = pairs.withColumn("op", F.regexp_extract("action", ACTION_NAME, 1)).withColumn("_raw", meta)
    renames = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    staged = staged.withColumn(
        "_meta",
        F.transform_keys("_raw", lambda k, v: F.coalesce(F.try_element_at(renames, k), k)),
    )
    strangers = F.filter(F.map_keys("_meta"), lambda k: ~k.isin(*META))
    shard_given = F.coalesce(F.try_element_at("_meta", F.lit("shard_no")), F.lit("")) != ""
    reason = (
        F.when(F.coalesce(F.json_array_length(F.concat(F.lit("["), "action", F.lit("]"))), F.lit(0)) != 1, "malformed action")
        .when(~F.col("op").isin(*ACTIONS), "unknown action")
        .when(F.col("_meta").isNull(), "malformed metadata")
        .when(F.size(strangers) > 0, F.concat(F.lit("unknown key "), F.array_join(strangers, ",")))
    )
    if not default_shard:
        reason = reason.when(shard_given, "shard is set by the request only")

    def value(name: str) -> Column:
        return F.try_element_at("_meta", F.lit(name)).try_cast(META[name])

    body = F.from_json("doc", "doc string, upsert string, script string, doc_as_upsert boolean, detect_noop boolean")
    is_update = F.col("op") == "update"
    created = (F.col("op") == "index") & (value("op_type") == "create")
    return staged.withColumn("_body", F.when(is_update, body)).select(
        "file",
        "line",
        "action",
        F.when(created, F.lit("create")).otherwise(F.col("op")).alias("op"),
        value("_id").alias("id"),
        value("_index").alias("index"),
        *[
            value(n).alias(n)
            for n in (
                "routing", "version", "version_type", "if_seq_no", "if_primary_term",
                "retry_on_conflict", "pipeline",
            )
        ],
        F.when(is_update, F.col("_body.doc")).otherwise(F.col("doc")).alias("doc"),
        F.col("_body.upsert").alias("upsert_doc"),
        F.col("_body.script").alias("script"),
        F.col("_body.doc_as_upsert").alias("doc_as_upsert"),
        F.col("_body.detect_noop").alias("detect_noop"),
        reason.alias("reason"),
    )
