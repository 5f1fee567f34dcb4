"""Delimited event lines into typed columns, with malformed lines kept apart."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Separator and field order of each line format.
FORMATS = {
    "ms_key": (",", ("ms", "key")),
    "order_action": ("+", ("order_id", "action")),
    "key_state": (",", ("key", "state")),
    "key_state_bar": ("|", ("key", "state")),
    "key_ms": ("-", ("key", "ms")),
}


class ParsedLines(NamedTuple):
    """`tagged` has every line with `_ok`; `good` and `bad` are filters of it. Work on
    `tagged` to read the input once for both."""

    tagged: DataFrame
    line: str
    columns: list[str]

    @property
    def good(self) -> DataFrame:
        return self.tagged.filter("_ok").drop("_ok", self.line)

    @property
    def bad(self) -> DataFrame:
        return self.tagged.filter("NOT _ok").select(*self.columns)


def parse_events(df: DataFrame, fmt: str, line: str = "value") -> ParsedLines:
    """Split `line` by the format's separator.

    A line with fewer than two fields (trailing separators do not count) or a field `ms`
    that is no integer goes to `bad`; fields after the second are ignored. `ms` becomes
    `ts`, a timestamp.
    """
    sep, names = FORMATS[fmt]
    quoted = f"\\{sep}"
    parts = F.split(F.regexp_replace(F.col(line), f"({quoted})+$", ""), quoted)
    staged = df.withColumn("_parts", parts)
    for pos, name in enumerate(names):
        field = F.get(F.col("_parts"), pos)
        if name == "ms":
            staged = staged.withColumn("ts", F.timestamp_millis(field.try_cast("bigint")))
        else:
            staged = staged.withColumn(name, field)
    ok = F.size("_parts") >= 2
    if "ms" in names:
        ok = ok & F.col("ts").isNotNull()
    ok = F.coalesce(ok, F.lit(False))
    return ParsedLines(staged.withColumn("_ok", ok).drop("_parts"), line, df.columns)


# Row maps: one Column each, so they stay inside generated code.


def replace_delimiter(value: Column, old: str = ",", new: str = "|") -> Column:
    return F.replace(value, F.lit(old), F.lit(new))


def add_prefix(value: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), value)


def split_items(df: DataFrame, line: str, sep: str = ",") -> DataFrame:
    """One row (item, cnt = 1) per item of a packed line; empty trailing items vanish."""
    items = F.split(F.regexp_replace(F.col(line), f"(\\{sep})+$", ""), f"\\{sep}")
    return df.withColumn("item", F.explode(items)).withColumn("cnt", F.lit(1)).drop(line)
