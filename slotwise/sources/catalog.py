"""Several tables behind one name: patterns, aliases, filters, statistics."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Alias:
    """A name for some tables, optionally filtered and tied to search routing values."""

    name: str
    tables: tuple[str, ...]
    filter: Column | None = None
    routing: frozenset[str] = field(default_factory=frozenset)


def resolve_names(expression: str, known: Iterable[str], aliases: Iterable[Alias] = ()) -> list[str]:
    """Table names for a comma list of names, `*` patterns and aliases, each once."""
    known = list(known)
    by_alias = {a.name: a for a in aliases}
    found: dict[str, None] = {}
    for part in (p.strip() for p in expression.split(",")):
        if not part:
            continue
        if part in by_alias:
            hits = list(by_alias[part].tables)
        else:
            hits = sorted(n for n in known if fnmatch.fnmatchcase(n, part))
        if not hits and "*" not in part:
            raise ValueError(f"no such table [{part}]")
        found.update(dict.fromkeys(hits))
    return list(found)


def table_names(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables()]


def multi_scan(
    spark: SparkSession, expression: str, aliases: Iterable[Alias] = ()
) -> DataFrame:
    """One frame over many tables; columns a table lacks are null, `_table` names the source."""
    names = resolve_names(expression, table_names(spark), aliases)
    if not names:
        raise ValueError(f"nothing matches [{expression}]")
    frames = [spark.table(n).withColumn("_table", F.lit(n)) for n in names]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def effective_routing(
    alias: Alias, request: Iterable[str] | None
) -> dict[str, frozenset[str] | None]:
    """Routing values per table of an alias.

    None means every slot. An alias without routing takes the request's values; with both,
    only common values count, and a table left with none drops out of the map.
    """
    wanted = frozenset(request or ())
    if not alias.routing:
        routing = wanted or None
    elif not wanted:
        routing = alias.routing
    else:
        routing = alias.routing & wanted
        if not routing:
            return {}
    return {t: routing for t in alias.tables}


def alias_view(
    spark: SparkSession,
    alias: Alias,
    routing_col: str | None = None,
    request: Iterable[str] | None = None,
) -> DataFrame:
    """The alias as a frame: its tables, its filter, and rows of the effective routing."""
    df = multi_scan(spark, ",".join(alias.tables))
    if alias.filter is not None:
        df = df.filter(alias.filter)
    if routing_col is not None:
        routing = effective_routing(alias, request)
        keep = F.lit(False)
        for table, values in routing.items():
            hit = F.col("_table") == table
            if values is not None:
                hit = hit & F.col(routing_col).cast("string").isin(sorted(values))
            keep = keep | hit
        df = df.filter(keep)
    return df


def table_stats(spark: SparkSession, expression: str = "*") -> DataFrame:
    """(table_name, row_count) of the matching tables; counts come from file footers
    where the format keeps them."""
    names = resolve_names(expression, table_names(spark))
    counts = [
        spark.table(n)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    return reduce(DataFrame.unionByName, counts)
