"""Named parameterised datasets, result formats, and charts made of several datasets."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, NUMBER, NONE = "STRING", "NUMBER", "NONE"  # fixed values: format types


@dataclass(frozen=True)
class ResultFormat:
    """How date, time of day and timestamp columns are shown."""

    date: str = STRING
    time: str = STRING
    timestamp: str = STRING
    date_pattern: str = "yyyy-MM-dd"
    time_pattern: str = "HH:mm:ss"
    timestamp_pattern: str = "yyyy-MM-dd HH:mm:ss"
    zone: str = "UTC"


def format_result(df: DataFrame, fmt: ResultFormat, times: Sequence[str] = ()) -> DataFrame:
    """Format temporal columns by their type; timestamp columns listed in `times` count as
    times of day. NUMBER gives epoch milliseconds, of the day for times."""
    return df.select(*[_formatted(f, fmt, f.name in times).alias(f.name) for f in df.schema.fields])


def _formatted(f: T.StructField, fmt: ResultFormat, is_time: bool) -> Column:
    column = F.col(f.name)
    if isinstance(f.dataType, T.DateType):
        kind, pattern = fmt.date, fmt.date_pattern
    elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
        kind, pattern = (fmt.time, fmt.time_pattern) if is_time else (fmt.timestamp, fmt.timestamp_pattern)
    else:
        return column
    if kind == NONE:
        return column
    if kind not in (STRING, NUMBER):
        raise ValueError(f"unknown format type [{kind}]")
    if kind == STRING:
        shown = column
        if isinstance(f.dataType, T.TimestampType) and fmt.zone != "UTC":
            shown = F.from_utc_timestamp(column, fmt.zone)
        return F.date_format(shown, pattern)
    millis = F.unix_millis(column.cast("timestamp"))
    return F.pmod(millis, F.lit(86_400_000)) if is_time else millis


@dataclass(frozen=True)
class DataSet:
    """A named SQL text; `:name` marks a parameter, which is always a list of values. Write
    `column IN (:name)` to compare with the values, or use `:name` as an array."""

    id: str
    sql: str
    defaults: Mapping[str, Sequence[Any]] = field(default_factory=dict)


def dataset_query(
    spark: SparkSession,
    dataset: DataSet,
    params: Mapping[str, Sequence[Any]] | None = None,
    fmt: ResultFormat | None = None,
) -> DataFrame:
    """Run the dataset with its parameters bound: values never become SQL text.

    In `IN (:name)` every value gets a marker of its own, so that the list reaches the scan
    as a filter; an empty list matches nothing. Elsewhere a parameter is an array.
    """
    sql, args = dataset.sql, {}
    for name, items in {**dataset.defaults, **(params or {})}.items():
        values = list(items) or [None]
        marks = {f"{name}_{i}": v for i, v in enumerate(values)}
        listed = ", ".join(f":{mark}" for mark in marks)
        sql, found = re.subn(rf"(?i)\bIN\s*\(\s*:{re.escape(name)}\s*\)", f"IN ({listed})", sql)
        if found:
            args |= marks
        if re.search(rf":{re.escape(name)}\b", sql):
            args[name] = F.array(*[F.lit(v) for v in items])
    df = spark.sql(sql, args=args)
    return format_result(df, fmt) if fmt else df


@dataclass(frozen=True)
class ChartSeries:
    """A dataset in a chart, with the columns that give x, series and y."""

    dataset: str
    x: str
    y: str
    series: str | None = None


def chart_query(
    spark: SparkSession,
    chart: Sequence[ChartSeries],
    datasets: Mapping[str, DataSet],
    queries: Mapping[str, Mapping[str, Sequence[Any]]],
) -> list[DataFrame]:
    """The results of a chart's datasets, each with its own parameters, in chart order."""
    missing = [c.dataset for c in chart if c.dataset not in datasets]
    if missing:
        raise ValueError(f"no such datasets {missing}")
    return [dataset_query(spark, datasets[c.dataset], queries.get(c.dataset)) for c in chart]


def chart_long(chart: Sequence[ChartSeries], frames: Sequence[DataFrame]) -> DataFrame:
    """All of a chart in one frame (position, dataset, x, series, y)."""
    parts = [
        df.select(
            F.lit(pos).alias("position"),
            F.lit(c.dataset).alias("dataset"),
            F.col(c.x).cast("string").alias("x"),
            (F.col(c.series).cast("string") if c.series else F.lit(None).cast("string")).alias("series"),
            F.col(c.y).cast("double").alias("y"),
        )
        for pos, (c, df) in enumerate(zip(chart, frames))
    ]
    return reduce(DataFrame.unionByName, parts)
