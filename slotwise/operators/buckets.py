"""Aggregations over matching documents, and aggregations over their buckets.

All of them are partial-then-final aggregates: what reaches a shuffle is one row per
(task, bucket). The float sums are exact because they run on decimals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions.timeslice import key_slices, micros, prefix_scan
from slotwise.session import stored

COUNT = "doc_count"


def stats_columns(field: str, prefix: str = "", scale: int = 2) -> list[Column]:
    """count, min, max, avg and sum of a numeric field, sums on decimals of `scale`."""
    total = F.sum(F.col(field).cast(f"decimal(18,{scale})")).cast("double")
    return [
        F.count(field).alias(f"{prefix}count"),
        F.min(field).alias(f"{prefix}min"),
        F.max(field).alias(f"{prefix}max"),
        (total / F.count(field)).alias(f"{prefix}avg"),
        total.alias(f"{prefix}sum"),
    ]


def terms(
    df: DataFrame, field: str, size: int | None = 10, metrics: Sequence[Column] = ()
) -> DataFrame:
    """Buckets per value, largest first (ties by value); documents without the field count
    in none. `size=None` keeps all."""
    buckets = (
        df.filter(F.col(field).isNotNull())
        .groupBy(F.col(field).alias("bucket"))
        .agg(F.count(F.lit(1)).alias(COUNT), *metrics)
    )
    if size is None:
        return buckets
    return buckets.orderBy(F.desc(COUNT), F.asc("bucket")).limit(size)


def stats(df: DataFrame, field: str) -> DataFrame:
    return df.agg(*stats_columns(field))


def cardinality(df: DataFrame, field: str, exact: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct values: a sketch, or the exact count by a shuffle on the value."""
    if exact:
        distinct = df.filter(F.col(field).isNotNull()).groupBy(field).agg(F.lit(1).alias("one"))
        return distinct.agg(F.count(F.lit(1)).alias("value"))
    return df.agg(F.approx_count_distinct(field, rsd).alias("value"))


PERCENTS = (1, 5, 25, 50, 75, 95, 99)
SKETCH_BITS = 14  # registers of a sketch of distinct values, as a power of two
ACCURACY = 100_000


def percentiles(df: DataFrame, field: str, percents: Sequence[float] = PERCENTS) -> DataFrame:
    """One row (percent, value) per percent, exact at every size: the smallest value that at
    least that share of the values does not exceed; no rows where no document has the field.

    A quantile sketch gives bounds around every percentile. Values within them, some 4/ACCURACY
    of the rows per percent, are counted by value and ranked; all others are only counted.
    """
    marks = sorted({float(p) for p in percents})
    low = [max(p / 100 - 2 / ACCURACY, 0.0) for p in marks]
    high = [min(p / 100 + 2 / ACCURACY, 1.0) for p in marks]
    rows = df.filter(F.col(field).isNotNull()).select(F.col(field).alias("v"), F.col(field).cast("double").alias("x"))
    sketch = rows.agg(F.percentile_approx("x", low + high, ACCURACY).alias("both"), F.count(F.lit(1)).alias("total"))
    k = len(marks)
    lows, highs = F.slice("both", 1, k).alias("low"), F.slice("both", k + 1, k).alias("high")
    bounds = sketch.select(F.struct(lows, highs, "total")).scalar()

    x = F.col("x")
    within = F.zip_with("cut.low", "cut.high", lambda lo, hi: (lo <= x) & (x <= hi))
    counts = (
        rows.withColumn("cut", bounds)
        .groupBy(
            F.size(F.filter("cut.low", lambda lo: lo <= x)).alias("reached"),
            F.when(F.array_contains(within, True), F.col("v")).alias("v"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    below = F.col("reached") <= F.col("i")
    inside = F.col("v").cast("double") <= F.col("cut.high")[F.col("i")]
    shares = (
        counts.withColumn("cut", bounds)
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
        .filter(below | inside)
        .select("i", F.when(~below, F.col("v")).alias("v"), "n", F.col("cut.total").alias("total"))
    )
    up_to = W.partitionBy("i").orderBy(F.col("v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    percent = F.array(*[F.lit(p) for p in marks])[F.col("i")]
    rank = F.greatest(F.ceil(percent * F.col("total") / 100), F.lit(1))
    reached = shares.withColumn("seen", F.sum("n").over(up_to)).filter((F.col("seen") >= rank) & F.col("v").isNotNull())
    return reached.groupBy("i").agg(F.min("v").alias("value")).select(percent.alias("percent"), "value")


def percentiles_sketch(
    df: DataFrame, field: str, percents: Sequence[float] = PERCENTS, accuracy: int = 10_000
) -> DataFrame:
    """As `percentiles`, in one pass and approximate: ranks are off by up to rows / `accuracy`."""
    points = [p / 100 for p in percents]
    sketch = df.agg(F.percentile_approx(field, points, accuracy).alias("v"))
    pairs = F.arrays_zip(F.array(*[F.lit(float(p)) for p in percents]).alias("percent"), F.col("v").alias("value"))
    return sketch.select(F.explode(pairs).alias("p")).select("p.percent", "p.value")


def histogram(df: DataFrame, field: str, interval: float, offset: float = 0.0) -> DataFrame:
    """Buckets [bucket, bucket + interval); empty ones are left out."""
    value = F.col(field)
    bucket = F.floor((value - offset) / interval) * interval + offset
    return (
        df.filter(value.isNotNull())
        .groupBy(bucket.cast("double").alias("bucket"))
        .agg(F.count(F.lit(1)).alias(COUNT))
    )


CALENDAR = ("minute", "hour", "day", "week", "month", "quarter", "year")


def date_histogram(
    df: DataFrame, field: str, interval: str | timedelta, metrics: Sequence[Column] = ()
) -> DataFrame:
    """Buckets by calendar unit or by a fixed interval counted from the epoch."""
    if isinstance(interval, timedelta):
        bucket = F.window(F.col(field).cast("timestamp"), f"{micros(interval)} microseconds")["start"]
    elif interval in CALENDAR:
        bucket = F.date_trunc(interval, F.col(field))
    else:
        raise ValueError(f"unknown interval [{interval}]")
    return (
        df.filter(F.col(field).isNotNull())
        .groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias(COUNT), *metrics)
    )


def ranges(df: DataFrame, field: str, bounds: Sequence[tuple[float | None, float | None]]) -> DataFrame:
    """Buckets [lo, hi), which may overlap and may be open; empty ones count 0. One pass:
    a conditional count per range."""
    counts, names = [], []
    for lo, hi in bounds:
        inside = F.col(field).isNotNull()
        if lo is not None:
            inside = inside & (F.col(field) >= lo)
        if hi is not None:
            inside = inside & (F.col(field) < hi)
        names.append(f"{'*' if lo is None else lo}-{'*' if hi is None else hi}")
        counts.append(F.count_if(inside))
    pairs = F.array(*[F.struct(F.lit(n).alias("bucket"), c.alias(COUNT)) for n, c in zip(names, counts)])
    return df.agg(pairs.alias("b")).select(F.explode("b").alias("b")).select("b.bucket", f"b.{COUNT}")


def filter_bucket(df: DataFrame, predicate: Column, metrics: Sequence[Column] = ()) -> DataFrame:
    return df.filter(predicate).agg(F.count(F.lit(1)).alias(COUNT), *metrics)


KINDS = {
    "terms": terms,
    "stats": stats,
    "cardinality": cardinality,
    "percentiles": percentiles,
    "percentiles_sketch": percentiles_sketch,
    "histogram": histogram,
    "date_histogram": date_histogram,
    "range": ranges,
    "filter": filter_bucket,
}


def agg_search(df: DataFrame, aggs: dict[str, tuple[str, dict[str, Any]]]) -> dict[str, DataFrame]:
    """Named aggregations {name: (kind, arguments)} over the matching documents, each lazy."""
    out = {}
    for name, (kind, args) in aggs.items():
        if kind not in KINDS:
            raise ValueError(f"unknown aggregation [{kind}]")
        out[name] = KINDS[kind](df, **args)
    return out


# ---------------------------------------------------------------------------------------
# Trees of buckets


@dataclass(frozen=True)
class Level:
    """One level of a tree: the labels of the buckets a document is in (an array, empty for none),
    and how many buckets of each parent stay, largest first (ties by label); None for all."""

    name: str
    labels: Column
    size: int | None = None


def _single(label: Column) -> Column:
    return F.filter(F.array(label), lambda x: x.isNotNull())


def by_terms(name: str, field: str, size: int | None = 10) -> Level:
    return Level(name, _single(F.col(field)), size)


def by_histogram(name: str, field: str, interval: float, offset: float = 0.0) -> Level:
    return Level(name, _single((F.floor((F.col(field) - offset) / interval) * interval + offset).cast("double")))


def by_date(name: str, field: str, unit: str) -> Level:
    if unit not in CALENDAR:
        raise ValueError(f"unknown interval [{unit}]")
    return Level(name, _single(F.date_trunc(unit, F.col(field))))


def by_ranges(name: str, field: str, bounds: Sequence[tuple[float | None, float | None]]) -> Level:
    """Ranges [lo, hi) may overlap: a document is in every one that holds it."""
    tests = []
    for lo, hi in bounds:
        inside = F.col(field).isNotNull()
        inside = inside & (F.col(field) >= lo) if lo is not None else inside
        inside = inside & (F.col(field) < hi) if hi is not None else inside
        tests.append(F.when(inside, f"{'*' if lo is None else lo}-{'*' if hi is None else hi}"))
    return Level(name, F.filter(F.array(*tests), lambda t: t.isNotNull()))


def by_filters(name: str, filters: dict[str, Column]) -> Level:
    tests = [F.when(rule, label) for label, rule in filters.items()]
    return Level(name, F.filter(F.array(*tests), lambda t: t.isNotNull()))


def tree(df: DataFrame, levels: Sequence[Level], metrics: Sequence[Column] = ()) -> DataFrame:
    """Buckets within buckets: a row (depth, a column per level, doc_count, metrics) for each bucket
    of each level, columns of deeper levels being null.

    One grouping makes them all: a row counts once in each bucket of each depth on its paths, which
    is combined in every task. Buckets are then limited from the top down, children of dropped
    ones going with them; for that the buckets, not the documents, are read once per level.
    """
    if not levels:
        raise ValueError("a tree needs a level")
    names = [level.name for level in levels]
    kinds = [df.select(level.labels.alias("l")).schema["l"].dataType.elementType for level in levels]

    def deeper(paths: Column, d: int) -> Column:
        """All paths, each with every label of level d."""

        def extended(p: Column) -> Column:
            return F.transform(levels[d].labels, lambda x: F.struct(*[(x if j == d else p[n]).alias(n) for j, n in enumerate(names)]))

        return F.flatten(F.transform(paths, extended))

    def marked(paths: Column, d: int) -> Column:
        return F.transform(paths, lambda p: F.struct(F.lit(d + 1).alias("depth"), *[p[n].alias(n) for n in names]))

    paths, found = F.array(F.struct(*[F.lit(None).cast(k).alias(n) for n, k in zip(names, kinds)])), []
    for d in range(len(levels)):
        paths = deeper(paths, d)
        found.append(marked(paths, d))
    rows = df.withColumn("_b", F.explode(F.concat(*found)))
    group = [F.col(f"_b.{n}").alias(n) for n in ("depth", *names)]
    all_ = rows.groupBy(*group).agg(F.count(F.lit(1)).alias(COUNT), *metrics)
    if all(level.size is None for level in levels):
        return all_
    all_, kept, out = stored(all_, "buckets"), None, []
    for d, level in enumerate(levels):
        own = all_.filter(F.col("depth") == d + 1)
        if kept is not None:
            own = own.withColumn("_p", F.struct(*names[:d])).join(kept.select(F.struct(*names[:d]).alias("_p")), "_p", "left_semi").drop("_p")
        if level.size is not None:
            order = [F.desc(COUNT), F.asc(names[d])]
            if d == 0:
                own = own.orderBy(*order).limit(level.size)
            else:
                rank = F.row_number().over(W.partitionBy(*names[:d]).orderBy(*order))
                own = own.withColumn("_r", rank).filter(F.col("_r") <= level.size).drop("_r")
        kept = own
        out.append(own)
    return reduce(DataFrame.unionByName, out)


# ---------------------------------------------------------------------------------------
# Aggregates of parts of a table that are stored and merged


def partial_aggregates(df: DataFrame, by: Sequence[str], fields: Sequence[str], scale: int = 2) -> DataFrame:
    """One row per part (`by`): documents, and for each field count, least, greatest and sum, a
    sketch of its distinct values and one of its quantiles. Rows of this kind can be stored with a
    table version and merged with those of other parts."""
    columns = [F.count(F.lit(1)).alias(COUNT)]
    for f in fields:
        x = F.col(f).cast("double")
        columns += [
            F.count(f).alias(f"{f}_count"), F.min(f).alias(f"{f}_min"), F.max(f).alias(f"{f}_max"),
            F.sum(F.col(f).cast(f"decimal(18,{scale})")).alias(f"{f}_sum"),
            F.hll_sketch_agg(F.col(f).cast("string"), F.lit(SKETCH_BITS)).alias(f"{f}_distinct"), F.kll_sketch_agg_double(x).alias(f"{f}_quantiles"),
        ]
    return df.groupBy(*by).agg(*columns)


def _merges(fields: Sequence[str]) -> list[Column]:
    columns = [F.sum(COUNT).alias(COUNT)]
    for f in fields:
        columns += [
            F.sum(f"{f}_count").alias(f"{f}_count"), F.min(f"{f}_min").alias(f"{f}_min"), F.max(f"{f}_max").alias(f"{f}_max"),
            F.sum(f"{f}_sum").alias(f"{f}_sum"), F.hll_union_agg(f"{f}_distinct").alias(f"{f}_distinct"),
            F.kll_merge_agg_double(f"{f}_quantiles").alias(f"{f}_quantiles"),
        ]
    return columns


def merged_aggregates(parts: DataFrame, by: Sequence[str], fields: Sequence[str], batch: int = 512) -> DataFrame:
    """Partial aggregates as one row, merged in batches of some `batch` parts and these at the end."""
    if batch < 2:
        raise ValueError("a batch needs at least two parts")
    batches = parts.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / batch)).alias("n")).scalar()
    first = parts.groupBy(F.pmod(F.xxhash64(*by), batches).alias("_batch")).agg(*_merges(fields))
    return first.agg(*_merges(fields))


def estimates(merged: DataFrame, fields: Sequence[str], percents: Sequence[float] = PERCENTS) -> DataFrame:
    """What merged rows tell: counts, bounds, sums and averages exactly, distinct values and quantiles
    (an array in the order of `percents`) as estimated by their sketches."""
    columns = [F.col(c) for c in merged.columns if not c.endswith(("_distinct", "_quantiles"))]
    for f in fields:
        points = F.array(*[F.lit(p / 100) for p in percents])
        columns += [
            (F.col(f"{f}_sum").cast("double") / F.col(f"{f}_count")).alias(f"{f}_avg"),
            F.hll_sketch_estimate(f"{f}_distinct").alias(f"{f}_cardinality"),
            F.kll_sketch_get_quantile_double(f"{f}_quantiles", points).alias(f"{f}_percentiles"),
        ]
    return merged.select(*columns)


# Over buckets, after the final merge. A bucket frame is small beside the documents; where
# it has a `group` column, its groups are handled apart.


def _over_buckets(buckets: DataFrame, order: str, group: str | None, values: dict, inclusive: bool) -> DataFrame:
    """Running values along the buckets of each group, or, in slices, along all buckets."""
    if group:
        end = 0 if inclusive else -1
        window = W.partitionBy(group).orderBy(order).rowsBetween(W.unboundedPreceding, end)
        over = {"sum": F.sum, "last": lambda v: F.last(v, ignorenulls=True)}
        return buckets.withColumns({out: over[kind](v).over(window) for out, (kind, v) in values.items()})
    sliced = key_slices(buckets, [], [order]).withColumn("_all", F.lit(0))
    return prefix_scan(sliced, ["_all"], "_slice", [order], values, inclusive).drop("_all", "_slice")


def cumulative_sum(buckets: DataFrame, value: str = COUNT, order: str = "bucket", group: str | None = None) -> DataFrame:
    return _over_buckets(buckets, order, group, {"cumulative_sum": ("sum", F.col(value))}, True)


def derivative(buckets: DataFrame, value: str = COUNT, order: str = "bucket", group: str | None = None) -> DataFrame:
    """Difference to the previous bucket, null in the first."""
    before = _over_buckets(buckets, order, group, {"_before": ("last", F.struct(F.col(value).alias("v")))}, False)
    return before.withColumn("derivative", F.col(value) - F.col("_before.v")).drop("_before")


def bucket_sort(buckets: DataFrame, order: Sequence[Column], size: int, from_: int = 0) -> DataFrame:
    return buckets.orderBy(*order).offset(from_).limit(size)
