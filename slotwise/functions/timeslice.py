"""Ordered per-key work cut into slices, so that no key needs one task to itself.

Two shapes cover every ordered operator of this package:

* `with_halo`: the operator looks at most a fixed time back or ahead. Each time slice
  gets copies of the rows near its edges, and a window over (key, slice) sees all it needs.
* `prefix_scan`: the operator needs a running value over the whole past, or in reverse over
  all that follows. Slices are scanned separately, their totals are aggregated map-side,
  scanned per key (one row per slice) and joined back.

Slices for scans come from `key_slices`, which hold equally many rows whatever the key or time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.session import stored


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def event_micros(ts: Column) -> Column:
    """Event time as BIGINT microseconds."""
    return F.unix_micros(ts.cast("timestamp"))


def floor_div(value: Column, width: int) -> Column:
    """Floor division on BIGINT, exact for negative values too."""
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


def even_slices(df: DataFrame, order: str, parts: int | None = None) -> Column:
    """Slice numbers with about the same number of rows each, wherever the rows lie; twice as many
    as Spark has partitions for shuffles, if their number is not given.

    The cuts are quantiles from one pass over the column `order`. With them no (key, slice)
    holds much more than 1/parts of the rows, however hot the key or short the burst; only
    rows with equal `order` cannot be parted. The search for the slice is a tree of
    comparisons.
    """
    parts = parts or 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = [i / parts for i in range(1, parts)]
    cuts = sorted(set(df.approxQuantile(order, points, 1 / (4 * parts))))

    def place(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(order) < cuts[mid], place(lo, mid)).otherwise(place(mid + 1, hi))

    return place(0, len(cuts)).cast("bigint")


def key_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None) -> DataFrame:
    """`df` with `_slice`, the number of its range of (keys, order): ranges hold equally many rows.

    A key with most of the rows has most of the ranges, a burst within one instant is cut like any
    other rows, and a key with few rows lies in one or two ranges. Their number is Spark's for
    shuffles if not given. The rows are written once, so that all parts of a plan see the same
    ranges; hand in only the columns needed.
    """
    place = [*keys, *order]
    ranged = df.repartitionByRange(ranges, *place) if ranges else df.repartitionByRange(*place)
    return stored(ranged.withColumn("_slice", F.spark_partition_id().cast("bigint")), "slices")


def with_halo(
    df: DataFrame, us: str, width: timedelta, before: timedelta, after: timedelta
) -> DataFrame:
    """Add `_slice` and `_core`; rows near an edge also appear, with `_core` false, in the
    neighbour that must see them: a slice holds everything from `before` ahead of its start
    to `after` past its end. With a slice wider than the halo a row has at most 3 copies.
    """
    w = max(micros(width), micros(before) + micros(after), 1)
    own = floor_div(F.col(us), w)
    lo = floor_div(F.col(us) - micros(after), w)
    hi = floor_div(F.col(us) + micros(before), w)
    return df.withColumn("_slice", F.explode(F.sequence(lo, hi))).withColumn(
        "_core", F.col("_slice") == own
    )


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    slice_col: str,
    order: Sequence[str],
    values: dict[str, tuple[str, Column]],
    inclusive: bool = True,
    seed: tuple[DataFrame, dict[str, str]] | None = None,
    reverse: bool = False,
    null_keys: bool = True,
) -> DataFrame:
    """Running values over rows of a key in `order`, without a window over the whole key.

    `values` maps an output column to (kind, expression), kind one of `sum`, `max`, `last`
    (last non-null). `slice_col` must not decrease along `order`. With `inclusive=False`
    the current row is left out. `seed` is (frame with one row per key, {output: column}):
    a starting value before the first row, also given back as `_seed_{output}`. `reverse` scans
    from the last row back, `last` then being the nearest later one. Where `df` has the column
    `_k`, a struct of the keys, it is used and kept: scans in a row then share one shuffle.
    A scan reads `df` twice, so write it in between where many follow each other.
    Without `null_keys` a null key has no seed, and a seed frame that is laid out by its keys, such
    as a bucketed table, is joined where it lies.
    """
    local_end = 0 if inclusive else -1
    made = "_k" not in df.columns
    staged = df.withColumn("_k", F.struct(*[F.col(k) for k in keys])) if made else df
    staged = staged.withColumns({f"_v_{out}": expr for out, (_, expr) in values.items()})

    totals = []
    for out, (kind, _) in values.items():
        v = F.col(f"_v_{out}")
        if kind == "sum":
            totals.append(F.sum(v).alias(f"_t_{out}"))
        elif kind == "max":
            totals.append(F.max(v).alias(f"_t_{out}"))
        elif kind == "last":
            at = F.when(v.isNotNull(), F.col(order[0]) if len(order) == 1 else F.struct(*order))
            totals.append((F.min_by(v, at) if reverse else F.max_by(v, at)).alias(f"_t_{out}"))
        else:
            raise ValueError(f"unknown scan kind [{kind}]")
    summary = staged.groupBy("_k", slice_col).agg(*totals)

    if seed is not None:
        seed_df, seed_cols = seed
        starts = [F.col(c).alias(f"_seed_{out}") for out, c in seed_cols.items()]
        if null_keys:
            summary = summary.join(seed_df.select(F.struct(*[F.col(k) for k in keys]).alias("_k"), *starts), "_k", "left")
        else:
            own = [f"_s_{k}" for k in keys]
            summary = summary.withColumns({o: F.col("_k")[k] for o, k in zip(own, keys)})
            given = seed_df.select(*[F.col(k).alias(o) for o, k in zip(own, keys)], *starts)
            summary = summary.join(given, own, "left").drop(*own)
    way = F.desc if reverse else F.asc
    past = W.partitionBy("_k").orderBy(way(slice_col)).rowsBetween(W.unboundedPreceding, -1)
    carried = {}
    for out, (kind, _) in values.items():
        carried[f"_c_{out}"] = _over(kind, F.col(f"_t_{out}"), past)
        if seed is not None and out in seed[1]:
            carried[f"_c_{out}"] = _merge(kind, F.col(f"_seed_{out}"), carried[f"_c_{out}"])
    seeds = [f"_seed_{out}" for out in (seed[1] if seed is not None else {})]
    carry = summary.withColumns(carried).select("_k", slice_col, *carried, *seeds)

    local = (
        W.partitionBy("_k", slice_col)
        .orderBy(*[way(c) for c in order])
        .rowsBetween(W.unboundedPreceding, local_end)
    )
    joined = staged.join(carry, ["_k", slice_col], "left")
    result = joined.withColumns(
        {
            out: _merge(kind, F.col(f"_c_{out}"), _over(kind, F.col(f"_v_{out}"), local))
            for out, (kind, _) in values.items()
        }
    )
    drop = ["_k"] * made + [f"_v_{o}" for o in values] + [f"_c_{o}" for o in values]
    return result.drop(*drop)


def _over(kind: str, value: Column, window) -> Column:
    if kind == "sum":
        return F.sum(value).over(window)
    if kind == "max":
        return F.max(value).over(window)
    return F.last(value, ignorenulls=True).over(window)


def _merge(kind: str, earlier: Column, later: Column) -> Column:
    if kind == "sum":
        zero = F.lit(0)
        return F.coalesce(earlier + later, later, earlier, zero)
    if kind == "max":
        return F.greatest(earlier, later)
    return F.coalesce(later, earlier)
