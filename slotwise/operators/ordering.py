"""Top hits, paging, collapse and rescoring."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions.timeslice import floor_div

SortKey = tuple[str, bool]  # (field, ascending)


def parse_sort(spec: str) -> list[SortKey]:
    """`field:asc,other:desc,third` as sort keys.

    A field without suffix sorts ascending, `_score` descending; an entry with any other
    suffix is ignored.
    """
    keys: list[SortKey] = []
    for part in (p.strip() for p in spec.split(",")):
        if not part:
            continue
        name, colon, suffix = part.rpartition(":")
        if not colon:
            keys.append((part, part != "_score"))
        elif suffix in ("asc", "desc"):
            keys.append((name, suffix == "asc"))
    return keys


def sort_columns(keys: Sequence[SortKey], tie: str) -> list[Column]:
    """Missing values last in either direction, ties by id."""
    columns = [
        F.col(name).asc_nulls_last() if asc else F.col(name).desc_nulls_last() for name, asc in keys
    ]
    return [*columns, F.col(tie).asc()]


def sort_by(df: DataFrame, spec: str, tie: str) -> DataFrame:
    return df.orderBy(*sort_columns(parse_sort(spec), tie))


def top_docs(df: DataFrame, order: Sequence[Column], size: int = 10, from_: int = 0) -> DataFrame:
    """The window [from_, from_ + size) of the order. Spark keeps the best from_ + size rows
    of each partition and merges those, it does not sort the whole."""
    if from_ < 0 or size < 0:
        raise ValueError("from and size must not be negative")
    return df.orderBy(*order).offset(from_).limit(size)


def by_score(tie: str, score: str = "_score") -> list[Column]:
    return [F.col(score).desc_nulls_last(), F.col(tie).asc()]


def after_values(keys: Sequence[SortKey], tie: str, last: Sequence[Any]) -> Column:
    """Rows strictly behind the sort values `last` (one per key, then the tie value)."""
    if len(last) != len(keys) + 1:
        raise ValueError("search after needs a value per sort key and the tie value")
    fields = [*keys, (tie, True)]
    options = []
    for pos, (name, asc) in enumerate(fields):
        same = []
        for (n, _), v in zip(fields[:pos], last[:pos]):
            same.append(F.col(n).isNull() if v is None else F.col(n) == v)
        column, value = F.col(name), last[pos]
        if value is None:
            continue  # nulls come last, nothing follows them in this field
        beyond = column > value if asc else column < value
        if name != tie:
            beyond = beyond | column.isNull()
        options.append(reduce(lambda a, b: a & b, [*same, beyond]))
    return F.coalesce(reduce(lambda a, b: a | b, options), F.lit(False))


def search_after(df: DataFrame, spec: str, tie: str, last: Sequence[Any], size: int) -> DataFrame:
    """The next `size` rows behind a row's sort values."""
    keys = parse_sort(spec)
    return df.filter(after_values(keys, tie, last)).orderBy(*sort_columns(keys, tie)).limit(size)


def check_scroll(from_: int, size: int, track_total: bool) -> None:
    if not track_total:
        raise ValueError("scroll needs the total to be tracked")
    if from_ > 0:
        raise ValueError("scroll does not allow from")
    if size <= 0:
        raise ValueError("scroll needs a positive size")


def scroll_pages(
    spark: SparkSession,
    df: DataFrame,
    spec: str,
    tie: str,
    size: int,
    path: str,
    track_total: bool = True,
) -> DataFrame:
    """The whole result, sorted, as pages of `size` rows: adds `_pos` (0..) and `_page`.

    The snapshot written to `path` pins the result. It is range partitioned by the sort, so
    positions come from row counts of its parts, and no task sees more than its part.
    """
    check_scroll(0, size, track_total)
    order = sort_columns(parse_sort(spec), tie)
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    ranged.sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)
    pinned = spark.read.parquet(path)
    sizes = pinned.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per part of the snapshot
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1
    return (
        pinned.join(starts, "_part")
        .withColumn("_pos", F.col("_start") + local)
        .withColumn("_page", floor_div(F.col("_pos"), size))
        .drop("_part", "_start")
    )


def collapse(df: DataFrame, field: str, order: Sequence[Column]) -> DataFrame:
    """Best row per value of `field`; null is a value. Each task first keeps its own best
    row per value, so a hot value costs one row per task."""
    rank = F.row_number().over(W.partitionBy(field).orderBy(*order))
    return df.withColumn("_best", rank).filter("_best = 1").drop("_best")


def terminate_after(df: DataFrame, shard: str, tie: str, count: int) -> DataFrame:
    """The first `count` rows of each shard by id, of any type; 0 switches it off. The session's
    group limit lets every task keep at most `count` rows per shard before the shuffle."""
    if count < 0:
        raise ValueError("terminate_after must not be negative")
    if count == 0:
        return df
    pos = F.row_number().over(W.partitionBy(shard).orderBy(tie))
    return df.withColumn("_pos", pos).filter(F.col("_pos") <= count).drop("_pos")


def terminated_early(df: DataFrame, shard: str, count: int) -> DataFrame:
    """One row: did any shard hold more than `count` rows (never with 0)?"""
    sizes = df.groupBy(shard).agg(F.count(F.lit(1)).alias("n"))
    early = F.coalesce(F.max("n") > count, F.lit(False)) if count > 0 else F.lit(False)
    return sizes.agg(early.alias("terminated_early"))


def rescore(
    df: DataFrame, second: DataFrame, tie: str, window: int, weight: float = 1.0, score: str = "_score"
) -> DataFrame:
    """Re-rank the best `window` hits with `second` (one row (tie, second_score) per hit).

    Their score becomes score + weight * second, a missing second score counts as 0; the
    other hits keep their order below them. Adds `_rescored`; sort by it first, see
    `rescored_order`. The window may be of any size; how its ids are joined is left to Spark.
    """
    if window <= 0:
        raise ValueError("rescore window must be positive")
    best = df.select(tie, score).orderBy(*by_score(tie, score)).limit(window).select(tie)
    extra = second.join(best, tie, "left_semi")
    scored = best.join(extra, tie, "left").select(
        tie, F.lit(True).alias("_rescored"), F.coalesce("second_score", F.lit(0.0)).alias("_second")
    )
    joined = df.join(scored, tie, "left")
    return (
        joined.withColumn(
            score, F.col(score) + F.when(F.col("_rescored"), F.col("_second") * weight).otherwise(0.0)
        )
        .withColumn("_rescored", F.coalesce("_rescored", F.lit(False)))
        .drop("_second")
    )


def rescored_order(tie: str, score: str = "_score") -> list[Column]:
    return [F.col("_rescored").desc(), *by_score(tie, score)]
