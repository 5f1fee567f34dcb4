"""Joins that survive a key holding a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.001) -> DataFrame:
    """Keys holding at least `share` of the rows. There are at most 1/share of them, so
    the result may be broadcast whatever the size of `df`."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = df.agg((F.count(F.lit(1)) * F.lit(share)).alias("_t"))
    return counts.filter(F.col("_n") >= total.scalar()).select(*keys)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    share: float = 0.001,
    salts: int = 64,
) -> DataFrame:
    """Join `left` to `right` (one row per key) with the hot keys of `left` salted.

    Rows of a hot key are spread over `salts` tasks by a hash of `spread_by`, and the one
    matching right row is copied that many times; all other keys keep salt 0. The adaptive
    skew rule cannot do this when `right` is an aggregate on the same key.
    """
    hot = F.broadcast(hot_keys(left, keys, share).withColumn("_hot", F.lit(True)))
    salted = left.join(hot, list(keys), "left").withColumn(
        "_salt",
        F.when(
            F.col("_hot"), F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
        ).otherwise(F.lit(0)),
    )
    copies = right.join(hot, list(keys), "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
                F.array(F.lit(0))
            )
        ),
    )
    joined = salted.drop("_hot").join(copies.drop("_hot"), [*keys, "_salt"], how)
    return joined.drop("_salt")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan with fewer splits than cores, dealt out to all cores.

    For heavy work per row on small input, such as a file of one row group. A table with at
    least as many splits as the cluster has cores comes back as it is, unshuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
