"""Connected components of links, as alternating large and small star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stored


def _least(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with m, the least of u and its neighbours. The minima are written before they
    are joined: both sides of the join are then dealt anew, so that Spark can split a hot node."""
    least = stored(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
    return pairs.join(least, "u")


def _state(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(u, v): every linked node but the least of its component, with that least node.

    `links` has the long columns u and v in either order; loops and repeats do no harm. A step
    costs shuffles of as many pairs as there are links; their number grows with the logarithm of
    the longest chain. Nothing but two sums per step reaches the driver.
    """
    pairs = stored(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    before = _state(pairs)
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large, "large")
        small = _least(large)
        pairs = stored(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .union(small.select("u", F.col("m").alias("v"))).distinct(),
            "small",
        )
        after = _state(pairs)
        if after == before:
            return pairs
        before = after
