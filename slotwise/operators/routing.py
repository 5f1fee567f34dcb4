"""Slots and shards: where a row lives and which directories a routed read touches."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.text import md5_int, slot_hash

MAX_SLOTS = 1024  # fixed value: largest slot count a table may have


def check_slots(slot_count: int | None) -> int:
    if slot_count is None or not 1 <= slot_count <= MAX_SLOTS:
        raise ValueError(f"slot count must be 1..{MAX_SLOTS}, not [{slot_count}]")
    return slot_count


def slot_of(routing: Column, slot_count: int, method: str = "xxhash64") -> Column:
    return F.pmod(slot_hash(routing, method), F.lit(check_slots(slot_count))).cast("int")


def assign_slot(
    df: DataFrame,
    id_col: str,
    slot_count: int,
    shards: int,
    routing_col: str | None = None,
    batch: Column | str | int = 0,
    method: str = "xxhash64",
) -> DataFrame:
    """Add `slot` and `shard`.

    The slot comes from the routing value, or the id where routing is null. A slot owns
    `shards // slot_count` shards (left-over shards stay unused); within it one shard is
    picked per batch, by a draw of 0..99 seeded with the batch, so a rerun gives the same.
    """
    slot_size = shards // check_slots(slot_count)
    if slot_size < 1:
        raise ValueError(f"{shards} shards cannot fill {slot_count} slots")
    routing = F.col(id_col).cast("string")
    if routing_col is not None:
        routing = F.coalesce(F.col(routing_col).cast("string"), routing)
    batch = batch if isinstance(batch, Column) else F.lit(batch)
    rank = F.pmod(F.pmod(md5_int(batch), F.lit(100)), F.lit(slot_size))
    return df.withColumn("slot", slot_of(routing, slot_count, method)).withColumn(
        "shard", (F.col("slot") * slot_size + rank).cast("int")
    )


def slot_prune(
    df: DataFrame,
    routing: Iterable[str] | None,
    slot_count: int | None,
    method: str = "xxhash64",
) -> DataFrame:
    """Rows of the slots the routing values hash to; no routing values: all slots.

    Rows of other routing values in the same slots come along; filter on the routing
    column as well for an exact result. The slot numbers are constant expressions, folded
    before planning, so a table partitioned by slot reads only their directories.
    """
    check_slots(slot_count)
    values = list(routing or ())
    if not values:
        return df
    return df.filter(F.col("slot").isin([slot_of(F.lit(v), slot_count, method) for v in values]))


def require_routing(routing: Iterable[str] | None) -> list[str]:
    """Routed search refuses requests that name no routing value."""
    values = [v for v in routing or () if v]
    if not values:
        raise ValueError("routing is required")
    return values


def pick_least_loaded(df: DataFrame, spark: SparkSession, shards: Iterable[int], shard_col: str = "shard") -> DataFrame:
    """The one listed shard with fewest rows, the lowest number on ties."""
    listed = spark.createDataFrame([(int(s),) for s in shards], "shard int")
    counts = df.groupBy(F.col(shard_col).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    load = listed.join(counts, "shard", "left").select(
        F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shard").alias("load")
    )
    return load.agg(F.min("load").alias("load")).select(
        F.col("load.shard").alias("shard"), F.col("load.n").alias("doc_count")
    )


def fixed_shard(df: DataFrame, shard: int) -> DataFrame:
    """The caller's shard for the whole batch."""
    if shard < 0:
        raise ValueError("shard must not be negative")
    return df.withColumn("shard", F.lit(int(shard)))


def custom_partition(
    df: DataFrame, key: str, suffixes: Iterable[tuple[str, int]], default: int
) -> DataFrame:
    """Add `partition_id` by the first suffix the key ends with."""
    rule = None
    for suffix, target in suffixes:
        hit = F.col(key).endswith(suffix)
        rule = F.when(hit, target) if rule is None else rule.when(hit, target)
    column = F.lit(default) if rule is None else rule.otherwise(default)
    return df.withColumn("partition_id", column.cast("int"))


def place_partitions(df: DataFrame, count: int) -> DataFrame:
    """Move each row to the physical partition its `partition_id` names."""
    return df.repartitionById(count, F.col("partition_id"))


def in_slice(id_col: str, index: int, count: int, method: str = "xxhash64") -> Column:
    if not 0 <= index < count:
        raise ValueError(f"slice {index} of {count}")
    return F.pmod(slot_hash(F.col(id_col), method), F.lit(count)) == index


def slice_rows(df: DataFrame, id_col: str, index: int, count: int, method: str = "xxhash64") -> DataFrame:
    """Part `index` of `count` disjoint parts that together are the whole."""
    return df.filter(in_slice(id_col, index, count, method))
