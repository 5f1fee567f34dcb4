"""Tables laid out by slot and shard."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from slotwise.operators.routing import slot_prune


def write_slots(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write one directory per (slot, shard).

    The rebalance hint lets adaptive execution cut a heavy shard into several files and
    pack light ones together, where a plain repartition would give a shard to one task.
    """
    df.hint("rebalance", "slot", "shard").write.partitionBy("slot", "shard").mode(mode).parquet(path)


def write_buckets(df: DataFrame, name: str, path: str, id_col: str, buckets: int) -> DataFrame:
    """Write a table whose rows are laid out and sorted by id in `buckets` parts, and read it.

    Changes and replacements then come to the table: with at least as many buckets as Spark has
    partitions for shuffles, joins by `id_col` move the other side only.
    """
    if buckets < 1:
        raise ValueError("a table needs a bucket")
    rows = df.repartition(buckets, id_col)  # one file per bucket
    rows.write.bucketBy(buckets, id_col).sortBy(id_col).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def read_slots(
    spark: SparkSession,
    path: str,
    routing: Iterable[str] | None = None,
    slot_count: int | None = None,
    method: str = "xxhash64",
) -> DataFrame:
    """Read the table, only the directories of the slots `routing` maps to if it is given."""
    df = spark.read.parquet(path)
    if routing is None:
        return df
    return slot_prune(df, routing, slot_count, method)
