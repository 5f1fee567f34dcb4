"""Stream work done per micro-batch with the batch operators, and several sinks at once."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slotwise.operators.patterns import late_split, side_outputs
from slotwise.operators.windows import running_reduce


def _run(df: DataFrame, handle, checkpoint: str) -> StreamingQuery:
    query = (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_side_outputs(df: DataFrame, tags: dict[str, Column], path: str, checkpoint: str) -> StreamingQuery:
    """Each tag's rows into its own folder. A batch overwrites its own subfolder, so that a
    repeated batch leaves the same files."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        for tag, rows in side_outputs(batch, tags).items():
            rows.write.mode("overwrite").parquet(f"{path}/{tag}/batch={number}")
        batch.unpersist()

    return _run(df, write, checkpoint)


def write_late_split(
    df: DataFrame,
    arrival: str,
    us: str,
    row_id: str,
    delay: timedelta,
    slice_width: timedelta,
    path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Split arriving rows into on-time and late ones, files per batch as above.

    The largest event time so far goes from batch to batch as a one-row file named after
    the batch; a repeated batch reads its predecessor's and writes its own again.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        seen = batch.select(F.max(us).alias("seen"))
        seed = None
        if number > 0:
            seed = spark.read.parquet(f"{path}/_seen/batch={number - 1}")
            seen = seen.unionByName(seed).agg(F.max("seen").alias("seen"))
        split = late_split(batch, arrival, us, row_id, delay, slice_width, seed)
        split.on_time.write.mode("overwrite").parquet(f"{path}/on_time/batch={number}")
        split.late.write.mode("overwrite").parquet(f"{path}/late/batch={number}")
        seen.write.mode("overwrite").parquet(f"{path}/_seen/batch={number}")
        batch.unpersist()

    return _run(df, write, checkpoint)


def write_running(df: DataFrame, key: str, ts: str, row_id: str, value: str, path: str, checkpoint: str) -> StreamingQuery:
    """Running sums per key, files per batch as above.

    Each micro-batch is scanned in slices, as in batch, so that a key's rows need not meet in one
    task. The totals so far are a table per batch; a repeated batch reads its predecessor's and
    writes its own again.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        before = spark.read.parquet(f"{path}/_totals/batch={number - 1}") if number > 0 else None
        rows = running_reduce(batch, key, ts, row_id, F.col(value), seed=before)
        rows.write.mode("overwrite").parquet(f"{path}/rows/batch={number}")
        totals = batch.groupBy(key).agg(F.sum(value).alias("total"))
        if before is not None:
            totals = before.unionByName(totals).groupBy(key).agg(F.sum("total").alias("total"))
        totals.write.mode("overwrite").parquet(f"{path}/_totals/batch={number}")
        batch.unpersist()

    return _run(df, write, checkpoint)
