"""Reading streams, event time, and running them to the end of the available input."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from slotwise.functions.timeslice import event_micros, micros


def stream_source(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fmt: str = "parquet",
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """Files of a folder as a stream; `max_files` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def kafka_source_options(brokers: list[str], topics: list[str], max_offsets: int | None = None) -> dict[str, str]:
    """Options of `spark.readStream.format("kafka")`."""
    options = {
        "kafka.bootstrap.servers": ",".join(brokers),
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def with_event_time(df: DataFrame, ts: str, delay: timedelta) -> DataFrame:
    """Event time from a column: the watermark stays `delay` behind the latest row."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{micros(delay)} microseconds")


def keyed_stream(df: DataFrame, key: str, ts: str, row_id: str, delay: timedelta, *extra: Column) -> DataFrame:
    """The columns the state processors expect: key, ts (watermarked), us, id."""
    timed = with_event_time(df, ts, delay)
    return timed.select(
        F.col(key).cast("string").alias("key"),
        F.col(ts).alias("ts"),
        event_micros(F.col(ts)).alias("us"),
        F.col(row_id).alias("id"),
        *extra,
    )


def run_to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", wait: bool = True) -> StreamingQuery:
    """Process what is available into files. The sink's log and the checkpoint make every
    row appear once, also when a failed run is started again with the same folders."""
    query = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    if wait:
        query.awaitTermination()
    return query


def read_result(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def run_part(df: DataFrame, path: str, checkpoint: str, batches: int, fmt: str = "parquet") -> None:
    """Start a query into files and stop it once at least `batches` micro-batches are done, as a
    failure would. `run_to_files` with the same folders goes on from there."""
    query = (
        df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start(path)
    )
    try:
        while query.isActive and (query.lastProgress is None or query.lastProgress["batchId"] + 1 < batches):
            query.awaitTermination(0.1)
    finally:
        query.stop()


def read_state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """The state a query has left in its checkpoint: a row (key, value) per key."""
    return spark.read.format("statestore").option("stateVarName", variable).load(checkpoint).select("key", "value")
