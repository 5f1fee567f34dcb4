"""Routing rows to named message destinations, and sinks for inspection."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


class RoutedRows(NamedTuple):
    good: DataFrame
    bad: DataFrame


def route_sink(df: DataFrame, app: str, value: Column, routes: dict[str, tuple[list[str], str]]) -> RoutedRows:
    """Rows as (brokers, topic, key, value) by their app's route; the key is always null.

    `routes` maps an app name to (brokers, topic). It is configuration held in the program,
    so it becomes a map literal rather than a join. Rows of an unknown app go to `bad`.
    """
    pairs: list[Column] = []
    for name, (brokers, topic) in routes.items():
        target = F.struct(
            F.lit(",".join(brokers)).alias("brokers"), F.lit(topic).alias("topic")
        )
        pairs += [F.lit(name), target]
    staged = df.withColumn("_route", F.try_element_at(F.create_map(*pairs), F.col(app)))
    good = staged.filter(F.col("_route").isNotNull()).select(
        F.col("_route.brokers").alias("brokers"),
        F.col("_route.topic").alias("topic"),
        F.lit(None).cast("string").alias("key"),
        value.cast("string").alias("value"),
    )
    return RoutedRows(good, staged.filter(F.col("_route").isNull()).drop("_route"))


def kafka_options(brokers: list[str], topic: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": ",".join(brokers), "topic": topic, **extra}


def write_topics(good: DataFrame, path: str, mode: str = "append") -> None:
    """File form of the sink: one directory per topic."""
    good.write.partitionBy("topic").mode(mode).parquet(path)


def print_sink(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Print a stream for inspection, a row a line as JSON text. Every task prints its own rows
    to files below `path`; none pass through the driver."""
    lines = df.select(F.to_json(F.struct("*")).alias("value"))
    writer = lines.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
