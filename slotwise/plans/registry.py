"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.timeslice import event_micros
from slotwise.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`; `sql` is left out where SQL cannot express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query [{name}] is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def us(ts: Column) -> Column:
    return event_micros(ts)


def cents(value: Column | str) -> Column:
    """Exact two-decimal arithmetic: sums do not depend on the order of the rows."""
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(18,2)")
