"""Schemas written as `name type` pairs, usable before a session exists."""

from __future__ import annotations

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "array<bigint>": T.ArrayType(T.LongType()),
}


def struct(**fields: str) -> T.StructType:
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields.items()])
