"""What several operators share: Arrow batches of a bounded size, row keys, shared scratch tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.session import stored

__all__ = ["NO_ID", "arrays", "batches", "binary", "id_key", "packed_rows", "rest_of", "stored"]

#: Stands for a doc_id of null, which sorts before all others.
NO_ID = -(1 << 63)


def batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows of the Arrow batches handed to Python, whole texts being wide."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def id_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def rest_of(df: DataFrame, *left_out: str) -> Column:
    """All columns but some, packed into one so that no name can clash with a working column."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in left_out])


def binary(parts: list[np.ndarray]) -> bytes:
    """Arrays behind each other, with their lengths in front."""
    head = np.array([len(parts), *(len(p) for p in parts)], np.int64)
    return b"".join([head.tobytes(), *(np.ascontiguousarray(p).tobytes() for p in parts)])


def arrays(body: bytes, kinds: list[type]) -> list[np.ndarray]:
    """What `binary` packed."""
    sizes = np.frombuffer(body, np.int64, len(kinds), 8)
    at, out = 8 * (len(kinds) + 1), []
    for kind, n in zip(kinds, sizes, strict=True):
        out.append(np.frombuffer(body, kind, n, at))
        at += out[-1].nbytes
    return out


def packed_rows(names: list[str], columns: list, types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
