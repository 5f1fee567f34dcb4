"""Inserting, updating and deleting rows of entity tables (id, `valid` flag, fields)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.text import snake_case
from slotwise.operators.predicates import Condition, example_column


def _row_frame(table: DataFrame, values: dict[str, Any]) -> DataFrame:
    names = {snake_case(k): v for k, v in values.items()}
    unknown = sorted(set(names) - set(table.columns))
    if unknown:
        raise ValueError(f"no such fields {unknown}")
    one = table.sparkSession.range(1)
    return one.select(
        *[F.lit(names.get(f.name)).cast(f.dataType).alias(f.name) for f in table.schema.fields]
    )


def insert_one(table: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Add a row with all its fields, nulls included."""
    return table.unionByName(_row_frame(table, values))


def insert_selective(table: DataFrame, values: dict[str, Any], defaults: dict[str, Any] | None = None) -> DataFrame:
    """Add a row of the non-null fields; the others take the table's defaults."""
    given = {snake_case(k): v for k, v in values.items() if v is not None}
    return insert_one(table, {**(defaults or {}), **given})


def insert_list(table: DataFrame, rows: DataFrame, defaults: dict[str, Any] | None = None) -> DataFrame:
    """Add many rows, each with its own set of non-null fields."""
    unknown = sorted(set(rows.columns) - set(table.columns))
    if unknown:
        raise ValueError(f"no such fields {unknown}")
    filled = rows
    for name, value in (defaults or {}).items():
        own = [F.col(name)] if name in rows.columns else []
        filled = filled.withColumn(name, F.coalesce(*own, F.lit(value)))
    return table.unionByName(filled, allowMissingColumns=True)


def _assign(table: DataFrame, hit: Column, values: dict[str, Any], id_col: str, nulls: bool) -> DataFrame:
    new = {snake_case(k): v for k, v in values.items() if snake_case(k) != id_col}
    if not nulls:
        new = {k: v for k, v in new.items() if v is not None}
    if not new:
        raise ValueError("nothing to update")
    match = F.coalesce(hit, F.lit(False))
    types = {f.name: f.dataType for f in table.schema.fields}
    return table.withColumns(
        {k: F.when(match, F.lit(v).cast(types[k])).otherwise(F.col(k)) for k, v in new.items()}
    )


def update_selective(
    table: DataFrame,
    new: dict[str, Any],
    example: dict[str, Any],
    conditions: Iterable[Condition] = (),
    id_col: str = "id",
) -> DataFrame:
    """Set the non-null fields of `new` where the example matches."""
    hit = example_column(table, example, conditions)
    if hit is None:
        raise ValueError("example and conditions give no predicate")
    return _assign(table, hit, new, id_col, nulls=False)


def _live(row_id: Any, id_col: str) -> Column:
    return (F.col(id_col) == row_id) & (F.col("valid") == 1)


def update_selective_by_id(table: DataFrame, new: dict[str, Any], row_id: Any, id_col: str = "id") -> DataFrame:
    return _assign(table, _live(row_id, id_col), new, id_col, nulls=False)


def update_by_id(table: DataFrame, new: dict[str, Any], row_id: Any, id_col: str = "id") -> DataFrame:
    """Like `update_selective_by_id`, and null fields are written as null."""
    return _assign(table, _live(row_id, id_col), new, id_col, nulls=True)


def delete_by_example(
    table: DataFrame, example: dict[str, Any], declared: Sequence[str], conditions: Iterable[Condition] = ()
) -> DataFrame:
    """Drop the rows like the example; only the entity's own declared fields count."""
    own = {k: v for k, v in example.items() if k in declared}
    hit = example_column(table, own, conditions)
    if hit is None:
        raise ValueError("example gives no predicate")
    return table.filter(~F.coalesce(hit, F.lit(False)))


def delete_by_id(table: DataFrame, row_id: Any, id_col: str = "id") -> DataFrame:
    return table.filter(~F.col(id_col).eqNullSafe(F.lit(row_id)))


def delete_by_id_logically(table: DataFrame, row_id: Any, id_col: str = "id") -> DataFrame:
    """Set `valid` to 0, whatever it was."""
    kind = table.schema["valid"].dataType
    gone = F.col(id_col).eqNullSafe(F.lit(row_id))
    return table.withColumn("valid", F.when(gone, F.lit(0).cast(kind)).otherwise(F.col("valid")))
