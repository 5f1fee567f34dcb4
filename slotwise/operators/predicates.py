"""Query-by-example table access: conditions, examples, rows by id."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from numbers import Number
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.text import snake_case

Condition = tuple[str, str, Any]

COMPARE = {
    "EQ": lambda c, v: c == v,
    "NE": lambda c, v: c != v,
    "GT": lambda c, v: c > v,
    "LT": lambda c, v: c < v,
    "GE": lambda c, v: c >= v,
    "LE": lambda c, v: c <= v,
    "LIKE": lambda c, v: c.like(str(v)),
}
SORTS = ("SORT_ASC", "SORT_DESC")


def _is_plain(value: Any) -> bool:
    return isinstance(value, (str, Number)) and not isinstance(value, bool)


def _condition(df: DataFrame, kind: str, field: str, value: Any) -> Column | None:
    name = snake_case(field)
    if kind in SORTS:
        return None
    if kind == "IN":
        if value is None or isinstance(value, str) or not isinstance(value, Iterable):
            return None
        wanted = [v for v in value if v is not None] or [""]
        # literals take the column's type, so the list still reaches the scan
        dtype = df.schema[name].dataType
        return F.col(name).isin([F.lit(v).try_cast(dtype) for v in wanted])
    if kind not in COMPARE:
        raise ValueError(f"unknown condition type [{kind}]")
    return COMPARE[kind](F.col(name), value) if _is_plain(value) else None


def conditions_column(df: DataFrame, conditions: Iterable[Condition]) -> Column | None:
    """AND of the usable conditions; None if there is none.

    Null values and values that are neither text nor number are skipped; IN drops nulls
    and with nothing left matches only the empty string.
    """
    parts = [p for c in conditions if (p := _condition(df, *c)) is not None]
    return reduce(lambda a, b: a & b, parts) if parts else None


def where_conditions(df: DataFrame, conditions: Iterable[Condition]) -> DataFrame:
    predicate = conditions_column(df, conditions)
    return df if predicate is None else df.filter(predicate)


def sort_columns(conditions: Iterable[Condition]) -> list[Column]:
    return [
        F.col(snake_case(field)).asc() if kind == "SORT_ASC" else F.col(snake_case(field)).desc()
        for kind, field, _ in conditions
        if kind in SORTS
    ]


def order_by_conditions(df: DataFrame, conditions: Iterable[Condition]) -> DataFrame:
    columns = sort_columns(conditions)
    return df.orderBy(*columns) if columns else df


def example_column(df: DataFrame, example: dict[str, Any], conditions: Iterable[Condition] = ()) -> Column | None:
    """Equality on the example's non-null fields AND the conditions."""
    parts = [F.col(snake_case(k)) == v for k, v in example.items() if v is not None]
    extra = conditions_column(df, conditions)
    if extra is not None:
        parts.append(extra)
    return reduce(lambda a, b: a & b, parts) if parts else None


def by_example(
    df: DataFrame,
    example: dict[str, Any],
    conditions: Iterable[Condition] = (),
    allow_empty: bool = False,
) -> DataFrame:
    """Rows like the example. Without any predicate this is an error, or with
    `allow_empty` the unsorted table: sort conditions then do not apply."""
    conditions = list(conditions)
    predicate = example_column(df, example, conditions)
    if predicate is None:
        if not allow_empty:
            raise ValueError("example and conditions give no predicate")
        return df
    return order_by_conditions(df.filter(predicate), conditions)


def select_by_id(df: DataFrame, row_id: Any, id_col: str = "id") -> DataFrame:
    """Row by id, whatever its `valid` flag."""
    return df.filter(F.col(id_col) == row_id)
