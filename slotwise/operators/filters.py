"""Document predicates and the choice of fields."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions.text import query_tokens, tokens

RANGE = {
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
}


def match_any(field: Column, text: str) -> Column:
    """True where the field shares a token with `text`."""
    wanted = query_tokens(text)
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(tokens(field), F.array(*map(F.lit, wanted))), F.lit(False))


def query_filter(spec: dict[str, Any]) -> Column:
    """A nested query spec as one never-null Column.

    Kinds: match_all, match, term, terms, range, exists, and bool with filter / must /
    must_not (lists or single specs).
    """
    if len(spec) != 1:
        raise ValueError(f"a query spec has one kind, not {sorted(spec)}")
    ((kind, body),) = spec.items()
    if kind == "match_all":
        return F.lit(True)
    if kind == "bool":
        unknown = set(body) - {"filter", "must", "must_not"}
        if unknown:
            raise ValueError(f"unknown bool clauses {sorted(unknown)}")
        parts = [query_filter(s) for s in _listed(body.get("filter"))]
        parts += [query_filter(s) for s in _listed(body.get("must"))]
        parts += [~query_filter(s) for s in _listed(body.get("must_not"))]
        return reduce(lambda a, b: a & b, parts, F.lit(True)) if parts else F.lit(True)
    if kind == "exists":
        return F.col(body["field"]).isNotNull()
    ((field, value),) = body.items()
    column = F.col(field)
    if kind == "match":
        return match_any(column, value)
    if kind == "term":
        hit = column == value
    elif kind == "terms":
        hit = column.isin(list(value))
    elif kind == "range":
        hit = reduce(lambda a, b: a & b, [RANGE[op](column, v) for op, v in value.items()])
    else:
        raise ValueError(f"unknown query kind [{kind}]")
    return column.isNotNull() & hit


def _listed(value: Any) -> list:
    if value is None:
        return []
    return list(value) if isinstance(value, (list, tuple)) else [value]


def post_filter(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(frame for hits, frame for aggregations): only hits are filtered."""
    return df.filter(predicate), df


def min_score(df: DataFrame, least: float, score: str = "_score") -> DataFrame:
    return df.filter(F.col(score) >= least)


def source_fields(
    df: DataFrame,
    includes: Sequence[str] = (),
    excludes: Sequence[str] = (),
    enabled: bool = True,
    always: Sequence[str] = (),
) -> DataFrame:
    """Keep fields by path patterns (`a.*`, `*_id`); `always` columns stay in any case.

    A pattern naming a struct covers its fields. With `enabled=False` only `always` is left.
    The result is a plain projection, so unused columns are not read.
    """

    def wanted(path: str) -> bool:
        inside = not includes or any(_covers(p, path) for p in includes)
        return inside and not any(_covers(p, path) for p in excludes)

    columns = []
    for field in df.schema.fields:
        name = field.name
        if name in always:
            columns.append(F.col(name))
        elif enabled:
            column = _project(F.col(name), field.dataType, name, wanted)
            if column is not None:
                columns.append(column.alias(name))
    return df.select(*columns)


def _covers(pattern: str, path: str) -> bool:
    parts = path.split(".")
    return any(fnmatch.fnmatchcase(".".join(parts[:n]), pattern) for n in range(1, len(parts) + 1))


def _project(column: Column, dtype: T.DataType, path: str, wanted) -> Column | None:
    if not isinstance(dtype, T.StructType):
        return column if wanted(path) else None
    kept = []
    for field in dtype.fields:
        inner = _project(column[field.name], field.dataType, f"{path}.{field.name}", wanted)
        if inner is not None:
            kept.append(inner.alias(field.name))
    return F.when(column.isNotNull(), F.struct(*kept)) if kept else None


def doc_value_fields(df: DataFrame, fields: Iterable[tuple[str, str | None]], keep: Sequence[str] = ()) -> DataFrame:
    """Named fields, each with an optional date format."""
    columns = [F.col(k) for k in keep]
    for name, fmt in fields:
        column = F.col(name)
        columns.append((F.date_format(column, fmt) if fmt else column).alias(name.split(".")[-1]))
    return df.select(*columns)


def script_fields(df: DataFrame, scripts: dict[str, str]) -> DataFrame:
    """Computed columns from SQL expressions."""
    return df.withColumns({name: F.expr(text) for name, text in scripts.items()})


# ---------------------------------------------------------------------------------------
# Node statistics

# The metric groups of a statistics row.
METRICS = (
    "os", "jvm", "thread_pool", "fs", "transport", "http", "indices", "process", "breaker",
    "script", "discovery", "ingest", "adaptive_selection",
)


def parse_attr_spec(spec: str | None) -> dict[str, list[str]] | None:
    """`k|v1|v2,k2|v3` -> {k: [v1, v2], k2: [v3]}; None for no spec."""
    if not spec:
        return None
    out: dict[str, list[str]] = {}
    for part in spec.split(","):
        name, *values = part.split("|")
        out[name] = [v for v in values]
    return out


def attr_filter(df: DataFrame, spec: str | dict[str, list[str]] | None, attrs: str = "attrs") -> DataFrame:
    """Rows whose map has every listed key with one of its values.

    No spec: all rows. Keys without values do not count; if none is left, no row passes.
    """
    wanted = parse_attr_spec(spec) if spec is None or isinstance(spec, str) else spec
    if not wanted:
        return df
    usable = {k: v for k, v in wanted.items() if v}
    if not usable:
        return df.filter(F.lit(False))
    tests = [F.try_element_at(F.col(attrs), F.lit(k)).isin(v) for k, v in usable.items()]
    return df.filter(reduce(lambda a, b: a & b, tests))


def metric_select(
    df: DataFrame,
    metrics: Iterable[str] | str = "_all",
    index_metrics: Iterable[str] | None = None,
    keys: Sequence[str] = ("node_id",),
) -> DataFrame:
    """The chosen metric groups; within `indices`, the chosen sub-metrics."""
    chosen = _names(metrics)
    if chosen == {"_all"}:
        if index_metrics is not None:
            raise ValueError("index metrics given but all stats requested")
        return df.select(*keys, *[m for m in METRICS if m in df.columns])
    if "_all" in chosen:
        raise ValueError(f"_all and individual metrics [{','.join(sorted(chosen))}]")
    unknown = sorted(chosen - set(METRICS))
    if unknown:
        raise ValueError(f"unrecognized metrics: {unknown}")
    if "indices" not in chosen and index_metrics is not None:
        raise ValueError("index metrics given but indices stats not requested")
    columns = [F.col(k) for k in keys]
    for name in METRICS:
        if name not in chosen:
            continue
        parts = _names(index_metrics) if name == "indices" and index_metrics is not None else {"_all"}
        if parts == {"_all"}:
            columns.append(F.col(name))
            continue
        known = [f.name for f in df.schema[name].dataType.fields]
        unknown = sorted(parts - set(known))
        if unknown:
            raise ValueError(f"unrecognized index metrics: {unknown}")
        columns.append(F.struct(*[F.col(name)[k].alias(k) for k in known if k in parts]).alias(name))
    return df.select(*columns)


def _names(value: Iterable[str] | str) -> set[str]:
    items = value.split(",") if isinstance(value, str) else list(value)
    return {i.strip() for i in items if i.strip()}
