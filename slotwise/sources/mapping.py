"""Declared mappings (nested field types) as Spark schemas."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared type -> column type. There is no 16-bit float in Spark.
LEAF_TYPES = {
    "long": T.LongType(),
    "integer": T.IntegerType(),
    "short": T.ShortType(),
    "byte": T.ByteType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "half_float": T.FloatType(),
    "boolean": T.BooleanType(),
    "keyword": T.StringType(),
    "text": T.StringType(),
    "date": T.TimestampType(),
}


# Named date formats. Any other is a pattern of Spark's.
ISO_DATES = ("date", "date_time", "date_optional_time", "strict_date", "strict_date_time", "strict_date_optional_time")
DEFAULT_DATES = "strict_date_optional_time||epoch_millis"
WHOLE = ("long", "integer", "short", "byte")


def mapping_to_struct(mapping: str | dict) -> T.StructType:
    """A mapping's `properties` as a StructType.

    `nested` becomes an array of structs, an object without properties stays raw JSON text
    (its content is not mapped), and one wrapping level (`{"doc": {"properties": …}}`) is
    looked through.
    """
    return _struct(_properties(mapping))


def _properties(mapping: str | dict) -> dict:
    node = json.loads(mapping) if isinstance(mapping, str) else mapping
    if "mappings" in node:
        node = node["mappings"]
    if "properties" not in node:
        inner = [v for v in node.values() if isinstance(v, dict) and "properties" in v]
        if len(inner) != 1:
            raise ValueError("mapping has no properties")
        node = inner[0]
    return node["properties"]


def _struct(properties: dict) -> T.StructType:
    return T.StructType(
        [T.StructField(name, _field_type(spec)) for name, spec in properties.items()]
    )


def _field_type(spec: dict) -> T.DataType:
    kind = spec.get("type", "object")
    if kind in LEAF_TYPES:
        return LEAF_TYPES[kind]
    if kind not in ("object", "nested"):
        raise ValueError(f"unsupported mapping type [{kind}]")
    if not spec.get("properties"):
        return T.StringType()
    struct = _struct(spec["properties"])
    return T.ArrayType(struct) if kind == "nested" else struct


def _text_struct(properties: dict) -> T.StructType:
    """The shape of a document with every value still as text."""
    return T.StructType([T.StructField(name, _text_type(spec)) for name, spec in properties.items()])


def _text_type(spec: dict) -> T.DataType:
    if spec.get("type", "object") == "object" and spec.get("properties"):
        return _text_struct(spec["properties"])
    return T.StringType()


def _objects(text: Column, spec: dict) -> Column:
    """The objects of a nested field; a single object counts as a list of one."""
    many = F.when(F.ltrim(text).startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    return F.from_json(many, T.ArrayType(_text_struct(spec["properties"])))


def _date(text: Column, formats: str) -> Column:
    """The first of the formats that fits; numbers are read as their digits."""
    forms = []
    for form in formats.split("||"):
        if form in ISO_DATES:
            forms.append(F.when(text.rlike(r"^\d{4}(-|$)"), text.try_cast("timestamp")))
        elif form == "epoch_millis":
            forms.append(F.when(text.rlike(r"^-?\d{1,15}$"), F.timestamp_millis(text.try_cast("bigint"))))
        elif form == "epoch_second":
            forms.append(F.when(text.rlike(r"^-?\d{1,12}$"), F.timestamp_seconds(text.try_cast("bigint"))))
        else:
            forms.append(F.try_to_timestamp(text, F.lit(form)))
    return F.coalesce(*forms)


def _value(text: Column, spec: dict) -> Column:
    """A value of the declared type, null where the text does not fit. Quoted numbers count as
    numbers, and fractions of whole ones are cut off."""
    kind = spec.get("type", "object")
    if kind == "date":
        return _date(text, spec.get("format", DEFAULT_DATES))
    if kind in WHOLE:
        return text.try_cast("decimal(38,6)").try_cast(LEAF_TYPES[kind])
    if kind == "boolean":
        return F.when(text == "true", True).when(text.isin("false", ""), False)
    if kind in LEAF_TYPES:
        return text.try_cast(LEAF_TYPES[kind])
    if not spec.get("properties"):
        return text
    if kind == "nested":
        return F.transform(_objects(text, spec), lambda one: _values(one, spec["properties"]))
    return F.when(text.isNotNull(), _values(text, spec["properties"]))


def _values(node: Column, properties: dict) -> Column:
    return F.struct(*[_value(node[name], spec).alias(name) for name, spec in properties.items()])


def _fits(text: Column, spec: dict) -> Column:
    """Whether a value is absent or has its declared type throughout."""
    if spec.get("type", "object") in LEAF_TYPES or not spec.get("properties"):
        return text.isNull() | _value(text, spec).isNotNull()

    def all_fit(node: Column) -> Column:
        return F.forall(F.array(*[_fits(node[n], s) for n, s in spec["properties"].items()]), lambda fit: fit)

    if spec.get("type") == "nested":
        objects = _objects(text, spec)
        return text.isNull() | F.coalesce(F.forall(objects, lambda one: one.isNull() | all_fit(one)), F.lit(False))
    return text.isNull() | all_fit(text)


def read_with_mapping(df: DataFrame, mapping: str | dict, doc: str = "doc") -> DataFrame:
    """Replace the JSON column `doc` by the mapped top-level fields; others are ignored. Values
    that do not fit are null; `unfit` names their fields."""
    properties = _properties(mapping)
    _struct(properties)
    rest = [c for c in df.columns if c != doc]
    parsed = df.withColumn("_doc", F.from_json(F.col(doc), _text_struct(properties)))
    return parsed.select(*rest, *[_value(F.col("_doc")[name], spec).alias(name) for name, spec in properties.items()])


def unfit(df: DataFrame, mapping: str | dict, doc: str = "doc") -> DataFrame:
    """The rows with values that do not fit their declared types, with `fields`, the names of
    the top-level fields concerned."""
    properties = _properties(mapping)
    parsed = df.withColumn("_doc", F.from_json(F.col(doc), _text_struct(properties)))
    wrong = [F.when(~_fits(F.col("_doc")[name], spec), F.lit(name)) for name, spec in properties.items()]
    return parsed.withColumn("fields", F.array_compact(F.array(*wrong))).filter(F.size("fields") > 0).drop("_doc")
