"""Flattening messages whose keys nobody has listed (H9, H10 without a fixed schema).

Messages are parsed to VARIANT; one aggregate merges the schemas of all of a batch's messages, and only that
schema, as large as the set of keys, reaches the driver. Every key found becomes a column.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.functions.jsonops import clean_name

MALFORMED = "_malformed"


def _object(value_col: str) -> Column:
    """The message as VARIANT if it is a JSON object, else NULL."""
    text = F.col(value_col).cast("string")
    return F.when(F.ltrim(text).startswith("{"), F.try_parse_json(text))


def _settled(t: T.DataType) -> T.DataType:
    """The column type for a merged one: numbers with a fraction are doubles, what is always null or has no common type is text."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _settled(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_settled(t.elementType))
    if isinstance(t, T.DecimalType):
        return T.LongType() if t.scale == 0 and t.precision <= 18 else T.DoubleType()
    return T.StringType() if isinstance(t, (T.NullType, T.VariantType)) else t


def message_schema(messages: DataFrame, value_col: str = "value") -> T.StructType:
    """The merged schema of all messages that are JSON objects: every key that any of them has, in the order of names.

    A key with numbers of several kinds gets the wider one; with values that share no type it is text.
    """
    found = messages.agg(F.schema_of_variant_agg(_object(value_col)).alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    ddl = re.sub(r"`(?:[^`]|``)*`|OBJECT<", lambda m: "STRUCT<" if m.group() == "OBJECT<" else m.group(), found)
    return _settled(T._parse_datatype_string(ddl))


def _value(keys: list[str], kind: str) -> Column:
    """What stands under the keys, as ``kind``; a path can't quote a key with both kinds of quotes, so that goes through a map."""
    at, path = F.col("__v"), "$"
    for k in keys:
        quote = next((q for q in "'\"" if q not in k), None) if k.isprintable() and k else None
        if quote is None:
            at, path = F.try_variant_get(at, F.lit(path), "map<string,variant>")[k], "$"
        else:
            path += f"[{quote}{k}{quote}]"
    return F.try_variant_get(at, F.lit(path), kind)


def _leaves(t: T.StructType, keys: list[str]):
    for f in t.fields:
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            yield from _leaves(f.dataType, [*keys, f.name])
        else:
            yield [*keys, f.name], f.dataType


def flatten_any(messages: DataFrame, value_col: str = "value", keep: list[str] | None = None,
                schema: T.StructType | None = None) -> DataFrame:
    """H9 + H10 for any keys: a column for each leaf of the objects, ``a.b`` as ``a_b``, names cleaned; lists stay lists.

    ``schema`` defaults to ``message_schema`` of these messages (one more pass over them). A message lacks a key: NULL. A
    value that doesn't fit its column's type: NULL for a given schema; for the merged one it always fits, as text if need be. Names that are
    equal once cleaned get _2, _3, ... in the order of their paths. What is no JSON object gives NULLs and
    ``_malformed`` = true. ``keep`` names columns to carry along.
    """
    schema = schema if schema is not None else message_schema(messages, value_col)
    parsed = messages.select(*(keep or []), _object(value_col).alias("__v"))
    columns, names = [], {k.lower() for k in [*(keep or []), MALFORMED]}
    for keys, t in _leaves(schema, []):
        base = name = clean_name("_".join(keys))
        n = 1
        while name.lower() in names:
            n += 1
            name = f"{base}_{n}"
        names.add(name.lower())
        kind = "string" if isinstance(t, T.StructType) else t.simpleString()  # an object that is always empty: as text
        columns.append(_value(keys, kind).alias(name))
    return parsed.select(*(keep or []), F.col("__v").isNull().alias(MALFORMED), *columns)
