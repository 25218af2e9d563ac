"""JSON decode / flatten / encode (H9-H11) with fixed schemas, no per-message inference."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clean_name(name: str) -> str:
    """Every character outside [A-Za-z0-9_] becomes '_' ("Price (EUR/MWhe)" -> "Price__EUR_MWhe_")."""
    return re.sub(r"[^A-Za-z0-9_]", "_", name)


def clean_column_names(df: DataFrame) -> DataFrame:
    """H10 applied to a whole frame, as one projection."""
    return df.withColumnsRenamed({c: clean_name(c) for c in df.columns if clean_name(c) != c})


CORRUPT_FIELD = "_corrupt_record"


def decode_json(value: str | Column, schema: T.StructType, keep_corrupt: bool = False) -> Column:
    """H9, decode step: bytes or text -> struct with a fixed schema.

    Missing keys give NULL fields (PERMISSIVE mode). With ``keep_corrupt`` the
    struct gets a ``_corrupt_record`` field holding the text of a message that
    does not parse, so bad messages can be routed to a reject table.
    """
    v = F.col(value) if isinstance(value, str) else value
    if not keep_corrupt:
        return F.from_json(v.cast("string"), schema)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT_FIELD, T.StringType())])
    return F.from_json(v.cast("string"), full, {"columnNameOfCorruptRecord": CORRUPT_FIELD})


def _flatten_fields(prefix: str, col: Column, dtype: T.DataType, list_items: dict[str, int]) -> list[Column]:
    if isinstance(dtype, T.StructType):
        out: list[Column] = []
        for f in dtype.fields:
            name = f"{prefix}_{f.name}" if prefix else f.name
            out.extend(_flatten_fields(name, col.getField(f.name), f.dataType, list_items))
        return out
    if isinstance(dtype, T.ArrayType) and prefix in list_items and isinstance(dtype.elementType, T.StructType):
        # A list of objects stays a list, except that the first ``n`` elements can be
        # lifted to columns named ``<list>_<i>__<field>`` (the landing layout).
        out = [col.alias(prefix)]
        for i in range(list_items[prefix]):
            elem = F.get(col, i)
            for f in dtype.elementType.fields:
                out.append(elem.getField(f.name).alias(clean_name(f"{prefix}[{i}]_{f.name}")))
        return out
    return [col.alias(prefix)]


def flatten_struct(df: DataFrame, struct_col: str, list_items: dict[str, int] | None = None,
                   keep: list[str] | None = None) -> DataFrame:
    """H9, flatten step: nested fields ``a.b`` -> ``a_b``; lists stay unexpanded.

    ``list_items={'weather': 1}`` additionally lifts element 0 of ``weather`` to
    ``weather_0__id`` ... columns (NULL when the list is empty).
    """
    dtype = df.schema[struct_col].dataType
    assert isinstance(dtype, T.StructType), f"{struct_col} is not a struct"
    cols = [F.col(k) for k in (keep or [])]
    cols += _flatten_fields("", F.col(struct_col), dtype, list_items or {})
    return df.select(*cols)


def encode_json(*cols: str | Column) -> Column:
    """A row (or some columns of it) as one JSON text."""
    return F.to_json(F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols]))
