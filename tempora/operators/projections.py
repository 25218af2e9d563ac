"""Projections and filters (B1-B14). Plain DataFrame calls; listed to name the semantics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.constants import TRAINING_RENAMES


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """B1: add or replace several computed columns in one projection."""
    return df.withColumns(dict(exprs))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """B2: drop by name; names that are not present are ignored."""
    return df.drop(*names)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename in one projection; names that are not present are ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def to_training_names(df: DataFrame) -> DataFrame:
    """Batch-view names -> message feature names (and avg_price -> price)."""
    return rename_columns(df, TRAINING_RENAMES)


def select_aliased(df: DataFrame, aliases: Mapping[str, str], order_by: str | None = None) -> DataFrame:
    """B5 (+F1): select source -> alias (aliases may contain spaces), optionally sorted by a source column."""
    out = df.select(*[F.col(src).alias(dst) for src, dst in aliases.items()], *(
        [F.col(order_by).alias("__order")] if order_by and order_by not in aliases else []))
    if order_by:
        key = "__order" if order_by not in aliases else aliases[order_by]
        out = out.orderBy(F.col(f"`{key}`"))
        if key == "__order":
            out = out.drop("__order")
    return out


def select_columns(df: DataFrame, *names: str) -> DataFrame:
    """Keep the named columns."""
    return df.select(*names)


def where_equals(df: DataFrame, column: str, value, required: bool = False) -> DataFrame:
    """Rows where ``column == value``.

    ``required=True`` reproduces the city-list variant, which fails when nothing
    matches (checked with ``isEmpty``: one row is fetched, not the whole result).
    """
    out = df.where(F.col(column) == F.lit(value))
    if required and out.isEmpty():
        raise ValueError(f"no row with {column} == {value!r}")
    return out


def split_by(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). A NULL predicate counts as rejected, so no row is lost."""
    accepted = df.where(predicate)
    rejected = df.where(~F.coalesce(predicate, F.lit(False)))
    return accepted, rejected


def tag_split(df: DataFrame, predicate: Column, name: str = "outcome") -> DataFrame:
    """B12 as one pass: the same split as a label column ('accepted' / 'rejected')."""
    return df.withColumn(name, F.when(F.coalesce(predicate, F.lit(False)), "accepted").otherwise("rejected"))


def status_ok(status_col: str = "cod", ok: int = 200) -> Column:
    """B12 predicate of the weather source: ``cod = 200`` (NULL is not OK)."""
    return F.col(status_col).eqNullSafe(F.lit(ok))
