"""Serving views over the batch view and the predictions.

``as_of`` replaces "now": a view is the state of the tables at that instant, so
it is reproducible. The lookback filter is on the raw ``dt`` column, so it
reaches the Parquet scan as a pushed filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.constants import PREDICTION_LOOKBACK, VIEW_LOOKBACK
from tempora.functions.scalar import kelvin_to_celsius, two_decimals
from tempora.functions.timebuckets import epoch_seconds, floor_to_width, minus_interval, seconds_to_ts
from tempora.operators.joins import overlay


def _as_of(as_of: str | Column) -> Column:
    return F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of


def data_now(df: DataFrame, time_col: str = "dt") -> Column:
    """"Now" of a table: its newest ``time_col``, as a lazy scalar subquery (one value)."""
    return df.agg(F.max(time_col)).scalar()


def lookback_to_newest(df: DataFrame, interval: str, time_col: str = "dt") -> DataFrame:
    """B10 with "now" as the table's newest time: the bound is computed inside the subquery, so that it
    is one value when the scan starts and is pushed to it (``newest - interval`` outside isn't)."""
    bound = df.agg(minus_interval(F.max(time_col), interval).alias("bound")).scalar()
    return df.where(F.col(time_col) > bound)


def lookback(df: DataFrame, as_of: str | Column, interval: str, time_col: str = "dt") -> DataFrame:
    """Rows with ``as_of - interval < dt <= as_of`` (strict lower bound, as the original).

    ``as_of`` is a timestamp text or a Column (e.g. ``data_now``); the bounds are
    on the raw column, so they reach the scan as (runtime) pushed filters.
    """
    t = F.col(time_col)
    a = _as_of(as_of)
    return df.where((t > minus_interval(a, interval)) & (t <= a))


def bucket_lookback_on_raw(df: DataFrame, as_of: str | Column, interval: str, width_seconds: int,
                           ts_col: str = "ts") -> DataFrame:
    """B10 moved before bucketing: keep the raw rows whose bucket passes the lookback.

    A bucket start ``b`` satisfies ``L < b <= A`` (L = as_of - interval, A = as_of)
    exactly when its rows have ``floor(L/w)*w + w <= ts < floor(A/w)*w + w``, so
    filtering raw ``ts`` with these bounds keeps the same buckets, whole. Unlike a
    predicate on the computed bucket, this one reaches the Parquet reader.
    """
    a = _as_of(as_of)
    lo = seconds_to_ts(floor_to_width(epoch_seconds(minus_interval(a, interval)), width_seconds) + width_seconds)
    hi = seconds_to_ts(floor_to_width(epoch_seconds(a), width_seconds) + width_seconds)
    t = F.col(ts_col)
    return df.where((t >= lo) & (t < hi))


def rows_at_max(df: DataFrame, time_col: str = "dt") -> DataFrame:
    """Every row at the maximum ``time_col``; an equality with a scalar subquery, which reaches the scan."""
    return df.where(F.col(time_col) == data_now(df, time_col))


def latest_row(df: DataFrame, time_col: str = "dt", tiebreak: Sequence[str] = ()) -> DataFrame:
    """the single newest row (ties broken by ``tiebreak`` ascending); empty input gives no row.

    ``orderBy(...).limit(1)`` plans as TakeOrderedAndProject: each task keeps its
    own top row and only those reach the final merge.
    """
    return df.orderBy(F.col(time_col).desc(), *[F.col(c).asc_nulls_last() for c in tiebreak]).limit(1)


def current_prediction(predictions: DataFrame, as_of: str | Column, interval: str = PREDICTION_LOOKBACK,
                       key: Sequence[str] = ("id",)) -> DataFrame:
    """Newest prediction in the lookback, prediction rounded to 2 places."""
    recent = lookback(predictions, as_of, interval)
    cols = ["dt", *[k for k in key if k in predictions.columns]]
    return latest_row(recent, "dt", cols[1:]).select(*cols, two_decimals("prediction").alias("prediction"))


def current_batch_row(batch_view: DataFrame, as_of: str | Column, interval: str = VIEW_LOOKBACK,
                      kelvin_cols: Sequence[str] = ("avg_temp", "avg_feels_like_temp"),
                      value_cols: Sequence[str] | None = None) -> DataFrame:
    """Newest batch-view row in the lookback; temperatures in Celsius (H6); all values to 2 places."""
    recent = latest_row(lookback(batch_view, as_of, interval), "dt")
    value_cols = list(value_cols) if value_cols is not None else [c for c in batch_view.columns if c != "dt"]
    return recent.select(
        "dt",
        *[two_decimals(kelvin_to_celsius(c) if c in kelvin_cols else F.col(c)).alias(c) for c in value_cols],
    )


def predicted_vs_actual(predictions: DataFrame, batch_view: DataFrame, as_of: str | Column,
                        interval: str = VIEW_LOOKBACK, prediction_col: str = "prediction",
                        actual_col: str = "avg_price") -> DataFrame:
    """Both price series in the lookback on one time axis, sorted by time (F2)."""
    pred = lookback(predictions, as_of, interval).select("dt", F.col(prediction_col).alias("price"))
    real = lookback(batch_view, as_of, interval).select("dt", F.col(actual_col).alias("price"))
    return overlay({"predicted": pred, "real": real}, "dt", "price").orderBy("dt", "series")
