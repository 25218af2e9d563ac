"""Joins (C1-C3) and the forecast-error join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.session import ensure_checkpoint_dir


def bucket_join(left: DataFrame, right: DataFrame, left_key: str = "dt", right_key: str | None = None,
                how: str = "inner") -> DataFrame:
    """Equi-join two per-bucket tables on the bucket; the right key is dropped.

    Both sides are aggregates with one row per bucket, so their size is bounded
    by the time range, not by the raw data. No hint is forced: the planner
    broadcasts a side only when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time), and
    otherwise joins the two hash-partitioned aggregates without a new shuffle.
    NULL keys never match.
    """
    right_key = right_key or left_key
    if right_key != left_key:
        right = right.withColumnRenamed(right_key, left_key)
    return left.join(right, on=left_key, how=how)


def join_all(frames: Sequence[DataFrame], key: str = "dt", how: str = "inner") -> DataFrame:
    """Chain of 1:1 joins on the same key."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, on=key, how=how)
    return out


def overlay(series: dict[str, DataFrame], time_col: str = "dt", value_col: str = "value") -> DataFrame:
    """Several (time, value) series on one axis, tagged by a ``series`` column.

    The two series are plotted together, not joined, so a union keeps every
    point of each (no row is lost where the other series has no point).
    """
    parts = [
        df.select(F.lit(name).alias("series"), F.col(time_col).alias(time_col), F.col(value_col).alias(value_col))
        for name, df in series.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def forecast_error(predictions: DataFrame, actual: DataFrame, key: str = "dt",
                   predicted_col: str = "prediction", actual_col: str = "avg_price") -> DataFrame:
    """X3 (extension): per-key error, then RMSE / MAE over all matched keys."""
    matched = predictions.join(actual, on=key, how="inner")
    err = F.col(predicted_col) - F.col(actual_col)
    return matched.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
    )


BROADCAST_ROWS = 100_000  # of a small table with a few columns: some MB


def sized_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``small``, computed once into the shared checkpoint folder; to be broadcast if it has ``max_rows`` rows or fewer.

    The planner measures an aggregate by its buffers, not by its rows, and often by too much: the
    large side is then shuffled on its hot key. A larger table is left to the planner.
    """
    ensure_checkpoint_dir(small.sparkSession)
    kept = small.checkpoint(eager=True)
    return F.broadcast(kept) if kept.count() <= max_rows else kept
