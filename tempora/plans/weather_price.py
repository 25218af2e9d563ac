"""L1 / L3: per-bucket weather averages joined to per-bucket prices.

The default column names are those of the flattened weather readings (F1) and
the price drops (F2); every name is a parameter so other inputs can be used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.constants import (
    BUCKET_SECONDS,
    PRICE_DROPPED,
    PRICE_TIME_COLUMN,
    PRICE_VALUE_COLUMN,
    WEATHER_AVERAGES,
    WEATHER_DROPPED,
)
from tempora.functions.timebuckets import ACCEPTED_TIME_FORMATS, bucket_start, epoch_seconds, parse_time_epoch
from tempora.operators.aggregates import distinct_rows, exact_avg, group_averages
from tempora.operators.joins import bucket_join


def bucketed_readings(readings: DataFrame, time_col: str = "dt", width_seconds: int = BUCKET_SECONDS,
                      dedup: bool = True, dedup_subset: Sequence[str] | None = None) -> DataFrame:
    """H1 then D5: replace the epoch ``time_col`` by its bucket start, then drop exact copies.

    The distinct runs after bucketing and before any column is dropped (Q2).
    It shuffles every column; ``dedup_subset`` narrows it when the caller knows
    which columns identify a reading.
    """
    out = readings.withColumn(time_col, bucket_start(time_col, width_seconds))
    return distinct_rows(out, dedup_subset) if dedup else out


def weather_bucket_averages(readings: DataFrame, time_col: str = "dt", width_seconds: int = BUCKET_SECONDS,
                            averages: Mapping[str, str | Column] = WEATHER_AVERAGES,
                            drop: Sequence[str] = WEATHER_DROPPED, dedup: bool = True,
                            dedup_subset: Sequence[str] | None = None,
                            exact_scales: Mapping[str, int] | None = None) -> DataFrame:
    """The weather half of L1: bucket -> distinct -> drop -> average per bucket.

    ``exact_scales`` (alias -> decimals) averages those measures exactly, so a
    refresh gives bit-identical values however the input is partitioned.
    """
    b = bucketed_readings(readings, time_col, width_seconds, dedup, dedup_subset).drop(*drop)
    return group_averages(b, time_col, averages, exact_scales=exact_scales)


def price_bucket_averages(prices: DataFrame, time_col: str = PRICE_TIME_COLUMN,
                          value_col: str = PRICE_VALUE_COLUMN, width_seconds: int = BUCKET_SECONDS,
                          shift_seconds: int = 0, time_kind: str = "text",
                          drop: Sequence[str] = PRICE_DROPPED, out_key: str = "dt_prices",
                          out_value: str = "avg_price", exact_scale: int | None = None) -> DataFrame:
    """The price half of L1: parse (H2) -> shift (H3) -> bucket (H1) -> average (D3).

    ``time_kind`` says what ``time_col`` holds: 'text' (yyyy-MM-dd HH:mm:ss),
    'timestamp', or 'epoch' seconds. ``exact_scale`` (decimals of the price)
    averages the price exactly instead of by floating summation.

    Time texts are parsed by any of the listed layouts (``ACCEPTED_TIME_FORMATS``); rows that
    none fits are in ``price_time_rejects`` and in no bucket.
    """
    if time_kind == "text":
        epoch = parse_time_epoch(time_col, ACCEPTED_TIME_FORMATS)
        prices = prices.where(epoch.isNotNull())
    elif time_kind == "timestamp":
        epoch = epoch_seconds(time_col)
    elif time_kind == "epoch":
        epoch = F.col(time_col)
    else:
        raise ValueError(f"time_kind must be text, timestamp or epoch, not {time_kind!r}")
    p = (
        prices.withColumn(out_key, bucket_start(epoch, width_seconds, shift_seconds))
        .drop(*[c for c in drop if c != out_key])
        .withColumnRenamed(value_col, "price")
    )
    avg = exact_avg("price", exact_scale) if exact_scale is not None else F.avg("price")
    return p.groupBy(out_key).agg(avg.alias(out_value))


def price_time_rejects(prices: DataFrame, time_col: str = PRICE_TIME_COLUMN) -> DataFrame:
    """The rows whose time text fits no listed layout (or is NULL): what ``price_bucket_averages`` leaves out."""
    return prices.where(parse_time_epoch(time_col, ACCEPTED_TIME_FORMATS).isNull())


def weather_price_table(weather_avgs: DataFrame, price_avgs: DataFrame, key: str = "dt",
                        price_key: str = "dt_prices") -> DataFrame:
    """Inner join on the bucket, price key dropped."""
    return bucket_join(weather_avgs, price_avgs, key, price_key)
