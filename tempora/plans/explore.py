"""L2 (exploration table) and L10 (distribution report) with the original column names."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tempora.constants import BUCKET_SECONDS, EXPLORE_AVERAGES, EXPLORE_MODES, EXPLORE_TRUNCATED, KELVIN_OFFSET
from tempora.operators.aggregates import modes_and_averages
from tempora.operators.joins import bucket_join
from tempora.operators.profile import box_stats, categorical_histogram, numeric_histogram, pair_stats
from tempora.plans.weather_price import bucketed_readings, price_bucket_averages


def explore_weather(readings: DataFrame, width_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """L2, weather part: per bucket, the modes of weather id / main / description and 12 averages
    (sunrise and sunset truncated to int), in one shared aggregation pass over the distinct readings."""
    b = bucketed_readings(readings, width_seconds=width_seconds).drop("coord_lon", "coord_lat")
    return modes_and_averages(b, "dt", EXPLORE_MODES, EXPLORE_AVERAGES, EXPLORE_TRUNCATED)


def explore_table(readings: DataFrame, prices: DataFrame, shift_seconds: int = 0,
                  width_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """L2: the weather part joined to the per-bucket average price."""
    p = price_bucket_averages(prices, width_seconds=width_seconds, shift_seconds=shift_seconds)
    return bucket_join(explore_weather(readings, width_seconds), p, "dt", "dt_prices")


def distribution_report(weather: DataFrame, joined: DataFrame) -> dict[str, DataFrame]:
    """The data behind the distribution plots."""
    celsius = weather.withColumn("avg_temp_c", weather["avg_temp"] - KELVIN_OFFSET)
    joined_c = joined.withColumn("avg_temp_c", joined["avg_temp"] - KELVIN_OFFSET)
    return {
        "weather_types": categorical_histogram(weather, "mode_weather_main"),
        "visibility": numeric_histogram(weather, "avg_visibility"),
        "temperature": numeric_histogram(celsius, "avg_temp_c"),
        "wind_speed": numeric_histogram(weather, "avg_wind_speed"),
        "visibility_by_type": box_stats(weather, "mode_weather_main", "avg_visibility"),
        "price_by_type": box_stats(joined, "mode_weather_main", "avg_price"),
        "price_vs_temperature": pair_stats(joined_c, "avg_temp_c", "avg_price"),
        "price_vs_wind": pair_stats(joined, "avg_wind_speed", "avg_price"),
        "price_vs_clouds": pair_stats(joined, "avg_clouds", "avg_price"),
        # The scatter points themselves (one per bucket, so all of them are kept).
        "points_temperature": joined_c.select("avg_temp_c", "avg_price"),
        "points_wind": joined.select("avg_wind_speed", "avg_price"),
        "points_clouds": joined.select("avg_clouds", "avg_price"),
    }
