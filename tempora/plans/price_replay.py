"""I3 as one job: hourly price history -> 5-second price messages for one country.

CSV (A4) -> country filter (B9) -> UTC offset of the first row (H13) -> consecutive
pairs (E2, first row only starts a pair: B14) -> 720 points per pair (H15-H17) ->
local time = UTC + offset -> JSON messages (A11). Pacing the messages in real time
is left to the consumer's trigger; the data is identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.constants import (
    DEFAULT_COUNTRY, PRICE_MESSAGE_KEYS, PRICE_RANGE_PERIODS, PRICE_SOURCE_STEP_SECONDS, PRICE_STEP_SECONDS,
)
from tempora.functions.timebuckets import parse_time_text, plus_seconds
from tempora.operators.projections import where_equals
from tempora.operators.series import first_offset, previous_row, upsample_pairs
from tempora.streaming.messages import price_messages


def replay_points(history: DataFrame, country: str = DEFAULT_COUNTRY, step_seconds: int = PRICE_STEP_SECONDS,
                  source_step_seconds: int = PRICE_SOURCE_STEP_SECONDS, periods: int | None = PRICE_RANGE_PERIODS,
                  noise_sigma: float = 1.0, seed: int = 42, chunk_seconds: int = 30 * 86_400) -> DataFrame:
    """The up-sampled points (country, iso, ts, local_ts, price, gap_seconds) of one country."""
    country_col, iso_col, utc_col, local_col, price_col = PRICE_MESSAGE_KEYS
    h = where_equals(history, country_col, country).select(
        F.col(f"`{country_col}`").alias("country"),
        F.col(f"`{iso_col}`").alias("iso"),
        parse_time_text(F.col(f"`{utc_col}`")).alias("utc"),
        parse_time_text(F.col(f"`{local_col}`")).alias("local"),
        F.col(f"`{price_col}`").cast("double").alias("price"),
    )
    h = first_offset(h, ["country"], ["utc"], "utc", "local", out="offset_seconds")
    pairs = previous_row(h, ["country"], ["utc"], ["utc", "price"], chunk_seconds=chunk_seconds).where(
        F.col("prev_utc").isNotNull())
    points = upsample_pairs(pairs, "prev_utc", "utc", "prev_price", "price", step_seconds, source_step_seconds,
                            periods, noise_sigma=noise_sigma, seed=seed, keep=["country", "iso", "offset_seconds"])
    return points.withColumn("local_ts", plus_seconds("ts", F.col("offset_seconds"))).drop("offset_seconds")


def replay_messages(history: DataFrame, country: str = DEFAULT_COUNTRY, **kwargs) -> DataFrame:
    """The messages (``value`` = JSON text) the publisher would send, in no particular order."""
    points = replay_points(history, country, **kwargs)
    return price_messages(points, F.col("country"), F.col("iso"), "ts", "local_ts", "price")
