"""Map the benchmark tables onto the original system's inputs (readings, prices, messages).

- weather readings  <- ``events``: epoch ``dt`` from ``ts``; ``user_id`` is the city id;
  ``event_type`` the weather category; ``value``, ``k`` (from ``props``) and
  ``user_id`` the measures.
- daily price drops <- ``orders``: ``o_orderdate`` shifted onto the events' month,
  ``o_totalprice`` the price, ``o_orderpriority`` the country.
- price ticks       <- ``events`` of type ``purchase``: ``value`` is a price at ``ts``.
- weather readings for the live views <- all other ``events``.

Every function is a projection (or a filter) of a table read from ``sf_dir``;
the work therefore grows with the tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.timebuckets import epoch_seconds
from tempora.sources.files import is_folder, read_table

# Fixed stand-in parameters (chosen once for the benchmark tables).
ORDERS_SHIFT_SECONDS = 915_148_800     # 10,592 days: 1995-01-01 -> 2024-01-01
DAY_SECONDS = 86_400
HOUR_SECONDS = 3_600
STANDIN_AVERAGES = {"avg_value": "value", "avg_k": "k", "avg_user_id": "user_id"}
PRICE_TICK_TYPE = "purchase"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, os.path.join(sf_dir, f"{name}.parquet"))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather-reading shape: dt (epoch s), user_id (city), event_type (category), value, k."""
    return events_to_readings(table(spark, sf_dir, "events"))


def events_to_readings(ev: DataFrame) -> DataFrame:
    """The reading projection of an events frame (batch or streaming)."""
    return ev.select(
        epoch_seconds("ts").alias("dt"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )


def daily_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price-drop shape: time (timestamp), price, country."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderdate").alias("time"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("country"),
        F.col("o_orderkey").alias("row_id"),
    )


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``events`` as a file stream: a folder of part files, or one file (then a glob keeps it apart from its neighbours)."""
    path = os.path.join(sf_dir, "events.parquet")
    reader = spark.readStream.schema(table(spark, sf_dir, "events").schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def price_ticks(spark: SparkSession, sf_dir: str, prefilter=None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if prefilter is not None:
        ev = prefilter(ev)
    return ev.where(F.col("event_type") == PRICE_TICK_TYPE).select(
        epoch_seconds("ts").alias("dt"), F.col("value").alias("price"), "event_id"
    )


def live_readings(spark: SparkSession, sf_dir: str, prefilter=None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    if prefilter is not None:
        ev = prefilter(ev)
    return ev.where(F.col("event_type") != PRICE_TICK_TYPE).select(
        epoch_seconds("ts").alias("dt"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
