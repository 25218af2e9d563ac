"""Weather / price messages: fixed schemas, encode (A11/H11), decode + flatten.

The same functions serve batch frames and streaming frames: a stream read from
files or a message bus is a DataFrame with a ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.constants import PRICE_MESSAGE_KEYS
from tempora.functions.jsonops import CORRUPT_FIELD, clean_name, decode_json, encode_json, flatten_struct
from tempora.functions.timebuckets import epoch_seconds

_D = T.DoubleType()

# Weather message (F3): nested objects, one list of weather conditions.
WEATHER_MESSAGE_SCHEMA = T.StructType([
    T.StructField("dt", T.LongType()),
    T.StructField("main", T.StructType([
        T.StructField("temp", _D), T.StructField("feels_like", _D), T.StructField("pressure", _D),
        T.StructField("humidity", _D), T.StructField("temp_min", _D), T.StructField("temp_max", _D),
    ])),
    T.StructField("visibility", _D),
    T.StructField("wind", T.StructType([T.StructField("speed", _D), T.StructField("deg", _D)])),
    T.StructField("clouds", T.StructType([T.StructField("all", _D)])),
    T.StructField("weather", T.ArrayType(T.StructType([
        T.StructField("id", T.LongType()), T.StructField("main", T.StringType()),
        T.StructField("description", T.StringType()), T.StructField("icon", T.StringType()),
    ]))),
    T.StructField("coord", T.StructType([T.StructField("lon", _D), T.StructField("lat", _D)])),
    T.StructField("sys", T.StructType([
        T.StructField("type", T.LongType()), T.StructField("id", T.LongType()), T.StructField("country", T.StringType()),
        T.StructField("sunrise", T.LongType()), T.StructField("sunset", T.LongType()),
    ])),
    T.StructField("base", T.StringType()),
    T.StructField("timezone", T.LongType()),
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("cod", T.LongType()),
])

# Price message (F4): flat, five keys.
PRICE_MESSAGE_SCHEMA = T.StructType([
    T.StructField(PRICE_MESSAGE_KEYS[0], T.StringType()),
    T.StructField(PRICE_MESSAGE_KEYS[1], T.StringType()),
    T.StructField(PRICE_MESSAGE_KEYS[2], T.StringType()),
    T.StructField(PRICE_MESSAGE_KEYS[3], T.StringType()),
    T.StructField(PRICE_MESSAGE_KEYS[4], _D),
])


def parse_weather_messages(messages: DataFrame, schema: T.StructType = WEATHER_MESSAGE_SCHEMA,
                           value_col: str = "value", keep: list[str] | None = None,
                           list_items: dict[str, int] | None = None) -> DataFrame:
    """H9 + H10: decode each message with the fixed schema and flatten to ``parent_child`` columns.

    Element 0 of ``weather`` is lifted to ``weather_0__id`` ... (the landing
    layout); the list itself stays as a column. A malformed message gives a row
    of NULLs plus ``_malformed = true`` so callers can reject it.
    """
    decoded = messages.select(*(keep or []), decode_json(value_col, schema, keep_corrupt=True).alias("_raw"))
    decoded = decoded.select(
        *(keep or []),
        (F.col("_raw").isNull() | F.col(f"_raw.{CORRUPT_FIELD}").isNotNull()).alias("_malformed"),
        F.struct(*[F.col(f"_raw.{f.name}").alias(f.name) for f in schema.fields]).alias("_msg"),
    )
    flat = flatten_struct(decoded, "_msg", list_items if list_items is not None else {"weather": 1},
                          keep=[*(keep or []), "_malformed"])
    return flat.withColumnsRenamed({c: clean_name(c) for c in flat.columns if clean_name(c) != c})


def parse_price_messages(messages: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """H9 + H10 for price messages: "Price (EUR/MWhe)" -> "Price__EUR_MWhe_" and so on."""
    decoded = messages.select(*(keep or []), decode_json(value_col, PRICE_MESSAGE_SCHEMA).alias("_msg"))
    return decoded.select(*(keep or []), *[F.col("_msg").getField(k).alias(clean_name(k)) for k in PRICE_MESSAGE_KEYS])


def weather_messages_from_events(events: DataFrame) -> DataFrame:
    """A11 on the benchmark table: each event as a weather message (``value`` = JSON text).

    ts -> dt (epoch s), value -> main.temp, props.k -> main.humidity,
    event_type -> weather[0].main, user_id -> id, cod = 200.
    """
    return events.select(
        encode_json(
            epoch_seconds("ts").alias("dt"),
            F.struct(F.col("value").alias("temp"),
                     F.get_json_object("props", "$.k").cast("double").alias("humidity")).alias("main"),
            F.array(F.struct(F.col("event_type").alias("main"))).alias("weather"),
            F.col("user_id").alias("id"),
            F.lit(200).cast("bigint").alias("cod"),
        ).alias("value")
    )


def price_messages(prices: DataFrame, country: str | Column, iso_code: str | Column, utc_col: str, local_col: str,
                   price_col: str) -> DataFrame:
    """A11 for price points: the five keys, times as 'yyyy-MM-dd HH:mm:ss' text."""
    fmt = "yyyy-MM-dd HH:mm:ss"
    as_col = lambda v: F.lit(v) if isinstance(v, str) else v
    return prices.select(encode_json(
        as_col(country).alias(PRICE_MESSAGE_KEYS[0]),
        as_col(iso_code).alias(PRICE_MESSAGE_KEYS[1]),
        F.date_format(utc_col, fmt).alias(PRICE_MESSAGE_KEYS[2]),
        F.date_format(local_col, fmt).alias(PRICE_MESSAGE_KEYS[3]),
        F.col(price_col).alias(PRICE_MESSAGE_KEYS[4]),
    ).alias("value"))
