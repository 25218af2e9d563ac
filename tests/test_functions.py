"""Scalar functions: bucket edges (Q1), time texts (Q3), names, JSON, series maths."""

import datetime as dt

from pyspark.sql import functions as F

from tempora.functions import (
    bucket_start, clean_name, drop_name_time, even_timestamp, int_div, linspace_value, parse_time_text, split_pair,
    truncate_int, two_decimals_text,
)
from tempora.functions.timebuckets import ACCEPTED_TIME_FORMATS


def test_bucket_edges_floor_and_64_bit(spark):
    # bucket_edges fixture: floor (not truncation toward zero) and no overflow after 2038.
    epochs = [-301, -1, 0, 299, 300, 2524608000]
    df = spark.createDataFrame([(e,) for e in epochs], "dt bigint")
    got = [r[0] for r in df.select(bucket_start("dt", 300).alias("b")).orderBy("b").collect()]
    want = [dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s) for s in [-600, -300, 0, 0, 300, 2524608000]]
    assert got == want


def test_bucket_with_shift(spark):
    df = spark.createDataFrame([(0,)], "dt bigint")
    got = df.select(bucket_start("dt", 300, shift_seconds=251129400).alias("b")).first()[0]
    assert got == dt.datetime(1970, 1, 1) + dt.timedelta(seconds=251129400 - 251129400 % 300)


def test_time_texts(spark):
    rows = [("2022-12-17 05:12:13",), ("2022-12-17 05:12:13.123",), ("2022-12-17T05:12:13",), ("2022-12-17",),
            ("2022-12-17 05:12:13xyz",), ("garbage",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    strict = [r[0] for r in df.select(parse_time_text("s").alias("t")).collect()]
    assert strict[0] == dt.datetime(2022, 12, 17, 5, 12, 13)
    assert strict[1:] == [None] * 6  # the default price format accepts exactly one layout
    lenient = [r[0] for r in df.select(parse_time_text("s", ACCEPTED_TIME_FORMATS).alias("t")).collect()]
    assert lenient[:4] == [dt.datetime(2022, 12, 17, 5, 12, 13), dt.datetime(2022, 12, 17, 5, 12, 13, 123000),
                           dt.datetime(2022, 12, 17, 5, 12, 13), dt.datetime(2022, 12, 17)]
    assert lenient[4:] == [None, None, None]  # trailing garbage is rejected, unlike the LEGACY parser


def test_drop_name_time(spark):
    df = spark.createDataFrame([("2022-12-17-05-12-13fc975232",), ("bad-name",)], "n string")
    got = [r[0] for r in df.select(drop_name_time("n")).collect()]
    assert got == [dt.datetime(2022, 12, 17, 5, 12, 13), None]


def test_clean_name():
    assert clean_name("Price (EUR/MWhe)") == "Price__EUR_MWhe_"
    assert clean_name("Datetime (UTC)") == "Datetime__UTC_"
    assert clean_name("weather[0]_id") == "weather_0__id"


def test_split_pair_and_truncate(spark):
    df = spark.createDataFrame([("50.85,4.35",), ("bad",), (None,)], "c string")
    a, b = split_pair(F.col("c"))
    got = df.select(a.alias("a"), b.alias("b")).collect()
    assert (got[0].a, got[0].b) == (50.85, 4.35)
    assert (got[1].a, got[1].b) == (None, None) and (got[2].a, got[2].b) == (None, None)
    t = spark.createDataFrame([(2.7,), (-2.7,)], "x double").select(truncate_int("x")).collect()
    assert [r[0] for r in t] == [2, -2]


def test_two_decimals_text_has_no_grouping(spark):
    got = spark.createDataFrame([(1013.256,), (-0.004,)], "x double").select(two_decimals_text("x")).collect()
    assert [r[0] for r in got] == ["1013.26", "-0.00"]


def test_linspace_and_even_timestamps(spark):
    df = spark.range(720).select(F.col("id").cast("int").alias("i"))
    t0, t1 = dt.datetime(2022, 1, 1, 0), dt.datetime(2022, 1, 1, 1)
    out = df.select(
        "i",
        linspace_value(F.lit(10.0), F.lit(20.0), F.col("i"), 720).alias("p"),
        even_timestamp(F.lit(t0).cast("timestamp_ntz"), F.lit(t1).cast("timestamp_ntz"), F.col("i"), 721).alias("t"),
    ).orderBy("i").collect()
    assert out[0].p == 10.0 and out[-1].p == 20.0  # both ends included (Q11)
    assert out[1].t - out[0].t == dt.timedelta(seconds=5)
    assert out[-1].t == t1 - dt.timedelta(seconds=5)
    assert spark.range(1).select(int_div(F.lit(3600), 5)).first()[0] == 720


def test_two_decimals_matches_percent_format(spark):
    from tempora.functions import two_decimals

    xs = [1.005, 2.675, 0.125, -266.6, 1013.256, 6.85]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(two_decimals("x")).collect()]
    assert got == [float("{:.2f}".format(x)) for x in xs]
