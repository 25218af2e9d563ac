"""Reference-shaped inputs: L2 / L10 with the original names, hourly price CSV (A4/F5),
bounded listening with a console sink (A6/A8), price messages (A11/I3)."""

import json

from pyspark.sql import functions as F

from tempora.constants import PRICE_MESSAGE_KEYS
from tempora.operators.series import previous_row, upsample_pairs
from tempora.plans.explore import distribution_report, explore_table, explore_weather
from tempora.sources.files import read_csv
from tempora.sources.sinks import to_console
from tempora.streaming.messages import parse_price_messages, price_messages
from tempora.streaming.sources import message_stream, run_bounded

F1_COLS = ("dt bigint, id bigint, main_temp double, main_feels_like double, main_temp_min double, "
           "main_temp_max double, main_pressure bigint, main_humidity bigint, visibility bigint, wind_speed double, "
           "wind_deg bigint, clouds_all bigint, sys_sunrise bigint, sys_sunset bigint, weather_0__id bigint, "
           "weather_0__main string, weather_0__description string, coord_lon double, coord_lat double")


def _f1(spark):
    rows = []
    for b in range(12):
        for c in range(4):
            kind = ("Clouds", 803, "broken clouds") if (b + c) % 3 and b >= 3 else ("Rain", 500, "light rain")
            rows.append((1671253800 + b * 300 + c, 10 + c, 275.0 + c + b / 10, 273.0, 274.0, 276.0, 1010 + b, 80, 9000 - b,
                         3.0 + c, 200, 50 + b, 1671260000 + c, 1671290000 + c, kind[1], kind[0], kind[2], 4.3, 50.8))
    return spark.createDataFrame(rows, F1_COLS)


def test_explore_and_distribution_report(spark):
    weather = explore_weather(_f1(spark))
    assert {"mode_weather_id", "mode_weather_main", "mode_weather_desc", "avg_sunrise", "avg_sunset",
            "avg_min_temp"} <= set(weather.columns)
    assert dict(weather.dtypes)["avg_sunrise"] == "int"
    first = weather.orderBy("dt").first()
    assert first.mode_weather_main == "Rain" and first.mode_weather_id == 500 and first.avg_sunrise == 1671260001  # int(1671260001.5)
    prices = spark.createDataFrame([("Belgium", "BEL", "2022-12-17 05:10:00", "", 100.0 + i) for i in range(3)],
                                   "Country string, ISO3_Code string, Datetime__UTC_ string, Datetime__Local_ string, "
                                   "Price__EUR_MWhe_ double")
    joined = explore_table(_f1(spark), prices)
    assert joined.count() == 1 and joined.first().avg_price == 101.0
    report = distribution_report(weather, joined)
    assert report["weather_types"].count() == 2
    assert report["visibility"].agg(F.sum("count")).first()[0] == 12
    assert report["visibility_by_type"].count() == 2


def test_hourly_price_csv_and_messages(spark, scratch):
    path = f"{scratch}/prices.csv"
    with open(path, "w") as f:
        f.write(",".join(PRICE_MESSAGE_KEYS) + "\n")
        f.write("Belgium,BEL,2022-01-01 00:00:00,2022-01-01 01:00:00,100.0\n")
        f.write("Belgium,BEL,2022-01-01 01:00:00,2022-01-01 02:00:00,110.0\n")
        f.write("Austria,AUT,2022-01-01 00:00:00,2022-01-01 01:00:00,90.0\n")
    df = read_csv(spark, path, columns={k: ("double" if k == PRICE_MESSAGE_KEYS[4] else "string")
                                        for k in PRICE_MESSAGE_KEYS})
    be = df.where(F.col("Country") == "Belgium").select(
        F.col("`Datetime (UTC)`").cast("timestamp_ntz").alias("utc"),
        F.col("`Datetime (Local)`").cast("timestamp_ntz").alias("local"),
        F.col("`Price (EUR/MWhe)`").alias("price"))
    pairs = previous_row(be, [], ["utc"], ["utc", "price"], chunk_seconds=None).where(F.col("prev_utc").isNotNull())
    points = upsample_pairs(pairs, "prev_utc", "utc", "prev_price", "price")
    assert points.count() == 720
    msgs = price_messages(points.withColumn("local", F.col("ts") + F.expr("INTERVAL 1 HOUR")), "Belgium", "BEL",
                          "ts", "local", "price")
    back = parse_price_messages(msgs).orderBy("Datetime__UTC_").first()
    assert back.Datetime__UTC_ == "2022-01-01 00:00:00" and back.Datetime__Local_ == "2022-01-01 01:00:00"
    assert back.Price__EUR_MWhe_ == 100.0 and back.ISO3_Code == "BEL"


def test_bounded_listening_with_console_sink(spark, scratch):
    topic = f"{scratch}/topic"
    spark.createDataFrame([(json.dumps({"dt": 1, "cod": 200}),)], "value string").write.text(topic)
    q = to_console(message_stream(spark, topic), f"{scratch}/ckpt")
    assert run_bounded(q, 3) is False  # still listening after 3 s, then stopped
    assert not q.isActive


def test_price_replay_messages(spark, scratch):
    from tempora.plans.price_replay import replay_messages

    path = f"{scratch}/history.csv"
    with open(path, "w") as f:
        f.write(",".join(PRICE_MESSAGE_KEYS) + "\n")
        for h, p in [(0, 100.0), (1, 110.0), (2, 90.0)]:
            f.write(f"Belgium,BEL,2022-01-01 {h:02d}:00:00,2022-01-01 {h + 1:02d}:00:00,{p}\n")
        f.write("France,FRA,2022-01-01 00:00:00,2022-01-01 01:00:00,80.0\n")
    history = read_csv(spark, path)
    msgs = parse_price_messages(replay_messages(history, "Belgium", noise_sigma=0.0))
    assert msgs.count() == 2 * 720
    rows = msgs.orderBy("Datetime__UTC_").collect()
    assert rows[0].Datetime__Local_ == "2022-01-01 01:00:00" and rows[0].Country == "Belgium"
    assert rows[0].ISO3_Code == "BEL" and rows[0].Price__EUR_MWhe_ == 100.0
    assert rows[719].Price__EUR_MWhe_ == 110.0 and rows[719].Datetime__UTC_ == "2022-01-01 00:59:55"
    noisy = replay_messages(history, "Belgium", noise_sigma=1.0, seed=7)
    assert noisy.count() == 2 * 720


def test_distribution_report_points(spark):
    weather = explore_weather(_f1(spark))
    prices = spark.createDataFrame([("Belgium", "BEL", "2022-12-17 05:10:00", "", 100.0)],
                                   "Country string, ISO3_Code string, Datetime__UTC_ string, Datetime__Local_ string, "
                                   "Price__EUR_MWhe_ double")
    joined = explore_table(_f1(spark), prices)
    report = distribution_report(weather, joined)
    assert report["points_temperature"].count() == joined.count() == 1
