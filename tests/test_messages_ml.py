"""Messages (bad_messages, Q12), features (null_features, J1), models (J3-J9), split."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tempora.operators.ml import (
    assemble, evaluate, fit_linear, hash_split, load_model, model_summary, predict, residuals, save_model,
)
from tempora.streaming.messages import parse_price_messages, parse_weather_messages
from tempora.streaming.scoring import message_rejects

GOOD = {"dt": 1671253933, "main": {"temp": 280.1, "feels_like": 278.0, "pressure": 1012, "humidity": 80},
        "visibility": 10000, "wind": {"speed": 3.1, "deg": 200}, "clouds": {"all": 75},
        "weather": [{"id": 803, "main": "Clouds", "description": "broken clouds", "icon": "04n"}],
        "id": 2800866, "cod": 200}


def test_bad_messages(spark):
    no_vis = dict(GOOD)
    no_vis.pop("visibility")
    not_found = dict(GOOD, cod=404)
    empty_weather = dict(GOOD, weather=[])
    msgs = [json.dumps(GOOD), json.dumps(no_vis), json.dumps(not_found), "{not json", json.dumps(empty_weather)]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    parsed = parse_weather_messages(df)
    assert {"main_temp", "wind_speed", "clouds_all", "weather_0__id", "weather_0__main", "weather"} <= set(parsed.columns)
    rows = parsed.collect()
    assert rows[0].main_temp == 280.1 and rows[0].weather_0__description == "broken clouds"
    assert rows[1].visibility is None and rows[3]._malformed and rows[4].weather_0__main is None
    good, bad = message_rejects(parsed)
    assert good.count() == 2 and bad.count() == 3  # missing feature, cod 404 and malformed are rejected


def test_price_message_names(spark):
    msg = {"Country": "Belgium", "ISO3 Code": "BEL", "Datetime (UTC)": "2022-12-17 05:00:00",
           "Datetime (Local)": "2022-12-17 06:00:00", "Price (EUR/MWhe)": 251.3}
    got = parse_price_messages(spark.createDataFrame([(json.dumps(msg),)], "value string")).first()
    assert got.Price__EUR_MWhe_ == 251.3 and got.Datetime__UTC_ == "2022-12-17 05:00:00" and got.ISO3_Code == "BEL"


def _train(spark, n=200):
    rows = [(float(i), float(i % 7), 3.0 * i + 2.0 * (i % 7) + 5.0 + ((i * 37) % 11) / 10.0) for i in range(n)]
    return spark.createDataFrame(rows, "x1 double, x2 double, price double")


def test_null_features(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (2.0, 1.0, 4.0)], "x1 double, x2 double, price double")
    with pytest.raises(Exception):
        assemble(df, ["x1", "x2"]).collect()
    assert assemble(df, ["x1", "x2"], handle_invalid="skip").count() == 1


def test_ols_equals_sql_regression(spark):
    df = _train(spark)
    m = fit_linear(assemble(df, ["x1"]), reg_param=0.0, elastic_net=0.0)
    r = df.agg(F.regr_slope("price", "x1").alias("s"), F.regr_intercept("price", "x1").alias("i"),
               F.regr_r2("price", "x1").alias("r2")).first()
    assert abs(m.coefficients[0] - r.s) < 1e-9 * abs(r.s)
    assert abs(m.intercept - r.i) < 1e-7 * max(1.0, abs(r.i))
    assert abs(m.summary.r2 - r.r2) < 1e-9


def test_elastic_net_save_load_and_metrics(spark, scratch):
    data = assemble(_train(spark), ["x1", "x2"])
    m = fit_linear(data)
    s = model_summary(spark, m).first()
    assert s.iterations >= 1 and len(s.coefficients) == 2 and s.n == 200
    rmse = residuals(m).agg(F.sqrt(F.avg(F.col("residuals") ** 2))).first()[0]
    assert abs(rmse - s.rmse) < 1e-9
    path = save_model(m, f"{scratch}/models", "v1")
    a = predict(m, data).select("prediction").collect()
    b = predict(load_model(path), data).select("prediction").collect()
    assert a == b
    ev = evaluate(m, data).first()
    assert abs(ev.rmse - s.rmse) < 1e-9


def test_hash_split_is_stable(spark):
    df = spark.range(10000).withColumnRenamed("id", "event_id")
    train, test = hash_split(df, ["event_id"])
    n_train, n_test = train.count(), test.count()
    assert n_train + n_test == 10000 and 6700 < n_train < 7300
    again, _ = hash_split(df.repartition(7), ["event_id"])
    assert again.count() == n_train


def test_elastic_net_of_one_feature_has_its_closed_form(spark):
    """Soft threshold on the standardised slope; the label's spread is small, so that the penalty counts."""
    from tempora.operators.ml import assemble, fit_linear

    rng = random.Random(5)
    xs = [rng.gauss(10, 4) for _ in range(400)]
    ys = [0.2 * x + rng.gauss(0, 1) for x in xs]
    n, reg, alpha = len(xs), 0.3, 0.8
    mx, my = sum(xs) / n, sum(ys) / n
    sx = (sum((x - mx) ** 2 for x in xs) / (n - 1)) ** 0.5
    sy = (sum((y - my) ** 2 for y in ys) / (n - 1)) ** 0.5
    cross = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / n / sx / sy
    slope = max(0.0, cross - reg * alpha / sy) / ((n - 1) / n + reg * (1 - alpha) / sy) * sy / sx
    df = spark.createDataFrame(list(zip(xs, ys)), "x double, y double")
    model = fit_linear(assemble(df, ["x"]), label="y", max_iter=100, reg_param=reg, elastic_net=alpha)
    assert 0 < slope < 0.2 and abs(model.coefficients[0] - slope) < 1e-4
    assert abs(model.intercept - (my - slope * mx)) < 1e-3
