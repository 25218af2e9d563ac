"""The user-facing jobs as registered queries: refresh (L3), retrain (L4), scoring (I1, L5, X2), stored models.

The drops are written from ``events`` in the schemas that the jobs read (readings from every event that is no
price tick, prices from the ticks); all work is the jobs' own. Models have one feature, for
which the elastic net has a closed form in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.constants import BATCH_VIEW_COLUMNS, ELASTIC_NET_PARAMS
from tempora.plans import standins as S
from tempora.plans.benchmark_queries import (
    _BOUNDED,
    ORACLES,
    _SQL_EPOCH_TS,
    _SQL_FLAGSHIP,
    _SQL_K,
    _publish_events,
    _round,
    _sql_bucket,
    bucket_avg_5min,
    bucket_join_shifted,
    register,
)
from tempora.session import shared_path

# Reading column -> the same expression in Spark and in DuckDB.
_MEASURES = {
    "main_temp": "value", "main_feels_like": "value - 2", "main_pressure": "k", "main_humidity": "user_id % 100",
    "visibility": "user_id", "wind_speed": "value / 10", "wind_deg": "user_id % 360", "clouds_all": "k / 2",
}
_VIEW = {c: c for c in BATCH_VIEW_COLUMNS if c != "dt"}


def _drops(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Folders with an older and a newer drop of readings, and one of prices."""
    base = shared_path(spark, "drops", unique=True)
    weather = S.live_readings(spark, sf_dir).select(
        "dt", F.col("user_id").alias("id"), F.col("event_type").alias("weather_0__main"), *[F.expr(e).alias(c) for c, e in _MEASURES.items()])
    weather.where("id % 2 = 0").write.parquet(f"{base}/weather/2024-01-30-00-00-00a")
    weather.write.parquet(f"{base}/weather/2024-01-31-00-00-00b")
    ticks = S.table(spark, sf_dir, "events").where(F.col("event_type") == S.PRICE_TICK_TYPE)
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    ticks.select(F.lit("Belgium").alias("Country"), F.lit("BEL").alias("ISO3_Code"), time.alias("Datetime__UTC_"),
                 time.alias("Datetime__Local_"), F.col("value").alias("Price__EUR_MWhe_")).write.parquet(f"{base}/prices/2024-01-31-00-00-00b")
    return f"{base}/weather", f"{base}/prices"


_SQL_VIEW = f"""
SELECT dt, {', '.join(c for c in BATCH_VIEW_COLUMNS if c != 'dt')} FROM (
  SELECT dt, avg(main_temp) AS avg_temp, avg(main_feels_like) AS avg_feels_like_temp, avg(main_pressure) AS avg_pressure,
         avg(main_humidity) AS avg_humidity, avg(visibility) AS avg_visibility, avg(wind_speed) AS avg_wind_speed,
         avg(wind_deg) AS avg_wind_deg, avg(clouds_all) AS avg_clouds
  FROM (SELECT DISTINCT {_sql_bucket(_SQL_EPOCH_TS, 300)} AS dt, user_id AS id, event_type,
               {', '.join(f'{e} AS {c}' for c, e in _MEASURES.items())}
        FROM (SELECT *, {_SQL_K} AS k FROM events WHERE event_type <> '{S.PRICE_TICK_TYPE}'))
  GROUP BY dt)
JOIN (SELECT {_sql_bucket(_SQL_EPOCH_TS, 300)} AS dt, avg(value) AS avg_price FROM events
      WHERE event_type = '{S.PRICE_TICK_TYPE}' GROUP BY 1) USING (dt)
"""


def _net_ctes(source: str, x: str, y: str) -> str:
    """CTE ``net(slope, intercept)``: the elastic net of ``y`` on ``x`` over the rows of ``source``."""
    reg, mixing = ELASTIC_NET_PARAMS["regParam"], ELASTIC_NET_PARAMS["elasticNetParam"]
    return f"""
train AS ({source}),
stat AS (SELECT corr({y}, {x}) AS r, stddev_pop({x}) AS sx, stddev_pop({y}) AS sy, avg({x}) AS mx, avg({y}) AS my FROM train),
scaled AS (SELECT *, sign(r) * greatest(abs(r) - {mixing} * {reg} / sy, 0) / (1 + {1 - mixing} * {reg} / sy) * sy / sx AS slope FROM stat),
net AS (SELECT slope, my - slope * mx AS intercept FROM scaled)"""


@register("refresh_view", f"SELECT dt, {', '.join(f'round({c}, 6) AS {c}' for c in _VIEW)} FROM ({_SQL_VIEW})")
def refresh_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 (A2, L1, A9): the newest drops averaged, joined and upserted into the batch view; a second refresh changes nothing."""
    from tempora.plans.jobs import refresh_batch_view
    from tempora.sources.sinks import KeyedTable

    weather, prices = _drops(spark, sf_dir)
    view = KeyedTable(shared_path(spark, "view", unique=True), keys=["dt"])
    for _ in range(2):
        refresh_batch_view(spark, weather, prices, view)
    return _round(view.read(spark), _VIEW)


@register("retrain_job", f"WITH {_net_ctes(_SQL_VIEW, 'avg_temp', 'avg_price')} SELECT round(slope, 4) AS slope, round(intercept, 3) AS intercept FROM net")
def retrain_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 (A2, L1, B4, J1, J3, J8, J9): the newest drops, the training names, a fit that is stored and loaded again."""
    from tempora.operators.ml import load_model
    from tempora.plans.jobs import retrain

    weather, prices = _drops(spark, sf_dir)
    model = load_model(retrain(spark, weather, prices, shared_path(spark, "models", unique=True), features=["main_temp"]))
    row = (round(float(model.coefficients[0]), 4), round(float(model.intercept), 3))
    return spark.createDataFrame([row], "slope double, intercept double")


@register("predict_stored", f"""
WITH {_net_ctes(_SQL_FLAGSHIP, 'avg_value', 'avg_price')}
SELECT dt, round(intercept + slope * avg_value, 1) AS prediction FROM train, net
""")
def predict_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A one-feature fit is stored, the newest stored model loaded and applied to every row."""
    from tempora.operators.ml import assemble, fit_linear, load_model, newest_model_path, predict, save_model

    data = assemble(bucket_join_shifted(spark, sf_dir), ["avg_value"])
    models = shared_path(spark, "models", unique=True)
    save_model(fit_linear(data, label="avg_price"), models, "v000001")
    out = predict(load_model(newest_model_path(spark, models)), data)
    return out.select("dt", F.round("prediction", 1).alias("prediction"))


@register("score_buckets_one", f"""
WITH {_net_ctes(_SQL_FLAGSHIP, 'avg_value', 'avg_price')},
b AS (SELECT {_sql_bucket(_SQL_EPOCH_TS, 300)} AS dt, round(avg(value), 6) AS avg_value FROM events GROUP BY 1)
SELECT dt, round(intercept + slope * avg_value, 1) AS prediction FROM b, net
""")
def score_buckets_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A one-feature model applied to 5-minute averages."""
    from tempora.operators.ml import assemble, fit_linear
    from tempora.streaming.bucket_stream import score_bucket_averages

    model = fit_linear(assemble(bucket_join_shifted(spark, sf_dir), ["avg_value"]), label="avg_price")
    return _round(score_bucket_averages(bucket_avg_5min(spark, sf_dir), model, ["avg_value"]), ["prediction"], 1)


@register("live_scores", f"""
WITH {_net_ctes(_SQL_FLAGSHIP, 'avg_value', 'avg_price')}
SELECT dt, id, max(prediction) AS prediction FROM (
  SELECT make_timestamp({_SQL_EPOCH_TS} * 1000000) AS dt, user_id AS id, round(intercept + slope * value, 1) AS prediction FROM events, net)
GROUP BY dt, id
""")
def live_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5 (A5, A7, A11, H9, I1, I2): messages scored by the newest stored model, upserted by time and city; of messages of
    one time and city the highest prediction is kept."""
    from tempora.operators.ml import assemble, fit_linear, save_model
    from tempora.operators.projections import rename_columns
    from tempora.sources.sinks import KeyedTable
    from tempora.streaming.scoring import start_scoring
    from tempora.streaming.sources import message_stream, run_available

    base = shared_path(spark, "live_scores", unique=True)
    train = rename_columns(bucket_join_shifted(spark, sf_dir), {"avg_value": "main_temp", "avg_price": "price"})
    save_model(fit_linear(assemble(train, ["main_temp"])), f"{base}/models", "v000001")
    table = KeyedTable(f"{base}/predictions", keys=["dt", "id"], order=["prediction"])
    run_available(start_scoring(spark, message_stream(spark, _publish_events(spark, sf_dir), options=_BOUNDED), f"{base}/models", table,
                                f"{base}/rejects", f"{base}/_ckpt", features=["main_temp"], available_now=True))
    return table.read(spark).select("dt", "id", F.round("prediction", 1).alias("prediction"))


@register("stream_upsample", ORACLES["upsample_linear"])
def stream_upsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 + E2 as a stream: daily prices that arrive in three drops, each series' newest price kept over micro-batches."""
    from tempora.sources.sinks import KeyedTable
    from tempora.streaming.live_series import start_upsampling
    from tempora.streaming.sources import run_available

    base = shared_path(spark, "stream_upsample", unique=True)
    daily = S.daily_prices(spark, sf_dir).groupBy("country", F.date_trunc("day", "time").cast("timestamp_ntz").alias("time")).agg(
        F.round(F.avg("price"), 6).alias("price"))
    table = KeyedTable(f"{base}/last", keys=["country"], order=["time"])
    year = F.year("time")
    for k, part in enumerate((year < 1997, (year >= 1997) & (year < 1999), year >= 1999)):
        daily.where(part).write.parquet(f"{base}/drops/{k}")
        stream = spark.readStream.schema(daily.schema).parquet(f"{base}/drops/*")
        run_available(start_upsampling(stream, table, base, f"{base}/_ckpt", "country", "time", "price", step_seconds=S.HOUR_SECONDS,
                                       source_step_seconds=S.DAY_SECONDS, periods=None, available_now=True))
    return spark.read.parquet(f"{base}/points").drop("batch")


@register("live_forecast_error", ORACLES["forecast_error"])
def live_forecast_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 + L9 as a stream-stream join with watermarks: predictions and prices by bucket, errors summed by day."""
    from tempora.operators.aggregates import group_averages
    from tempora.plans.weather_price import price_bucket_averages
    from tempora.sources.sinks import SumTable
    from tempora.streaming.live_series import error_of, start_forecast_error
    from tempora.streaming.sources import run_available

    base = shared_path(spark, "live_forecast_error", unique=True)
    readings = S.readings(spark, sf_dir).withColumn("dt", F.timestamp_seconds(F.col("dt") - F.pmod("dt", F.lit(300))).cast("timestamp_ntz"))
    group_averages(readings, "dt", {"prediction": "value"}).write.parquet(f"{base}/predictions")
    price_bucket_averages(S.price_ticks(spark, sf_dir), time_col="dt", value_col="price", width_seconds=300, time_kind="epoch",
                          drop=["event_id"], out_key="dt").write.parquet(f"{base}/prices")
    streams = [spark.readStream.schema(spark.read.parquet(path).schema).parquet(path) for path in (f"{base}/predictions", f"{base}/prices")]
    errors = SumTable(f"{base}/errors", keys=["day"])
    run_available(start_forecast_error(*streams, errors, f"{base}/unmatched", f"{base}/_ckpt", available_now=True))
    return _round(error_of(errors.read(spark)), ["rmse", "mae"])
