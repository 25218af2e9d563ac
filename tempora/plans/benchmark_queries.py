"""The registered queries over the benchmark tables, each with its SQL oracle.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Floating
results that depend on summation order are rounded to 6 places on both sides;
timestamps are ``timestamp_ntz`` (Spark) / ``TIMESTAMP`` (SQL).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.plans import standins as S
from tempora.plans.weather_price import price_bucket_averages, weather_bucket_averages, weather_price_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return wrap


def _round(df: DataFrame, cols, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


# SQL fragments shared by the oracles (DuckDB dialect).
def _sql_bucket(epoch_sql: str, width: int, shift: int = 0) -> str:
    e = f"({epoch_sql} + {shift})" if shift else epoch_sql
    return f"make_timestamp(CAST(floor({e} / {width}) * {width} AS BIGINT) * 1000000)"


_SQL_EPOCH_TS = "CAST(floor(epoch(ts)) AS BIGINT)"
_SQL_K = "CAST(json_extract_string(props, '$.k') AS DOUBLE)"


# ---------------------------------------------------------------------------
# L1 flagship: events averaged per day, joined to orders (shifted) averaged per day.
# ---------------------------------------------------------------------------
def _flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = weather_bucket_averages(
        S.readings(spark, sf_dir), width_seconds=S.DAY_SECONDS,
        averages=S.STANDIN_AVERAGES, drop=["event_type"],
    )
    prices = price_bucket_averages(
        S.daily_prices(spark, sf_dir), time_col="time", value_col="price", width_seconds=S.DAY_SECONDS,
        shift_seconds=S.ORDERS_SHIFT_SECONDS, time_kind="timestamp", drop=["country", "row_id"],
    )
    return weather_price_table(weather, prices)


@register("bucket_join_shifted", f"""
WITH r AS (
  SELECT DISTINCT {_sql_bucket(_SQL_EPOCH_TS, 86400)} AS dt, user_id, event_type, value, {_SQL_K} AS k
  FROM events),
w AS (SELECT dt, avg(value) AS avg_value, avg(k) AS avg_k, avg(user_id) AS avg_user_id FROM r GROUP BY dt),
p AS (SELECT {_sql_bucket("CAST(floor(epoch(o_orderdate)) AS BIGINT)", 86400, 915148800)} AS dt,
             avg(o_totalprice) AS avg_price
      FROM orders GROUP BY 1)
SELECT w.dt, round(avg_value, 6) AS avg_value, round(avg_k, 6) AS avg_k,
       round(avg_user_id, 6) AS avg_user_id, round(avg_price, 6) AS avg_price
FROM w JOIN p ON w.dt = p.dt
""")
def bucket_join_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 (flagship): per-day weather averages (bucket, distinct, average) joined to per-day prices shifted onto the same month."""
    return _round(_flagship(spark, sf_dir), ["avg_value", "avg_k", "avg_user_id", "avg_price"])


# ---------------------------------------------------------------------------
# Shared stand-in tables.
# ---------------------------------------------------------------------------
def _bucketed(spark: SparkSession, sf_dir: str, width: int, dedup: bool) -> DataFrame:
    from tempora.plans.weather_price import bucketed_readings

    return bucketed_readings(S.readings(spark, sf_dir), width_seconds=width, dedup=dedup)


def _sql_readings(width: int, distinct: bool) -> str:
    return (f"SELECT {'DISTINCT ' if distinct else ''}{_sql_bucket(_SQL_EPOCH_TS, width)} AS dt, user_id, event_type, "
            f"value, {_SQL_K} AS k FROM events")


# ---------------------------------------------------------------------------
# 5-minute averages.
# ---------------------------------------------------------------------------
@register("bucket_avg_5min", f"""
WITH b AS ({_sql_readings(300, False)})
SELECT dt, round(avg(value), 6) AS avg_value, round(avg(k), 6) AS avg_k, round(avg(user_id), 6) AS avg_user_id
FROM b GROUP BY dt
""")
def bucket_avg_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages of the readings per 5-minute bucket."""
    from tempora.operators.aggregates import group_averages

    out = group_averages(_bucketed(spark, sf_dir, 300, dedup=False), "dt", S.STANDIN_AVERAGES)
    return _round(out, S.STANDIN_AVERAGES)


# ---------------------------------------------------------------------------
# D2 + H5: hourly averages, two of them truncated to int. ``value`` has two
# decimals and is averaged exactly (same double on every run), so it is not rounded.
# ---------------------------------------------------------------------------
@register("bucket_avg_truncated", f"""
WITH b AS ({_sql_readings(3600, True)})
SELECT dt, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / (CAST(count(value) AS DOUBLE) * 100.0::DOUBLE)
         AS avg_value,
       CAST(trunc(avg(k)) AS INTEGER) AS avg_k, CAST(trunc(avg(user_id)) AS INTEGER) AS avg_user_id
FROM b GROUP BY dt
""")
def bucket_avg_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly averages of distinct readings; two truncated to int, the 2-decimal measure averaged exactly."""
    from tempora.operators.aggregates import group_averages

    return group_averages(_bucketed(spark, sf_dir, 3600, dedup=True), "dt", S.STANDIN_AVERAGES,
                          truncated=["avg_k", "avg_user_id"], exact_scales={"avg_value": 2})


# ---------------------------------------------------------------------------
# D5 after H1: distinct readings per 5-minute bucket.
# ---------------------------------------------------------------------------
@register("dedup_bucketed", _sql_readings(300, True))
def dedup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 after H1: distinct readings per 5-minute bucket."""
    return _bucketed(spark, sf_dir, 300, dedup=True)


# ---------------------------------------------------------------------------
# Count per (hour, category).
# ---------------------------------------------------------------------------
@register("count_by_bucket_category", f"""
WITH b AS ({_sql_readings(3600, False)})
SELECT dt, event_type, count(*) AS "count" FROM b GROUP BY dt, event_type
""")
def count_by_bucket_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per (hour, category)."""
    from tempora.operators.aggregates import count_by

    return count_by(_bucketed(spark, sf_dir, 3600, dedup=False), "dt", "event_type")


# ---------------------------------------------------------------------------
# Hourly modes (event type with its count, and city), ties to the smallest value.
# ---------------------------------------------------------------------------
def _sql_mode(src: str, col: str, alias: str, count_alias: str | None = None) -> str:
    cnt = f", n AS {count_alias}" if count_alias else ""
    return f"""(SELECT dt, {col} AS {alias}{cnt} FROM (
      SELECT dt, {col}, n, row_number() OVER (PARTITION BY dt ORDER BY n DESC, {col} ASC NULLS LAST) AS rn
      FROM (SELECT dt, {col}, count(*) AS n FROM {src} GROUP BY dt, {col})) WHERE rn = 1)"""


@register("mode_by_bucket", f"""
WITH b AS ({_sql_readings(3600, False)})
SELECT m1.dt, mode_event_type, mode_event_type_count, mode_user_id
FROM {_sql_mode('b', 'event_type', 'mode_event_type', 'mode_event_type_count')} m1
JOIN {_sql_mode('b', 'user_id', 'mode_user_id')} m2 ON m1.dt = m2.dt
""")
def mode_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly mode of the category (with its count) and of the city; ties to the smallest value."""
    from tempora.operators.aggregates import mode_per_group
    from tempora.operators.joins import join_all

    b = _bucketed(spark, sf_dir, 3600, dedup=False)
    return join_all([
        mode_per_group(b, "dt", "event_type", "mode_event_type", "mode_event_type_count"),
        mode_per_group(b, "dt", "user_id", "mode_user_id"),
    ])


# ---------------------------------------------------------------------------
# L2: exploration table = three modes + five averages (two truncated) per day, joined to prices.
# ---------------------------------------------------------------------------
EXPLORE_MODES_STANDIN = {"mode_event_type": "event_type", "mode_user_id": "user_id", "mode_k": "k"}
EXPLORE_AVERAGES_STANDIN = {"avg_value": "value", "avg_k": "k", "avg_user_id": "user_id",
                            "avg_k_int": "k", "avg_user_id_int": "user_id"}


def _explore(spark: SparkSession, sf_dir: str, width: int) -> DataFrame:
    from tempora.operators.aggregates import modes_and_averages

    return modes_and_averages(_bucketed(spark, sf_dir, width, dedup=True), "dt", EXPLORE_MODES_STANDIN,
                              EXPLORE_AVERAGES_STANDIN, truncated=["avg_k_int", "avg_user_id_int"])


@register("explore_table", f"""
WITH b AS ({_sql_readings(86400, True)}),
a AS (SELECT dt, round(avg(value), 6) AS avg_value, round(avg(k), 6) AS avg_k, round(avg(user_id), 6) AS avg_user_id,
             CAST(trunc(avg(k)) AS INTEGER) AS avg_k_int, CAST(trunc(avg(user_id)) AS INTEGER) AS avg_user_id_int
      FROM b GROUP BY dt),
p AS (SELECT {_sql_bucket("CAST(floor(epoch(o_orderdate)) AS BIGINT)", 86400, 915148800)} AS dt,
             round(avg(o_totalprice), 6) AS avg_price FROM orders GROUP BY 1)
SELECT a.dt, m1.mode_event_type, m2.mode_user_id, m3.mode_k, avg_value, avg_k, avg_user_id, avg_k_int,
       avg_user_id_int, avg_price
FROM a
JOIN {_sql_mode('b', 'event_type', 'mode_event_type')} m1 ON a.dt = m1.dt
JOIN {_sql_mode('b', 'user_id', 'mode_user_id')} m2 ON a.dt = m2.dt
JOIN {_sql_mode('b', 'k', 'mode_k')} m3 ON a.dt = m3.dt
JOIN p ON a.dt = p.dt
""")
def explore_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2: three modes and five averages per day in one grouping-sets pass, joined to daily prices."""
    from tempora.operators.joins import bucket_join

    prices = price_bucket_averages(
        S.daily_prices(spark, sf_dir), time_col="time", value_col="price", width_seconds=S.DAY_SECONDS,
        shift_seconds=S.ORDERS_SHIFT_SECONDS, time_kind="timestamp", drop=["country", "row_id"],
    )
    out = bucket_join(_explore(spark, sf_dir, S.DAY_SECONDS), prices, "dt", "dt_prices")
    return _round(out, ["avg_value", "avg_k", "avg_user_id", "avg_price"])


# ---------------------------------------------------------------------------
# Live views (L7-L9) over a 5-minute batch view and a raw-time prediction table.
# Batch view: non-purchase events (weather) averaged per 5 minutes, joined to
# purchase events (price ticks) averaged per 5 minutes. Predictions: every event
# is a scored message at its raw time (dt = ts, id = user_id, prediction = value).
# ---------------------------------------------------------------------------
AS_OF = "2024-01-20 12:00:00"


def _live_batch_view(spark: SparkSession, sf_dir: str, lookback: str | None = None) -> DataFrame:
    """The 5-minute batch view; with ``lookback`` only the raw rows of the buckets in
    (AS_OF - lookback, AS_OF] are read (the bound is pushed into the scan)."""
    from tempora.operators.views import bucket_lookback_on_raw

    pre = (lambda ev: bucket_lookback_on_raw(ev, AS_OF, lookback, 300)) if lookback else None
    weather = weather_bucket_averages(S.live_readings(spark, sf_dir, pre), width_seconds=300,
                                      averages=S.STANDIN_AVERAGES, drop=["event_type"])
    prices = price_bucket_averages(S.price_ticks(spark, sf_dir, pre), time_col="dt", value_col="price",
                                   width_seconds=300, time_kind="epoch", drop=["event_id"])
    return weather_price_table(weather, prices)


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = S.table(spark, sf_dir, "events")
    return ev.select(F.col("ts").alias("dt"), F.col("user_id").alias("id"), F.col("value").alias("prediction"))


_SQL_LIVE_VIEW = f"""
w AS (SELECT dt, avg(value) AS avg_value, avg(k) AS avg_k, avg(user_id) AS avg_user_id
      FROM (SELECT DISTINCT {_sql_bucket(_SQL_EPOCH_TS, 300)} AS dt, user_id, event_type, value, {_SQL_K} AS k
            FROM events WHERE event_type <> 'purchase') GROUP BY dt),
p AS (SELECT {_sql_bucket(_SQL_EPOCH_TS, 300)} AS dt, avg(value) AS avg_price
      FROM events WHERE event_type = 'purchase' GROUP BY 1),
v AS (SELECT w.dt, avg_value, avg_k, avg_user_id, avg_price FROM w JOIN p ON w.dt = p.dt)"""


def _sql_lookback(col: str, interval: str) -> str:
    return f"{col} > TIMESTAMP '{AS_OF}' - INTERVAL '{interval}' AND {col} <= TIMESTAMP '{AS_OF}'"


@register("latest_row", f"""
WITH {_SQL_LIVE_VIEW}
SELECT dt, CAST(printf('%.2f', avg_value - 273.15) AS DOUBLE) AS avg_value,
       CAST(printf('%.2f', avg_k) AS DOUBLE) AS avg_k, CAST(printf('%.2f', avg_user_id) AS DOUBLE) AS avg_user_id,
       CAST(printf('%.2f', avg_price) AS DOUBLE) AS avg_price
FROM v WHERE {_sql_lookback('dt', '9 hours 30 minutes')}
ORDER BY dt DESC LIMIT 1
""")
def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 5-minute batch-view row in the 9 h 30 min lookback; Celsius, two places."""
    from tempora.operators.views import current_batch_row

    from tempora.constants import VIEW_LOOKBACK

    view = _live_batch_view(spark, sf_dir, VIEW_LOOKBACK)
    return current_batch_row(view, AS_OF, kelvin_cols=["avg_value"])


@register("latest_prediction", """
SELECT ts AS dt, user_id AS id, CAST(printf('%.2f', value) AS DOUBLE) AS prediction FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL '7 minutes' AND ts <= (SELECT max(ts) FROM events)
ORDER BY ts DESC, user_id ASC LIMIT 1
""")
def latest_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L7 with "now" = the newest prediction time (a scalar subquery, not a literal)."""
    from tempora.operators.views import current_prediction, data_now

    preds = _predictions(spark, sf_dir)
    return current_prediction(preds, data_now(preds))


@register("series_overlay", f"""
WITH {_SQL_LIVE_VIEW}
SELECT 'predicted' AS series, ts AS dt, value AS price FROM events WHERE {_sql_lookback('ts', '9 hours 30 minutes')}
UNION ALL
SELECT 'real' AS series, dt, round(avg_price, 6) AS price FROM v WHERE {_sql_lookback('dt', '9 hours 30 minutes')}
""")
def series_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted and real price series in the lookback on one time axis."""
    from tempora.operators.views import predicted_vs_actual

    from tempora.constants import VIEW_LOOKBACK

    view = _live_batch_view(spark, sf_dir, VIEW_LOOKBACK).withColumn("avg_price", F.round("avg_price", 6))
    return predicted_vs_actual(_predictions(spark, sf_dir), view, AS_OF)


# ---------------------------------------------------------------------------
# Projections (B2-B7, F1), filters.
# ---------------------------------------------------------------------------
@register("renamed_projection", f"""
WITH r AS (
  SELECT DISTINCT {_sql_bucket(_SQL_EPOCH_TS, 86400)} AS dt, user_id, event_type, value, {_SQL_K} AS k
  FROM events),
w AS (SELECT dt, avg(value) AS avg_value, avg(k) AS avg_k, avg(user_id) AS avg_user_id FROM r GROUP BY dt),
p AS (SELECT {_sql_bucket("CAST(floor(epoch(o_orderdate)) AS BIGINT)", 86400, 915148800)} AS dt,
             avg(o_totalprice) AS avg_price
      FROM orders GROUP BY 1)
SELECT w.dt AS "date", round(avg_value, 6) AS "temp", round(avg_k, 6) AS "humidity",
       round(avg_price, 6) AS "energy price"
FROM w JOIN p ON w.dt = p.dt
ORDER BY w.dt
""")
def renamed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renames, drops (missing names ignored) and an aliased projection with spaces, sorted."""
    from tempora.operators.projections import drop_columns, rename_columns, select_aliased

    t = bucket_join_shifted(spark, sf_dir)
    t = rename_columns(t, {"avg_value": "main_temp", "avg_k": "main_humidity", "avg_price": "price"})
    t = drop_columns(t, ["avg_user_id", "no_such_column"])
    return select_aliased(t, {"dt": "date", "main_temp": "temp", "main_humidity": "humidity",
                              "price": "energy price"}, order_by="dt")


@register("sorted_projection", "SELECT ts, value, event_id FROM events ORDER BY ts, event_id")
def sorted_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column subset sorted by time (ties by id)."""
    ev = S.table(spark, sf_dir, "events")
    return ev.select("ts", "value", "event_id").orderBy("ts", "event_id")


COUNTRY = "NATION_2"


@register("country_filter", f"""
SELECT c_custkey, c_name, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name = '{COUNTRY}'
""")
def country_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers (cities) of one nation (country); fails when there is none."""
    from tempora.operators.projections import where_equals

    cities = S.table(spark, sf_dir, "customer").join(
        S.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return where_equals(cities, "n_name", COUNTRY, required=True).select("c_custkey", "c_name", "n_name")


@register("reject_split", """
SELECT event_id, event_type,
       CASE WHEN coalesce(event_type <> 'error', false) THEN 'accepted' ELSE 'rejected' END AS outcome
FROM events
""")
def reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted / rejected label from a status predicate (NULL counts as rejected)."""
    from tempora.operators.projections import tag_split

    ev = S.table(spark, sf_dir, "events").select("event_id", "event_type")
    return tag_split(ev, F.col("event_type") != "error")


# ---------------------------------------------------------------------------
# Scalar functions.
# ---------------------------------------------------------------------------
@register("parse_time", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch, ts AS parsed FROM events
""")
def parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: event times written as text and parsed back (plain or fractional layouts)."""
    from tempora.functions.timebuckets import ACCEPTED_TIME_FORMATS, epoch_seconds, parse_time_text

    ev = S.table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("text"))
    parsed = ev.select("event_id", parse_time_text("text", ACCEPTED_TIME_FORMATS).alias("parsed"))
    return parsed.select("event_id", epoch_seconds("parsed").alias("epoch"), "parsed")


@register("split_coordinates", f"""
SELECT event_id, value AS lat, {_SQL_K} AS lon FROM events
""")
def split_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H7: 'lat,lon' text split into two doubles."""
    from tempora.functions.scalar import split_pair

    ev = S.table(spark, sf_dir, "events")
    text = F.concat_ws(",", F.col("value").cast("string"), F.get_json_object("props", "$.k"))
    lat, lon = split_pair(text)
    return ev.select("event_id", lat.alias("lat"), lon.alias("lon"))


@register("json_flatten", f"""
SELECT {_SQL_EPOCH_TS} AS dt, user_id AS id, value AS main_temp, {_SQL_K} AS main_humidity,
       event_type AS weather_0__main, CAST(200 AS BIGINT) AS cod
FROM events
""")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events encoded as nested weather messages, decoded with a fixed schema and flattened."""
    from tempora.streaming.messages import WEATHER_MESSAGE_SCHEMA, parse_weather_messages, weather_messages_from_events

    msgs = weather_messages_from_events(S.table(spark, sf_dir, "events"))
    flat = parse_weather_messages(msgs, WEATHER_MESSAGE_SCHEMA)
    return flat.select("dt", "id", "main_temp", "main_humidity", "weather_0__main", "cod")


@register("json_encode", f"""
SELECT event_id, CAST(json_object('dt', {_SQL_EPOCH_TS}, 'id', user_id, 'value', value,
                                  'event_type', event_type) AS VARCHAR) AS message
FROM events
""")
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as one JSON message."""
    from tempora.functions.jsonops import encode_json
    from tempora.functions.timebuckets import epoch_seconds

    ev = S.table(spark, sf_dir, "events")
    return ev.select("event_id", encode_json(epoch_seconds("ts").alias("dt"), F.col("user_id").alias("id"),
                                             "value", "event_type").alias("message"))


@register("utc_offset", """
WITH e AS (SELECT event_id, event_type, ts, ts + to_hours(CAST(user_id % 25 - 12 AS BIGINT)) AS local_clock FROM events),
f AS (SELECT event_type, arg_min(epoch_us(local_clock) - epoch_us(ts), (ts, event_id)) AS off_us FROM e GROUP BY event_type)
SELECT event_id, e.event_type, off_us / 1000000 AS offset_seconds,
       make_timestamp(epoch_us(ts) + CAST(off_us / 1000000 AS BIGINT) * 1000000) AS local_ts
FROM e JOIN f ON e.event_type = f.event_type
""")
def utc_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per series, the local-minus-UTC offset of its first row, applied to every row."""
    from tempora.functions.timebuckets import plus_seconds
    from tempora.operators.series import first_offset

    ev = S.table(spark, sf_dir, "events").select(
        "event_id", "event_type", "ts",
        plus_seconds("ts", (F.col("user_id") % 25 - 12) * 3600).alias("local_clock"))
    out = first_offset(ev, ["event_type"], ["ts", "event_id"], "ts", "local_clock")
    return out.select("event_id", "event_type", "offset_seconds",
                      plus_seconds("ts", F.col("offset_seconds")).alias("local_ts"))


@register("kelvin_to_celsius", "SELECT event_id, value - 273.15 AS celsius FROM events")
def kelvin_to_celsius_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H6: Kelvin to Celsius with 273.15."""
    from tempora.functions.scalar import kelvin_to_celsius

    return S.table(spark, sf_dir, "events").select("event_id", kelvin_to_celsius("value").alias("celsius"))


@register("format_two_decimals", """
SELECT event_id, printf('%.2f', value - 273.15) AS celsius_text, printf('%.2f', value) AS value_text FROM events
""")
def format_two_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H12, text form: '%.2f' of a temperature in Celsius and of the raw value."""
    from tempora.functions.scalar import kelvin_to_celsius, two_decimals_text

    ev = S.table(spark, sf_dir, "events")
    return ev.select("event_id", two_decimals_text(kelvin_to_celsius("value")).alias("celsius_text"),
                     two_decimals_text("value").alias("value_text"))


# ---------------------------------------------------------------------------
# Ordered series (E2 + B14, I3 with H15/H16/H17).
# ---------------------------------------------------------------------------
@register("prev_pair", """
SELECT * FROM (
  SELECT o_orderkey AS row_id, o_orderpriority AS country,
         lag(o_orderkey) OVER w AS prev_row_id, lag(o_totalprice) OVER w AS prev_price,
         lag(o_orderdate) OVER w AS prev_time
  FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey))
WHERE prev_row_id IS NOT NULL
""")
def prev_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with its predecessor in its priority series; first rows dropped."""
    from tempora.operators.series import previous_row

    p = S.daily_prices(spark, sf_dir)
    # Range chunks of the full sort key: a hot country or a hot day is split evenly.
    out = previous_row(p, ["country"], ["time", "row_id"], ["row_id", "price", "time"], chunking="range")
    return out.where(F.col("prev_row_id").isNotNull()).select("row_id", "country", "prev_row_id", "prev_price",
                                                              "prev_time")


def _daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.functions.timebuckets import ts_bucket_start

    p = S.daily_prices(spark, sf_dir)
    return p.groupBy("country", ts_bucket_start("time", S.DAY_SECONDS).alias("time")).agg(
        F.round(F.avg("price"), 6).alias("price"))


def _upsample(spark: SparkSession, sf_dir: str, sigma: float) -> DataFrame:
    from tempora.operators.series import previous_row, upsample_pairs

    pairs = previous_row(_daily_series(spark, sf_dir), ["country"], ["time"], ["time", "price"],
                         chunk_seconds=30 * S.DAY_SECONDS).where(F.col("prev_time").isNotNull())
    # One day between source points, one hour between generated points: 24 per pair.
    return upsample_pairs(pairs, "prev_time", "time", "prev_price", "price", step_seconds=S.HOUR_SECONDS,
                          source_step_seconds=S.DAY_SECONDS, periods=None, noise_sigma=sigma, keep=["country"])


@register("upsample_linear", f"""
WITH d AS (SELECT o_orderpriority AS country, {_sql_bucket("CAST(floor(epoch(o_orderdate)) AS BIGINT)", 86400)} AS time,
                  round(avg(o_totalprice), 6) AS price
           FROM orders GROUP BY 1, 2),
p AS (SELECT country, lag(time) OVER w AS t0, time AS t1, lag(price) OVER w AS p0, price AS p1
      FROM d WINDOW w AS (PARTITION BY country ORDER BY time)),
g AS (SELECT country, t0, t1, p0, p1, unnest(range(0, 24)) AS point FROM p WHERE t0 IS NOT NULL)
SELECT country, CAST(point AS INTEGER) AS point,
       make_timestamp(epoch_us(t0) + ((epoch_us(t1) - epoch_us(t0)) * point) // 24) AS ts,
       p0 + (p1 - p0) * point / 23.0 AS price,
       CAST(epoch(t1) - epoch(t0) AS BIGINT) AS gap_seconds
FROM g
""")
def upsample_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily price series up-sampled to 24 hourly points per pair, without noise."""
    return _upsample(spark, sf_dir, 0.0)


@register("upsample_noise")
def upsample_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 with N(0, 1) noise (seeded); stochastic, so checked by row count and by residual spread."""
    return _upsample(spark, sf_dir, 1.0)


# ---------------------------------------------------------------------------
# Profiles (D7-D10) over the per-hour exploration table and the joined daily table.
# ---------------------------------------------------------------------------
def _hourly_explore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _explore(spark, sf_dir, S.HOUR_SECONDS).withColumn("avg_value", F.round("avg_value", 6))


_SQL_HOURLY = f"""
b AS ({_sql_readings(3600, True)}),
a AS (SELECT dt, round(avg(value), 6) AS avg_value FROM b GROUP BY dt),
h AS (SELECT a.dt, m.mode_event_type, a.avg_value FROM a JOIN {_sql_mode('b', 'event_type', 'mode_event_type')} m
      ON a.dt = m.dt)"""


@register("hist_categorical", f"""
WITH {_SQL_HOURLY}
SELECT mode_event_type, count(*) AS "count" FROM h GROUP BY mode_event_type
""")
def hist_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of the hourly mode category."""
    from tempora.operators.profile import categorical_histogram

    return categorical_histogram(_hourly_explore(spark, sf_dir), "mode_event_type")


@register("hist_numeric", f"""
WITH {_SQL_HOURLY},
s AS (SELECT count(avg_value) AS n, min(avg_value) AS lo, max(avg_value) AS hi,
             quantile_cont(avg_value, 0.25) AS q1, quantile_cont(avg_value, 0.75) AS q3 FROM h),
k AS (SELECT lo, hi, CAST(ceil((hi - lo) / (CASE WHEN 2.0 * (q3 - q1) * pow(n, -1.0 / 3.0) > 0
                                            THEN least(2.0 * (q3 - q1) * pow(n, -1.0 / 3.0), (hi - lo) / (log2(n) + 1.0))
                                            ELSE (hi - lo) / (log2(n) + 1.0) END)) AS INTEGER) AS nb FROM s),
w AS (SELECT lo, nb, (hi - lo) / nb AS width FROM k),
c AS (SELECT CAST(least(floor((avg_value - (SELECT lo FROM w)) / (SELECT width FROM w)), (SELECT nb FROM w) - 1)
                  AS INTEGER) AS bin, count(*) AS "count"
      FROM h GROUP BY 1)
SELECT bin, (SELECT lo FROM w) + bin * (SELECT width FROM w) AS bin_lo,
       (SELECT lo FROM w) + (bin + 1) * (SELECT width FROM w) AS bin_hi, "count"
FROM c
""")
def hist_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Histogram of hourly average values, bin count by the automatic rule."""
    from tempora.operators.profile import numeric_histogram

    return numeric_histogram(_hourly_explore(spark, sf_dir), "avg_value", bins="auto")


@register("box_stats", f"""
WITH {_SQL_HOURLY},
q AS (SELECT mode_event_type, count(*) AS n, quantile_cont(avg_value, 0.25) AS q1,
             quantile_cont(avg_value, 0.5) AS median, quantile_cont(avg_value, 0.75) AS q3
      FROM h GROUP BY mode_event_type),
f AS (SELECT q.mode_event_type,
             min(CASE WHEN avg_value >= q1 - 1.5 * (q3 - q1) THEN avg_value END) AS whisker_lo,
             max(CASE WHEN avg_value <= q3 + 1.5 * (q3 - q1) THEN avg_value END) AS whisker_hi,
             count(CASE WHEN avg_value < q1 - 1.5 * (q3 - q1) OR avg_value > q3 + 1.5 * (q3 - q1) THEN 1 END)
               AS n_outliers
      FROM h JOIN q ON h.mode_event_type = q.mode_event_type GROUP BY q.mode_event_type)
SELECT q.mode_event_type, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(q3 - q1, 6) AS iqr, whisker_lo, whisker_hi, n_outliers
FROM q JOIN f ON q.mode_event_type = f.mode_event_type
""")
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box statistics of hourly average values per hourly mode category."""
    from tempora.operators.profile import box_stats as box

    out = box(_hourly_explore(spark, sf_dir), "mode_event_type", "avg_value")
    return _round(out, ["q1", "median", "q3", "iqr"])


@register("pair_stats", f"""
WITH r AS (
  SELECT DISTINCT {_sql_bucket(_SQL_EPOCH_TS, 86400)} AS dt, user_id, event_type, value, {_SQL_K} AS k
  FROM events),
w AS (SELECT dt, round(avg(value), 6) AS avg_value FROM r GROUP BY dt),
p AS (SELECT {_sql_bucket("CAST(floor(epoch(o_orderdate)) AS BIGINT)", 86400, 915148800)} AS dt,
             round(avg(o_totalprice), 6) AS avg_price
      FROM orders GROUP BY 1),
j AS (SELECT avg_value - 273.15 AS x, avg_price AS y FROM w JOIN p ON w.dt = p.dt)
SELECT count(*) AS n, round(corr(y, x), 6) AS corr, round(regr_slope(y, x), 3) AS slope,
       round(regr_intercept(y, x), 1) AS intercept, round(regr_r2(y, x), 6) AS r2
FROM j
""")
def pair_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation and least-squares line of daily price against temperature in Celsius."""
    from tempora.functions.scalar import kelvin_to_celsius
    from tempora.operators.profile import pair_stats as pairs

    t = bucket_join_shifted(spark, sf_dir).select(kelvin_to_celsius("avg_value").alias("x"),
                                                  F.col("avg_price").alias("y"))
    out = pairs(t, "x", "y")
    return out.select("n", F.round("corr", 6).alias("corr"), F.round("slope", 3).alias("slope"),
                      F.round("intercept", 1).alias("intercept"), F.round("r2", 6).alias("r2"))


# ---------------------------------------------------------------------------
# Split and models.
# ---------------------------------------------------------------------------
@register("hash_split", """
SELECT event_id,
       CASE WHEN ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 70
            THEN 'train' ELSE 'test' END AS split
FROM events
""")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reproducible 70/30 train / test label from md5 of the key."""
    from tempora.operators.ml import hash_split_label

    return S.table(spark, sf_dir, "events").select("event_id", hash_split_label(["event_id"]).alias("split"))


_FEATURES_STANDIN = ["avg_value", "avg_k", "avg_user_id"]


@register("ols_fit", f"""
WITH r AS (
  SELECT DISTINCT {_sql_bucket(_SQL_EPOCH_TS, 86400)} AS dt, user_id, event_type, value, {_SQL_K} AS k
  FROM events),
w AS (SELECT dt, round(avg(value), 6) AS avg_value FROM r GROUP BY dt),
p AS (SELECT {_sql_bucket("CAST(floor(epoch(o_orderdate)) AS BIGINT)", 86400, 915148800)} AS dt,
             round(avg(o_totalprice), 6) AS avg_price
      FROM orders GROUP BY 1)
SELECT round(regr_slope(avg_price, avg_value), 3) AS slope, round(regr_intercept(avg_price, avg_value), 1) AS intercept,
       round(regr_r2(avg_price, avg_value), 6) AS r2
FROM w JOIN p ON w.dt = p.dt
""")
def ols_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 + J3 without penalty (one feature): MLlib's least-squares fit equals SQL regr_*."""
    from tempora.operators.ml import assemble, fit_linear

    data = assemble(bucket_join_shifted(spark, sf_dir), ["avg_value"])
    model = fit_linear(data, label="avg_price", reg_param=0.0, elastic_net=0.0)
    row = (float(model.coefficients[0]), float(model.intercept), float(model.summary.r2))
    out = spark.createDataFrame([row], "slope double, intercept double, r2 double")
    return out.select(F.round("slope", 3).alias("slope"), F.round("intercept", 1).alias("intercept"),
                      F.round("r2", 6).alias("r2"))


@register("elastic_net_fit")
def elastic_net_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1, J3-J5 with the original parameters: coefficients, intercept, iterations, history, RMSE, r^2."""
    from tempora.operators.ml import assemble, fit_linear, model_summary

    data = assemble(bucket_join_shifted(spark, sf_dir), _FEATURES_STANDIN)
    return model_summary(spark, fit_linear(data, label="avg_price"))


@register("elastic_net_eval")
def elastic_net_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """70/30 split by key hash, fit on train, RMSE / MAE / r^2 on test."""
    from tempora.operators.ml import assemble, evaluate, fit_linear, hash_split as split

    data = assemble(bucket_join_shifted(spark, sf_dir), _FEATURES_STANDIN)
    train, test = split(data, ["dt"])
    return evaluate(fit_linear(train, label="avg_price"), test)


@register("save_load_predict")
def save_load_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save to a new version folder in the shared folder, load, predict every row."""
    from tempora.operators.ml import assemble, fit_linear, load_model, predict, save_model
    from tempora.session import shared_path

    data = assemble(bucket_join_shifted(spark, sf_dir), _FEATURES_STANDIN)
    path = save_model(fit_linear(data, label="avg_price"), shared_path(spark, "models", unique=True), "v000001")
    return predict(load_model(path), data).select("dt", "avg_price", "prediction")


# ---------------------------------------------------------------------------
# City list from a ';' CSV (A3, B13, H7, G1, B9). The CSV is written from
# customer x nation into the shared folder, then read back like the original file.
# ---------------------------------------------------------------------------
@register("city_list", f"""
SELECT c_custkey AS "Geoname ID", c_name AS "Name", c_acctbal AS lat, CAST(c_nationkey AS DOUBLE) AS lon
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = '{COUNTRY}'
""")
def city_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The city list of one country read from a ';' CSV, coordinates split."""
    from tempora.plans.cities import country_cities, write_city_csv
    from tempora.session import shared_path

    path = shared_path(spark, "city_csv", unique=True)
    write_city_csv(S.table(spark, sf_dir, "customer"), S.table(spark, sf_dir, "nation"), path)
    return country_cities(spark, path, COUNTRY).select("Geoname ID", "Name", "lat", "lon")


# ---------------------------------------------------------------------------
# Streaming (X1, A10 + A5/A7/A11, I1/I2). Each query runs its stream to the end of
# the available input (availableNow), with checkpoints and sinks in the shared
# folder, and returns the sink's content.
# ---------------------------------------------------------------------------
_BOUNDED = {"maxBytesPerTrigger": str(64 << 30)}  # of a micro-batch, at the throughput of a large cluster


@register("stream_bucket_avg", f"""
WITH b AS ({_sql_readings(300, True)}),
a AS (SELECT dt, round(avg(value), 6) AS avg_value, round(avg(k), 6) AS avg_k, round(avg(user_id), 6) AS avg_user_id
      FROM b GROUP BY dt)
SELECT * FROM a
""")
def stream_bucket_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """5-minute averages kept by a stream as partial sums, every bucket of all distinct rows."""
    from tempora.session import shared_path
    from tempora.sources.sinks import SumTable
    from tempora.streaming.bucket_stream import averages_of, start_bucket_averages
    from tempora.streaming.sources import run_available

    base = shared_path(spark, "stream_bucket_avg", unique=True)
    stream = S.events_to_readings(S.events_stream(spark, sf_dir))
    table = SumTable(f"{base}/table", keys=["dt"])
    run_available(start_bucket_averages(stream, S.STANDIN_AVERAGES, table, f"{base}/_ckpt", width_seconds=300, available_now=True))
    return _round(averages_of(table.read(spark), "dt", S.STANDIN_AVERAGES), S.STANDIN_AVERAGES)


@register("stream_distinct", _sql_readings(300, True))
def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 on a stream with bounded state: the readings that it kept, and those that came too late for it."""
    from tempora.session import shared_path
    from tempora.streaming.bucket_stream import late_rows, start_distinct
    from tempora.streaming.sources import run_available

    base = shared_path(spark, "stream_distinct", unique=True)
    stream = S.events_to_readings(S.events_stream(spark, sf_dir))
    run_available(start_distinct(stream, f"{base}/kept", f"{base}/_ckpt", width_seconds=300, delay="2 hours", available_now=True))
    kept = spark.read.parquet(f"{base}/kept").drop("stream", "batch")
    return kept.unionByName(late_rows(S.readings(spark, sf_dir), kept, width_seconds=300))


def _publish_events(spark: SparkSession, sf_dir: str) -> str:
    """The events as weather messages, one JSON per line, a file per input partition."""
    from tempora.session import shared_path
    from tempora.sources.sinks import publish_json
    from tempora.streaming.messages import weather_messages_from_events

    path = shared_path(spark, "topic_weather", unique=True)
    publish_json(weather_messages_from_events(S.table(spark, sf_dir, "events")), path)
    return path


@register("stream_upsert", f"""
SELECT id, dt, main_temp FROM (
  SELECT user_id AS id, {_SQL_EPOCH_TS} AS dt, value AS main_temp,
         row_number() OVER (PARTITION BY user_id ORDER BY {_SQL_EPOCH_TS} DESC, value DESC) AS rn
  FROM events) WHERE rn = 1
""")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10 + A5/A7: messages in micro-batches of bounded size, upserted on ``id`` (newest ``dt`` wins)."""
    from tempora.session import shared_path
    from tempora.sources.sinks import KeyedTable
    from tempora.streaming.messages import parse_weather_messages
    from tempora.streaming.sources import message_stream, run_available

    topic = _publish_events(spark, sf_dir)
    base = shared_path(spark, "stream_upsert", unique=True)
    table = KeyedTable(f"{base}/table", keys=["id"], order=["dt", "main_temp"])
    parsed = parse_weather_messages(message_stream(spark, topic, options=_BOUNDED))
    q = (parsed.select("id", "dt", "main_temp").writeStream
         .foreachBatch(table.upsert_stream_batch).option("checkpointLocation", f"{base}/_ckpt")
         .trigger(availableNow=True).start())
    run_available(q)
    return table.read(spark).select("id", "dt", "main_temp")


@register("stream_scoring")
def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the daily table, then score every message with the newest saved model,
    upserting predictions on (dt, id); malformed / incomplete messages go to a reject table."""
    from tempora.operators.ml import assemble, fit_linear, save_model
    from tempora.operators.projections import rename_columns
    from tempora.session import shared_path
    from tempora.sources.sinks import KeyedTable
    from tempora.streaming.scoring import start_scoring
    from tempora.streaming.sources import message_stream, run_available

    features = ["main_temp", "main_humidity"]
    base = shared_path(spark, "stream_scoring", unique=True)
    train = rename_columns(bucket_join_shifted(spark, sf_dir),
                           {"avg_value": "main_temp", "avg_k": "main_humidity", "avg_price": "price"})
    save_model(fit_linear(assemble(train, features)), f"{base}/models", "v000001")
    preds = KeyedTable(f"{base}/predictions", keys=["dt", "id"])
    q = start_scoring(spark, message_stream(spark, _publish_events(spark, sf_dir), options=_BOUNDED),
                      f"{base}/models", preds, f"{base}/rejects", f"{base}/_ckpt", features=features,
                      available_now=True)
    run_available(q)
    return preds.read(spark).select("dt", "id", "prediction")


# ---------------------------------------------------------------------------
# SQL mode aggregate (NULLs ignored, smallest on ties); X2 / X3 extensions.
# ---------------------------------------------------------------------------
@register("mode_aggregate_daily", f"""
WITH b AS ({_sql_readings(86400, False)})
SELECT dt, event_type AS mode_event_type FROM (
  SELECT dt, event_type, row_number() OVER (PARTITION BY dt ORDER BY n DESC, event_type ASC) AS rn
  FROM (SELECT dt, event_type, count(*) AS n FROM b WHERE event_type IS NOT NULL GROUP BY dt, event_type))
WHERE rn = 1
""")
def mode_aggregate_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL mode() of the category per day (NULLs ignored, smallest on ties)."""
    from tempora.operators.aggregates import mode_aggregate

    return mode_aggregate(_bucketed(spark, sf_dir, S.DAY_SECONDS, dedup=False), "dt", "event_type", "mode_event_type")


@register("forecast_error", f"""
WITH pr AS (SELECT {_sql_bucket(_SQL_EPOCH_TS, 300)} AS dt, avg(value) AS prediction FROM events GROUP BY 1),
re AS (SELECT {_sql_bucket(_SQL_EPOCH_TS, 300)} AS dt, avg(value) AS avg_price
       FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT count(*) AS n, round(sqrt(avg((prediction - avg_price) * (prediction - avg_price))), 6) AS rmse,
       round(avg(abs(prediction - avg_price)), 6) AS mae
FROM pr JOIN re ON pr.dt = re.dt
""")
def forecast_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X3 (extension): predictions averaged per 5-minute bucket against the real bucket price."""
    from tempora.functions.timebuckets import ts_bucket_start
    from tempora.operators.joins import forecast_error as error

    preds = _predictions(spark, sf_dir).groupBy(ts_bucket_start("dt", 300).alias("dt")).agg(
        F.avg("prediction").alias("prediction"))
    real = price_bucket_averages(S.price_ticks(spark, sf_dir), time_col="dt", value_col="price", width_seconds=300,
                                 time_kind="epoch", drop=["event_id"], out_key="dt")
    return _round(error(preds, real), ["rmse", "mae"])


@register("score_buckets")
def score_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X2 (extension): the model scored on 5-minute bucket averages (what it was trained on)."""
    from tempora.operators.ml import assemble, fit_linear
    from tempora.streaming.bucket_stream import score_bucket_averages

    features = ["avg_value", "avg_k"]
    model = fit_linear(assemble(bucket_join_shifted(spark, sf_dir), features), label="avg_price")
    return score_bucket_averages(bucket_avg_5min(spark, sf_dir), model, features)


@register("hist_numeric_fixed", f"""
WITH {_SQL_HOURLY},
s AS (SELECT min(avg_value) AS lo, max(avg_value) AS hi FROM h),
w AS (SELECT lo, (hi - lo) / 12 AS width FROM s),
c AS (SELECT CAST(least(floor((avg_value - (SELECT lo FROM w)) / (SELECT width FROM w)), 11) AS INTEGER) AS bin,
             count(*) AS "count"
      FROM h GROUP BY 1)
SELECT bin, (SELECT lo FROM w) + bin * (SELECT width FROM w) AS bin_lo,
       (SELECT lo FROM w) + (bin + 1) * (SELECT width FROM w) AS bin_hi, "count"
FROM c
""")
def hist_numeric_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 with a given bin count (12 equal-width bins over [min, max])."""
    from tempora.operators.profile import numeric_histogram

    return numeric_histogram(_hourly_explore(spark, sf_dir), "avg_value", bins=12)


@register("latest_rows", """
SELECT event_id, ts, user_id, value FROM events WHERE ts = (SELECT max(ts) FROM events)
""")
def latest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row at the newest time (an aggregate and a semi-join, no global sort)."""
    from tempora.operators.views import rows_at_max

    ev = S.table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    return rows_at_max(ev, "ts")


@register("drop_name_parse", """
SELECT event_id, strftime(ts, '%Y-%m-%d-%H-%M-%S') || CAST(event_id AS VARCHAR) AS name,
       date_trunc('second', ts) AS name_time
FROM events
""")
def drop_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H8: drop names "<yyyy-MM-dd-HH-mm-ss><suffix>" built from event times; the first 19
    characters are parsed back (the suffix is ignored, as the newest-drop reader does)."""
    from tempora.functions.timebuckets import drop_name_time

    ev = S.table(spark, sf_dir, "events")
    named = ev.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd-HH-mm-ss"),
                                           F.col("event_id").cast("string")).alias("name"))
    return named.select("event_id", "name", drop_name_time("name").alias("name_time"))


# ---------------------------------------------------------------------------
# I3 + H13 + A11: the price-replay job on a history derived from orders (one row per
# priority and day; local time = UTC + the priority's digit in hours), replayed for
# one country at 1-hour steps, published as JSON messages and decoded again.
# ---------------------------------------------------------------------------
REPLAY_COUNTRY = "1-URGENT"


def _price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.constants import PRICE_MESSAGE_KEYS as K
    from tempora.functions.timebuckets import plus_seconds

    daily = _daily_series(spark, sf_dir)
    hours = F.substring("country", 1, 1).cast("int")
    return daily.select(
        F.col("country").alias(K[0]),
        F.concat(F.lit("P"), F.substring("country", 1, 1)).alias(K[1]),
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias(K[2]),
        F.date_format(plus_seconds("time", hours * 3600), "yyyy-MM-dd HH:mm:ss").alias(K[3]),
        F.col("price").alias(K[4]),
    )


@register("price_replay", f"""
WITH d AS (SELECT o_orderpriority AS country, {_sql_bucket("CAST(floor(epoch(o_orderdate)) AS BIGINT)", 86400)} AS time,
                  round(avg(o_totalprice), 6) AS price
           FROM orders GROUP BY 1, 2),
c AS (SELECT * FROM d WHERE country = '{REPLAY_COUNTRY}'),
p AS (SELECT country, lag(time) OVER w AS t0, time AS t1, lag(price) OVER w AS p0, price AS p1
      FROM c WINDOW w AS (ORDER BY time)),
g AS (SELECT country, t0, t1, p0, p1, unnest(range(0, 24)) AS point FROM p WHERE t0 IS NOT NULL),
x AS (SELECT country, make_timestamp(epoch_us(t0) + ((epoch_us(t1) - epoch_us(t0)) * point) // 24) AS ts,
             p0 + (p1 - p0) * point / 23.0 AS price FROM g)
SELECT country AS "Country", 'P' || substr(country, 1, 1) AS "ISO3_Code",
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS "Datetime__UTC_",
       strftime(ts + to_hours(CAST(substr(country, 1, 1) AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS "Datetime__Local_",
       price AS "Price__EUR_MWhe_"
FROM x
""")
def price_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I3 as one job: history -> one country (B9) -> first-row UTC offset (H13) -> pairs
    -> 24 points per daily pair (H15/H16) -> JSON messages (A11) -> decoded (H9/H10)."""
    from tempora.plans.price_replay import replay_messages
    from tempora.streaming.messages import parse_price_messages

    msgs = replay_messages(_price_history(spark, sf_dir), REPLAY_COUNTRY, step_seconds=S.HOUR_SECONDS,
                           source_step_seconds=S.DAY_SECONDS, periods=None, noise_sigma=0.0)
    return parse_price_messages(msgs)


# ---------------------------------------------------------------------------
# A5 + A7 by a subscription with acknowledgement.
# ---------------------------------------------------------------------------
@register("subscription_upsert", ORACLES["stream_upsert"])
def subscription_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + A7 + A10: messages pulled from a queue, upserted on ``id`` (newest ``dt`` wins), acknowledged after the write."""
    from tempora.session import shared_path
    from tempora.sources.sinks import KeyedTable
    from tempora.streaming.messages import parse_weather_messages, weather_messages_from_events
    from tempora.streaming.subscription import publish, run_until_empty, subscribe

    base = shared_path(spark, "subscription_upsert", unique=True)
    publish(weather_messages_from_events(S.table(spark, sf_dir, "events")), f"{base}/queue")
    table = KeyedTable(f"{base}/table", keys=["id"], order=["dt", "main_temp"])
    parsed = parse_weather_messages(subscribe(spark, f"{base}/queue")).select("id", "dt", "main_temp")
    writer = (parsed.writeStream.foreachBatch(table.upsert_stream_batch).option("checkpointLocation", f"{base}/_ckpt")
              .trigger(availableNow=True))
    run_until_empty(writer.start)
    return table.read(spark).select("id", "dt", "main_temp")


# ---------------------------------------------------------------------------
# H9 / H10 without a fixed schema.
# ---------------------------------------------------------------------------
@register("flatten_any", f"""
SELECT {_SQL_EPOCH_TS} AS dt, user_id AS id, value AS main_temp,
       CASE WHEN event_type = 'purchase' THEN round(value / 2, 4) END AS "main_only_purchases__EUR_",
       {_SQL_K} AS props_k, event_type AS extra_deep_event_type,
       CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE event_type END AS mixed
FROM events
""")
def flatten_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H9 / H10 for messages whose keys nobody has listed: every key that occurs is a column."""
    from tempora.functions.anyjson import flatten_any as flatten
    from tempora.functions.jsonops import encode_json
    from tempora.functions.timebuckets import epoch_seconds

    only = F.when(F.col("event_type") == "purchase", F.round(F.col("value") / 2, 4)).alias("only purchases (EUR)")
    head = encode_json(
        epoch_seconds("ts").alias("dt"), F.col("user_id").alias("id"), F.struct(F.col("value").alias("temp"), only).alias("main"),
        F.struct(F.struct("event_type").alias("deep")).alias("extra"))
    # Raw parts: the event's own object, and a key that is a number here and a text there.
    mixed = F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.concat(F.lit('"'), "event_type", F.lit('"')))
    value = F.concat(F.expr("substring(h, 1, length(h) - 1)"), F.lit(', "props": '), "props", F.lit(', "mixed": '), "m", F.lit("}"))
    messages = S.table(spark, sf_dir, "events").select(head.alias("h"), "props", mixed.alias("m")).select(value.alias("value"))
    out = flatten(messages).drop("_malformed")
    return out.withColumn("props_k", F.col("props_k").cast("double"))


# ---------------------------------------------------------------------------
# Exact quantiles in bounded memory.
# ---------------------------------------------------------------------------
@register("exact_quantiles", """
SELECT event_type, count(value) AS n, round(quantile_cont(value, 0.01), 6) AS p01, round(quantile_cont(value, 0.25), 6) AS q1,
       round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3,
       round(quantile_cont(value, 0.999), 6) AS p999
FROM events GROUP BY event_type
""")
def exact_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of the raw values per category, by range refinement."""
    from tempora.operators.quantiles import group_quantiles

    out = group_quantiles(S.table(spark, sf_dir, "events"), "value", [0.01, 0.25, 0.5, 0.75, 0.999], by=["event_type"])
    names = ["p01", "q1", "median", "q3", "p999"]
    return out.select("event_type", "n", *[F.round(F.col("quantiles")[i], 6).alias(c) for i, c in enumerate(names)])


# ---------------------------------------------------------------------------
# J3 / L4 from second moments, and the elastic net's closed form.
# ---------------------------------------------------------------------------
def _net_sql(source: str, x: str, y: str, reg: float = 0.3, mixing: float = 0.8) -> str:
    """One feature: with both scaled, w = sign(r) * max(|r| - l1, 0) / (1 + l2)."""
    return f"""
WITH t AS ({source}),
s AS (SELECT corr({y}, {x}) AS r, stddev_pop({x}) AS sx, stddev_pop({y}) AS sy, avg({x}) AS mx, avg({y}) AS my, count(*) AS n
      FROM t WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
w AS (SELECT *, sign(r) * greatest(abs(r) - {mixing} * {reg} / sy, 0) / (1 + {1 - mixing} * {reg} / sy) * sy / sx AS slope FROM s)
SELECT round(slope, 3) AS slope, round(my - slope * mx, 3) AS intercept, n FROM w
"""


_SQL_FLAGSHIP = ORACLES["bucket_join_shifted"]


@register("elastic_net_closed_form", _net_sql(_SQL_FLAGSHIP, "avg_value", "avg_price"))
def elastic_net_closed_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 with the original penalty on one feature, by MLlib."""
    from tempora.operators.ml import assemble, fit_linear

    model = fit_linear(assemble(bucket_join_shifted(spark, sf_dir), ["avg_value"]), label="avg_price")
    row = (round(float(model.coefficients[0]), 3), round(float(model.intercept), 3), int(model.summary.numInstances))
    return spark.createDataFrame([row], "slope double, intercept double, n bigint")


@register("retrain_from_moments", _net_sql("SELECT value, json_extract_string(props, '$.k')::DOUBLE AS k FROM events", "k", "value"))
def retrain_from_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 + L4 on raw readings: a row of second moments a day in a keyed table, refreshed in two parts, the fit from that table."""
    from tempora.operators.moments import combine_moments, elastic_net, refresh_moments
    from tempora.session import shared_path
    from tempora.sources.sinks import KeyedTable

    table = KeyedTable(shared_path(spark, "moments", unique=True), keys=["day"])
    readings = S.readings(spark, sf_dir)
    day = F.to_date(F.timestamp_seconds("dt"))
    early = F.dayofmonth(day) <= 15
    for part in (early, ~early):  # the second refresh reads its own days only
        refresh_moments(readings.where(part), day, ["k", "value"], table)
    m = combine_moments(table.read(spark), ["k", "value"])
    fit = elastic_net(m, "value")
    row = (round(float(fit.coefficients[0]), 3), round(fit.intercept, 3), m.n)
    return spark.createDataFrame([row], "slope double, intercept double, n bigint")
