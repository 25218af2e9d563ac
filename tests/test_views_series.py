"""Views (late_rows, Q6), series pairing and up-sampling (hour_gap, Q11, Q13), offsets."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tempora.operators.series import first_offset, previous_row, upsample_pairs
from tempora.operators.views import current_batch_row, current_prediction, latest_row, lookback, rows_at_max

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def test_late_rows_true_latest_and_empty_lookback(spark):
    # The newest row is written last, far beyond any first-n rows.
    rows = [(T0 - dt.timedelta(minutes=m), 1, float(m)) for m in range(3000, 0, -1)]
    rows.append((T0, 2, 99.123))
    df = spark.createDataFrame(rows, "dt timestamp_ntz, id bigint, prediction double")
    got = current_prediction(df, "2024-01-01 12:00:00").collect()
    assert [(r.dt, r.id, r.prediction) for r in got] == [(T0, 2, 99.12)]
    assert current_prediction(df, "2024-01-02 12:00:00").count() == 0  # nothing in the last 7 minutes


def test_lookback_is_strict_and_pushed(spark, scratch):
    rows = [(T0 - dt.timedelta(minutes=7), 1.0), (T0 - dt.timedelta(minutes=6), 2.0), (T0, 3.0)]
    spark.createDataFrame(rows, "dt timestamp_ntz, prediction double").write.parquet(f"{scratch}/p")
    df = spark.read.parquet(f"{scratch}/p")
    view = lookback(df, "2024-01-01 12:00:00", "7 minutes")
    assert sorted(r.prediction for r in view.collect()) == [2.0, 3.0]
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(dt), GreaterThan(dt," in plan


def test_rows_at_max_and_batch_row_celsius(spark):
    rows = [(T0, 280.0, 10.0), (T0, 281.0, 11.0), (T0 - dt.timedelta(hours=1), 300.0, 12.0)]
    df = spark.createDataFrame(rows, "dt timestamp_ntz, avg_temp double, avg_price double")
    assert rows_at_max(df).count() == 2
    one = spark.createDataFrame([(T0, 280.0, 10.004)], "dt timestamp_ntz, avg_temp double, avg_price double")
    r = current_batch_row(one, "2024-01-01 12:00:00").first()
    assert (r.avg_temp, r.avg_price) == (6.85, 10.0)  # 273.15, not 272.15 (Q8)


def test_latest_row_tiebreak(spark):
    df = spark.createDataFrame([(T0, 2), (T0, 1)], "dt timestamp_ntz, id int")
    assert latest_row(df, "dt", ["id"]).first().id == 1


def test_chunked_previous_row_equals_series_window(spark):
    rnd = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(rnd.choice(["BE", "NL"]), base + dt.timedelta(seconds=rnd.randint(0, 40 * 86400)), i, rnd.random())
            for i in range(3000)]
    df = spark.createDataFrame(rows, "country string, time timestamp_ntz, row_id int, price double")
    args = (["country"], ["time", "row_id"], ["row_id", "price"])
    a = previous_row(df, *args, chunk_seconds=86400)
    b = previous_row(df, *args, chunk_seconds=None)
    key = lambda d: sorted((r.row_id, r.prev_row_id, r.prev_price) for r in d.collect())
    assert key(a) == key(b)
    assert a.where(F.col("prev_row_id").isNull()).count() == 2  # one first row per series


def test_hour_gap_upsampling(spark):
    # hour_gap: BE has 00:00, 01:00, 03:00 (02:00 missing); NL has 00:00, 01:00.
    h = lambda x: dt.datetime(2024, 1, 1, x)
    rows = [("BE", h(0), 10.0), ("BE", h(1), 20.0), ("BE", h(3), 40.0), ("NL", h(0), 5.0), ("NL", h(1), 5.0)]
    df = spark.createDataFrame(rows, "country string, time timestamp_ntz, price double")
    pairs = previous_row(df, ["country"], ["time"], ["time", "price"]).where(F.col("prev_time").isNotNull())
    up = upsample_pairs(pairs, "prev_time", "time", "prev_price", "price", keep=["country"])
    assert up.count() == 3 * 720
    first = up.where((F.col("country") == "BE") & (F.col("gap_seconds") == 3600)).orderBy("point").collect()
    assert first[0].price == 10.0 and first[-1].price == 20.0  # endpoint included (Q11)
    assert first[-1].ts == h(0) + dt.timedelta(seconds=3595)
    gap = up.where(F.col("gap_seconds") == 7200).orderBy("point").collect()
    assert len(gap) == 720 and gap[1].ts - gap[0].ts == dt.timedelta(seconds=10)  # stretched over 2 h (Q13)


def test_first_offset_constant_per_series(spark):
    rows = [("BE", dt.datetime(2024, 3, 30, 23), dt.datetime(2024, 3, 31, 0), 1),
            ("BE", dt.datetime(2024, 3, 31, 2), dt.datetime(2024, 3, 31, 4), 2)]
    df = spark.createDataFrame(rows, "c string, utc timestamp_ntz, local timestamp_ntz, k int")
    got = {r.k: r.offset_seconds for r in first_offset(df, ["c"], ["utc", "k"], "utc", "local").collect()}
    assert got == {1: 3600.0, 2: 3600.0}  # taken from the first row only: no daylight-saving switch


def test_first_offset_ties_and_missing_values(spark):
    t = dt.datetime(2024, 3, 30, 23)
    rows = [("BE", t, t + dt.timedelta(hours=2), 2), ("BE", t, t + dt.timedelta(hours=1), 1), ("BE", None, t, 0),
            ("FR", None, t, 3), (None, t, t, 4)]
    df = spark.createDataFrame(rows, "c string, utc timestamp_ntz, local timestamp_ntz, k int")
    got = {r.k: r.offset_seconds for r in first_offset(df, ["c"], ["utc", "k"], "utc", "local").collect()}
    assert got == {0: 3600.0, 1: 3600.0, 2: 3600.0, 3: None, 4: None}
    assert first_offset(df.limit(0), ["c"], ["utc", "k"], "utc", "local").count() == 0


def test_range_chunking_splits_a_hot_instant(spark):
    # One series holds a third of the rows, all at the same instant; range chunks split it.
    hot_t = dt.datetime(2024, 1, 1, 12)
    rows = [("HOT", hot_t, i, float(i)) for i in range(3000)]
    rnd = random.Random(9)
    rows += [(rnd.choice(["A", "B"]), hot_t + dt.timedelta(seconds=rnd.randint(-90000, 90000)), 3000 + i, rnd.random())
             for i in range(6000)]
    df = spark.createDataFrame(rows, "country string, time timestamp_ntz, row_id int, price double")
    args = (["country"], ["time", "row_id"], ["row_id", "price"])
    ranged = previous_row(df, *args, chunking="range", num_chunks=12)
    plain = previous_row(df, *args, chunk_seconds=None)
    key = lambda d: sorted((r.row_id, r.prev_row_id, r.prev_price) for r in d.collect())
    assert key(ranged) == key(plain)
    # The hot instant is spread over several chunks of bounded size.
    sizes = (df.repartitionByRange(12, "country", "time", "row_id").groupBy(F.spark_partition_id().alias("p"))
             .count().collect())
    assert max(r["count"] for r in sizes) <= 2 * 9000 / 12


def test_upsample_rejects_a_step_longer_than_the_source(spark):
    import pytest

    pairs = spark.createDataFrame([(T0, T0, 1.0, 2.0)], "t0 timestamp_ntz, t1 timestamp_ntz, p0 double, p1 double")
    with pytest.raises(ValueError):
        upsample_pairs(pairs, "t0", "t1", "p0", "p1", step_seconds=7200, source_step_seconds=3600)
