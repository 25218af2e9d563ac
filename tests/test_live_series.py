"""Up-sampling and forecast errors as streams: equal to the batch forms over drops, restarts, failures and late rows."""

import datetime as dt
import time

import pytest

from tempora.operators.joins import forecast_error
from tempora.operators.series import previous_row, upsample_pairs
from tempora.sources.sinks import KeyedTable, SumTable
from tempora.streaming import live_series
from tempora.streaming.live_series import error_of, start_forecast_error, start_upsampling
from tempora.streaming.sources import run_available

PRICES = "country string, utc timestamp_ntz, price double"
START = dt.datetime(2024, 1, 1)
STEP = {"step_seconds": 600, "source_step_seconds": 3600, "periods": None}


def hour(k):
    return START + dt.timedelta(hours=k)


def drop(spark, rows, path, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.05)


def points(rows):
    return sorted((r.country, r.point, r.ts, round(r.price, 9), r.gap_seconds) for r in rows.collect())


def batch_points(spark, path):
    pairs = previous_row(spark.read.parquet(path).where("country IS NOT NULL"), ["country"], ["utc"], ["utc", "price"]).where("prev_utc IS NOT NULL")
    return points(upsample_pairs(pairs, "prev_utc", "utc", "prev_price", "price", keep=["country"], **STEP))


def run(spark, scratch, table):
    stream = spark.readStream.schema(PRICES).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    run_available(start_upsampling(stream, table, f"{scratch}/out", f"{scratch}/ckpt", "country", "utc", "price", available_now=True, **STEP))


def test_upsampling_over_drops_equals_batch(spark, scratch, monkeypatch):
    monkeypatch.setattr(live_series, "COMPACT_EVERY", 2)
    table = KeyedTable(f"{scratch}/last", keys=["country"], order=["utc"])
    drops = [[("a", hour(0), 1.0), ("a", hour(1), 2.0), ("b", hour(0), 5.0)], [("a", hour(2), 4.0)],
             [("b", hour(3), 7.0), ("c", hour(1), 0.0), ("a", hour(3), 4.5), ("a", hour(4), 1.0)], [("c", hour(2), 3.0), (None, hour(1), 1.0)],
             [("b", hour(4), 8.0), (None, hour(2), 2.0)]]
    for rows in drops:
        drop(spark, rows, f"{scratch}/in", PRICES)
        run(spark, scratch, table)  # a restart for every drop
    got = points(spark.read.parquet(f"{scratch}/out/points"))
    assert got == batch_points(spark, f"{scratch}/in") and len(got) == 6 * (4 + 2 + 1)
    assert spark.read.parquet(f"{scratch}/out/late").count() == 0
    assert len(table.applied_batches(spark)) < 5


def test_late_prices_and_a_failure_before_the_commit(spark, scratch, monkeypatch):
    table = KeyedTable(f"{scratch}/last", keys=["country"], order=["utc"])
    drop(spark, [("a", hour(0), 1.0), ("a", hour(2), 2.0)], f"{scratch}/in", PRICES)
    run(spark, scratch, table)
    drop(spark, [("a", hour(1), 9.0), ("a", hour(2), 9.0), ("a", hour(3), 3.0), ("a", None, 3.0)], f"{scratch}/in", PRICES)
    write = KeyedTable.write_batch

    def failing(self, df, n):
        write(self, df, n)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(KeyedTable, "write_batch", failing)
    with pytest.raises(Exception, match="lost after the write"):
        run(spark, scratch, table)
    monkeypatch.undo()
    run(spark, scratch, table)
    got = points(spark.read.parquet(f"{scratch}/out/points"))
    assert [(p[2], p[4]) for p in got if p[1] == 0] == [(hour(0), 7200), (hour(2), 3600)] and len(got) == 12
    assert sorted(r.utc for r in spark.read.parquet(f"{scratch}/out/late").collect()) == [hour(1), hour(2)]


def test_forecast_errors_of_two_streams_equal_batch(spark, scratch):
    """Values come before, with and after their predictions; some predictions never meet a value."""
    left, right = "dt timestamp_ntz, prediction double", "dt timestamp_ntz, avg_price double"
    predicted = [[(hour(k), float(k)) for k in range(0, 10)], [(hour(k), k + 0.5) for k in range(10, 30)], [(hour(40), 1.0)], [(hour(50), 1.0)]]
    actual = [[(hour(k), 2.0 * k) for k in range(5, 12)], [(hour(k), 3.0) for k in (0, 13, 20, 29)], [(hour(41), 1.0)], [(hour(50), 4.0)]]
    errors = SumTable(f"{scratch}/errors", keys=["day"])
    for p, a in zip(predicted, actual):
        drop(spark, p, f"{scratch}/p", left)
        drop(spark, a, f"{scratch}/a", right)
        run_available(start_forecast_error(
            spark.readStream.schema(left).parquet(f"{scratch}/p"), spark.readStream.schema(right).parquet(f"{scratch}/a"), errors,
            f"{scratch}/unmatched", f"{scratch}/ckpt", delay="30 hours", available_now=True))
    want = forecast_error(spark.read.parquet(f"{scratch}/p"), spark.read.parquet(f"{scratch}/a")).first()
    got = error_of(errors.read(spark)).first()
    assert got.n == want.n == 12 and abs(got.rmse - want.rmse) < 1e-9 and abs(got.mae - want.mae) < 1e-9
    # What the watermark (20 hours after the start) has passed without a value is reported, once.
    missed = [r.dt for r in spark.read.parquet(f"{scratch}/unmatched").orderBy("dt").collect()]
    assert missed == [hour(k) for k in (1, 2, 3, 4, 12, 14, 15, 16, 17, 18, 19)]
    assert errors.read(spark).count() == 3
