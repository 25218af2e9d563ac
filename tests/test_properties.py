"""Property checks: bucket arithmetic, raw-time lookback equivalence, key-filter pushdown, model reload."""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tempora.functions.timebuckets import bucket_start
from tempora.operators.ml import assemble, fit_linear, save_model
from tempora.operators.views import bucket_lookback_on_raw, lookback
from tempora.sources.sinks import KeyedTable
from tempora.streaming.scoring import ModelCache

EPOCH = dt.datetime(1970, 1, 1)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=-60_000_000_000, max_value=250_000_000_000), min_size=1, max_size=50),
       st.sampled_from([1, 60, 300, 3600, 86400]))
def test_bucket_start_is_python_floor(spark, epochs, width):
    df = spark.createDataFrame([(e,) for e in epochs], "dt bigint")
    got = [r[0] for r in df.select(bucket_start("dt", width)).collect()]
    assert got == [EPOCH + dt.timedelta(seconds=(e // width) * width) for e in epochs]


def test_raw_lookback_keeps_the_same_buckets(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    # Edge-heavy times: exact bucket starts, one microsecond around them, and random ones.
    times = []
    for m in range(0, 24 * 60, 5):
        b = base + dt.timedelta(minutes=m)
        times += [b, b - dt.timedelta(microseconds=1), b + dt.timedelta(microseconds=1)]
    times += [base + dt.timedelta(seconds=rnd.randint(0, 86400)) for _ in range(500)]
    df = spark.createDataFrame([(t, float(i)) for i, t in enumerate(times)], "ts timestamp_ntz, v double")
    for as_of in ["2024-01-01 12:00:00", "2024-01-01 12:02:30", "2024-01-01 11:59:59.999999"]:
        full = df.withColumn("dt", bucket_start(F.unix_seconds(F.col("ts").cast("timestamp")), 300))
        want = sorted(r.v for r in lookback(full, as_of, "9 hours 30 minutes").collect())
        raw = bucket_lookback_on_raw(df, as_of, "9 hours 30 minutes", 300)
        got = sorted(r.v for r in raw.collect())
        assert got == want


def test_keyed_table_key_filter_reaches_the_scan(spark, scratch):
    t = KeyedTable(f"{scratch}/p", keys=["dt", "id"])
    rows = [(dt.datetime(2024, 1, 1, h), 1, float(h)) for h in range(24)]
    t.write_batch(spark.createDataFrame(rows, "dt timestamp_ntz, id int, prediction double"), 0)
    view = lookback(t.read(spark), "2024-01-01 12:00:00", "7 minutes")
    assert [r.prediction for r in view.collect()] == [12.0]
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(dt), GreaterThan(dt," in plan


def test_model_cache_reloads_newer_version(spark, scratch):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(30)], "x double, price double")
    data = assemble(df, ["x"])
    save_model(fit_linear(data, reg_param=0.0), f"{scratch}/models", "v000001")
    cache = ModelCache(spark, f"{scratch}/models")
    first = cache.current()
    assert cache.current() is first  # unchanged folder: no reload
    save_model(fit_linear(data, reg_param=0.0), f"{scratch}/models", "v000002")
    assert cache.current() is not first and cache.path.endswith("v000002")


def test_scale_conf_sizes_partitions():
    from tempora.session import scale_conf

    conf = scale_conf(100 * 1024 ** 4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    assert int(scale_conf(10 ** 6, 64)["spark.sql.shuffle.partitions"]) == 128


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
                min_size=1, max_size=40))
def test_mode_matches_brute_force(spark, rows):
    from collections import Counter

    from tempora.operators.aggregates import mode_per_group

    df = spark.createDataFrame(rows, "g int, c string")
    got = {r.g: (r.m, r.n) for r in mode_per_group(df, "g", "c", "m", "n").collect()}
    want = {}
    for g in {g for g, _ in rows}:
        counts = Counter(c for gg, c in rows if gg == g)
        best = max(counts.values())
        tied = [c for c, n in counts.items() if n == best]
        non_null = sorted(c for c in tied if c is not None)
        want[g] = (non_null[0] if non_null else None, best)
    assert got == want
