"""Jobs on reference-shaped inputs (L3, L4, L5, A12) and batch = stream."""

import datetime as dt
import json
import time

import pytest

from tempora.plans.jobs import refresh_batch_view, retrain, train_test_report
from tempora.plans.weather_price import weather_bucket_averages
from tempora.sources.files import read_newest_drop
from tempora.sources.sinks import KeyedTable, SumTable, publish_json
from tempora.streaming.bucket_stream import averages_of, start_bucket_averages
from tempora.streaming.landing import start_landing
from tempora.streaming.scoring import start_scoring
from tempora.streaming.sources import message_stream, run_available

WEATHER_COLS = ("dt bigint, id bigint, name string, cod bigint, main_temp double, main_feels_like double, "
                "main_pressure bigint, main_humidity bigint, visibility bigint, wind_speed double, wind_deg bigint, "
                "clouds_all bigint, weather_0__main string")
PRICE_COLS = "Country string, ISO3_Code string, Datetime__UTC_ string, Datetime__Local_ string, Price__EUR_MWhe_ double"


def _weather_rows(n_buckets=40, cities=3, base=1671253800):
    rows = []
    for b in range(n_buckets):
        for c in range(cities):
            t = base + b * 300 + 17 * c
            rows.append((t, 100 + c, f"c{c}", 200, 270.0 + b % 9 + c, 268.0 + b % 5, 1000 + b % 20, 60 + c,
                         10000 - 10 * b, 2.0 + c / 10, 180 + b, 40 + b % 50, "Clouds"))
        # an exact copy of city 0's reading in this bucket (collapses, Q2)
        rows.append(rows[-cities])
    return rows


def _price_rows(n_buckets=40, base=1671253800):
    import datetime as dt

    out = []
    for b in range(n_buckets):
        for s in (0, 5, 10):
            t = dt.datetime.fromtimestamp(base + b * 300 + s, dt.timezone.utc)
            out.append(("Belgium", "BEL", t.strftime("%Y-%m-%d %H:%M:%S"), "", 100.0 + b + s / 10))
    out.append(("Belgium", "BEL", "not a time", "", 1e9))  # unparsable: its NULL bucket never joins
    return out


def _drops(spark, scratch):
    w, p = f"{scratch}/weather", f"{scratch}/energy_prices"
    spark.createDataFrame(_weather_rows(5), WEATHER_COLS).write.parquet(f"{w}/2022-12-16-00-00-00old")
    spark.createDataFrame(_weather_rows(), WEATHER_COLS).write.parquet(f"{w}/2022-12-17-05-12-13new")
    spark.createDataFrame(_price_rows(), PRICE_COLS).write.parquet(f"{p}/2022-12-17-05-13-17new")
    return w, p


def test_refresh_batch_view_reference_schema(spark, scratch):
    w, p = _drops(spark, scratch)
    view = KeyedTable(f"{scratch}/data5minutes", keys=["dt"])
    refresh_batch_view(spark, w, p, view)
    got = view.read(spark).orderBy("dt").collect()
    assert len(got) == 40
    first = got[0]
    assert abs(first.avg_temp - (270.0 + 271.0 + 272.0) / 3) < 1e-9  # the exact copy did not count twice
    assert abs(first.avg_price - (100.0 + 100.5 + 101.0) / 3) < 1e-9
    assert set(view.read(spark).columns) == {"dt", "avg_clouds", "avg_feels_like_temp", "avg_humidity", "avg_pressure",
                                             "avg_price", "avg_temp", "avg_visibility", "avg_wind_deg",
                                             "avg_wind_speed"}
    refresh_batch_view(spark, w, p, view)  # a second refresh upserts: still one row per bucket
    assert view.read(spark).count() == 40


def test_retrain_then_stream_scoring(spark, scratch):
    w, p = _drops(spark, scratch)
    path = retrain(spark, w, p, f"{scratch}/models", version="2022-12-17-06-00-00")
    assert path.endswith("2022-12-17-06-00-00")
    msgs = []
    for i in range(6):
        m = {"dt": 1671260000 + i, "main": {"temp": 275.0 + i, "pressure": 1010, "humidity": 70},
             "visibility": 9000, "wind": {"speed": 3.0, "deg": 200}, "clouds": {"all": 40},
             "weather": [{"id": 803, "main": "Clouds", "description": "x", "icon": "y"}], "id": 7, "cod": 200}
        msgs.append(json.dumps(m))
    msgs.append(json.dumps({"dt": 1671260100, "cod": 404}))
    msgs.append("{broken")
    topic = f"{scratch}/topic"
    publish_json(spark.createDataFrame([(m,) for m in msgs], "value string"), topic, files=2)
    preds = KeyedTable(f"{scratch}/predictions", keys=["dt", "id"])
    q = start_scoring(spark, message_stream(spark, topic, max_files_per_trigger=1), f"{scratch}/models", preds,
                      f"{scratch}/rejects", f"{scratch}/ckpt", available_now=True)
    run_available(q)
    got = preds.read(spark)
    assert got.count() == 6
    assert spark.read.parquet(f"{scratch}/rejects").count() == 2
    # Same numbers as scoring the parsed messages in batch.
    from tempora.operators.ml import load_model
    from tempora.streaming.messages import parse_weather_messages
    from tempora.streaming.scoring import message_rejects, score

    good, _ = message_rejects(parse_weather_messages(spark.createDataFrame([(m,) for m in msgs], "value string")))
    batch = score(good, load_model(path))
    key = lambda d: sorted((r.dt, r.id, round(r.prediction, 9)) for r in d.collect())
    assert key(got.select("dt", "id", "prediction")) == key(batch)


def test_landing_then_newest_drop(spark, scratch):
    msgs = [json.dumps({"dt": 1671253800 + 60 * i, "main": {"temp": 280.0 + i}, "weather": [{"main": "Rain"}],
                        "id": 1, "cod": 200}) for i in range(10)]
    topic = f"{scratch}/topic"
    publish_json(spark.createDataFrame([(m,) for m in msgs], "value string"), topic, files=2)
    run_available(start_landing(message_stream(spark, topic, max_files_per_trigger=1), f"{scratch}/weather",
                                f"{scratch}/ckpt", available_now=True))
    newest = read_newest_drop(spark, f"{scratch}/weather")
    assert "weather_0__main" in newest.columns and "main_temp" in newest.columns
    assert 0 < newest.count() < 10


@pytest.mark.parametrize("newest_first", [False, True])
def test_stream_equals_batch_in_any_order(spark, scratch, newest_first):
    rows = sorted(_weather_rows(30), reverse=newest_first)
    for i in range(3):  # three drops, appended one after the other
        part = rows[i * len(rows) // 3:(i + 1) * len(rows) // 3]
        spark.createDataFrame(part, WEATHER_COLS).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        time.sleep(0.05)  # the file source reads in the order of modification times
    schema = spark.read.parquet(f"{scratch}/in").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/in")
    avgs = {"avg_temp": "main_temp", "avg_clouds": "clouds_all"}
    table = SumTable(f"{scratch}/avgs", keys=["dt"])
    run_available(start_bucket_averages(stream, avgs, table, f"{scratch}/ckpt", available_now=True))
    got = {r.dt: (round(r.avg_temp, 9), round(r.avg_clouds, 9)) for r in averages_of(table.read(spark), "dt", avgs).collect()}
    batch = weather_bucket_averages(spark.read.parquet(f"{scratch}/in"), averages=avgs, drop=[])
    want = {r.dt: (round(r.avg_temp, 9), round(r.avg_clouds, 9)) for r in batch.collect()}
    assert got == want and len(got) == 30
    assert len(table.applied_batches(spark)) == 3


def test_train_test_report(spark):
    rows = [(i, float(i), float(i % 5), 2.0 * i + 1.0) for i in range(100)]
    df = spark.createDataFrame(rows, "dt int, main_temp double, wind_speed double, price double")
    summary, held_out = train_test_report(spark, df, ["main_temp", "wind_speed"])
    assert summary.first().n + held_out.first().n == 100


def test_fresh_checkpoint_keeps_earlier_rows(spark, scratch):
    table = KeyedTable(f"{scratch}/t", keys=["id"])

    def run(name, ids):
        spark.createDataFrame([(i, name) for i in ids], "id int, by string").coalesce(1).write.parquet(f"{scratch}/{name}")
        stream = spark.readStream.schema("id int, by string").parquet(f"{scratch}/{name}")
        run_available(stream.writeStream.foreachBatch(table.upsert_stream_batch).trigger(availableNow=True)
                      .option("checkpointLocation", f"{scratch}/ckpt_{name}").start())

    run("a", range(20))
    run("b", range(20, 25))  # batch 0 of another stream
    assert table.read(spark).count() == 25
    table.compact(spark)
    table.vacuum(spark)
    run("c", range(24, 30))  # batch 0 again, below the snapshot's number
    got = {r.id: r.by for r in table.read(spark).collect()}
    assert len(got) == 30 and got[23] == "b" and got[24] == "c"


def test_land_both_kinds_and_count_rejects(spark, scratch):
    from tempora.constants import EXPLORE_AVERAGES
    from tempora.plans.explore import explore_table

    weather = [json.dumps({
        "dt": 1671253800 + 300 * i, "main": {"temp": 280.0 + i, "feels_like": 279.0, "pressure": 1010, "humidity": 70,
                                             "temp_min": 270, "temp_max": 290}, "visibility": 9000,
        "wind": {"speed": 3.0, "deg": 200}, "clouds": {"all": 40},
        "weather": [{"id": 500, "main": "Rain", "description": "rain", "icon": "x"}], "coord": {"lon": 1.0, "lat": 2.0},
        "sys": {"type": 1, "id": 2, "country": "GR", "sunrise": 5, "sunset": 9}, "base": "stations", "timezone": 7200,
        "id": 1, "name": "A", "cod": 200}) for i in range(20)] + ["{broken", '{"id": 3}']
    local = dt.datetime(2022, 12, 17, 5, 10)
    texts = [str(local + dt.timedelta(minutes=5 * i)) for i in range(18)] + ["2022-12-17 06:40:00.5", "2022-12-17T06:45:00"]
    prices = [json.dumps({"Country": "Greece", "ISO3 Code": "GRC", "Datetime (UTC)": x, "Datetime (Local)": x,
                          "Price (EUR/MWhe)": 100.0 + i}) for i, x in enumerate([*texts, "garbage"])]
    for kind, msgs, good in (("weather", weather, 20), ("prices", prices, 20)):
        publish_json(spark.createDataFrame([(m,) for m in msgs], "value string"), f"{scratch}/topic_{kind}")
        run_available(start_landing(message_stream(spark, f"{scratch}/topic_{kind}"), f"{scratch}/{kind}",
                                    f"{scratch}/ckpt_{kind}", available_now=True, kind=kind))
        landed = read_newest_drop(spark, f"{scratch}/{kind}").count()
        assert landed == good
        assert landed + spark.read.parquet(f"{scratch}/{kind}_rejects").count() == len(msgs)
    drop = read_newest_drop(spark, f"{scratch}/weather")
    assert len(drop.columns) == 27
    out = explore_table(drop, read_newest_drop(spark, f"{scratch}/prices"))
    assert set(EXPLORE_AVERAGES) <= set(out.columns) and out.count() == 20
    view = KeyedTable(f"{scratch}/view", keys=["dt"])
    refresh_batch_view(spark, f"{scratch}/weather", f"{scratch}/prices", view)
    assert view.read(spark).count() == 20
    assert retrain(spark, f"{scratch}/weather", f"{scratch}/prices", f"{scratch}/models")


def test_newest_model_ignores_half_written_and_older_versions(spark, scratch):
    import os

    from tempora.operators.ml import assemble, fit_linear, newest_model_path, save_model

    train = spark.createDataFrame([(float(i), 2.0 * i) for i in range(9)], "main_temp double, price double")
    model = fit_linear(assemble(train, ["main_temp"]))
    save_model(model, f"{scratch}/models", "v000001")
    time.sleep(1.1)
    save_model(model, f"{scratch}/models", "2026-12-02-10-00-00")
    os.makedirs(f"{scratch}/models/v999999/metadata")
    assert newest_model_path(spark, f"{scratch}/models").endswith("/2026-12-02-10-00-00")


def test_streams_read_folder_tables(spark, scratch):
    from tempora.plans import standins as S

    spark.range(100).selectExpr("id AS event_id", "timestamp_seconds(id) AS ts").repartition(3).write.parquet(f"{scratch}/events.parquet")
    q = (S.events_stream(spark, scratch).writeStream.format("memory").queryName("folder_events")
         .option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start())
    run_available(q)
    assert spark.table("folder_events").count() == 100


def test_bounded_scoring_runs_resume_from_checkpoint(spark, scratch):
    from tempora.operators.ml import assemble, fit_linear, save_model
    from tempora.streaming.scoring import score_for

    train = spark.createDataFrame([(float(i), 2.0 * i + 1.0) for i in range(20)], "main_temp double, price double")
    save_model(fit_linear(assemble(train, ["main_temp"]), reg_param=0.0), f"{scratch}/models", "v000001")
    topic = f"{scratch}/topic"
    msgs = [json.dumps({"dt": 1671260000 + i, "main": {"temp": float(i)}, "id": 1, "cod": 200}) for i in range(8)]
    publish_json(spark.createDataFrame([(m,) for m in msgs], "value string"), topic, files=2)
    preds = KeyedTable(f"{scratch}/predictions", keys=["dt", "id"])
    stream = message_stream(spark, topic, max_files_per_trigger=1)
    score_for(spark, stream, f"{scratch}/models", preds, f"{scratch}/rejects", f"{scratch}/ckpt", seconds=6,
              iterations=2, features=["main_temp"], processing_time="1 second")
    got = sorted((r.dt, round(r.prediction, 6)) for r in preds.read(spark).collect())
    assert got == [(dt.datetime(2022, 12, 17, 6, 53, 20) + dt.timedelta(seconds=i), 2.0 * i + 1.0) for i in range(8)]


def test_cli_jobs_end_to_end(spark, scratch):
    from tempora import cli

    w, p = _drops(spark, scratch)
    out = cli.main(["refresh-view", "--weather-dir", w, "--prices-dir", p, "--view", f"{scratch}/view", "--compact"],
                   spark=spark)
    assert out.startswith("batch 0")
    assert KeyedTable(f"{scratch}/view", keys=["dt"]).read(spark).count() == 40
    path = cli.main(["retrain", "--weather-dir", w, "--prices-dir", p, "--model-dir", f"{scratch}/models",
                     "--version", "v000001"], spark=spark)
    assert path.endswith("v000001")
    msgs = [json.dumps({"dt": 1671260000, "main": {"temp": 280.0, "pressure": 1010, "humidity": 70},
                        "visibility": 9000, "wind": {"speed": 3.0, "deg": 200}, "clouds": {"all": 40},
                        "id": 7, "cod": 200})]
    publish_json(spark.createDataFrame([(m,) for m in msgs], "value string"), f"{scratch}/topic")
    cli.main(["land", "--messages", f"{scratch}/topic", "--drops", f"{scratch}/landed", "--available-now"],
             spark=spark)
    assert read_newest_drop(spark, f"{scratch}/landed").count() == 1


def test_landing_partitioned_by_day_prunes(spark, scratch):
    from pyspark.sql import functions as F

    msgs = [json.dumps({"dt": 1671253800 + 6 * 3600 * i, "main": {"temp": 280.0 + i}, "id": 1, "cod": 200})
            for i in range(12)]
    topic = f"{scratch}/topic"
    publish_json(spark.createDataFrame([(m,) for m in msgs], "value string"), topic, files=1)
    run_available(start_landing(message_stream(spark, topic), f"{scratch}/weather", f"{scratch}/ckpt",
                                available_now=True, partition_by_day=True))
    drop = read_newest_drop(spark, f"{scratch}/weather")
    one_day = drop.where(F.col("day") == "2022-12-18")
    assert one_day.count() == 4
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_serve_views_from_tables(spark, scratch):
    import datetime as _dt

    from tempora.plans.jobs import serve_views

    w, p = _drops(spark, scratch)
    view = KeyedTable(f"{scratch}/view", keys=["dt"])
    refresh_batch_view(spark, w, p, view)
    preds = KeyedTable(f"{scratch}/preds", keys=["dt", "id"])
    base = _dt.datetime(2022, 12, 17, 5, 10)
    rows = [(base + _dt.timedelta(minutes=5 * i), 7, 100.0 + i) for i in range(40)]
    preds.write_batch(spark.createDataFrame(rows, "dt timestamp_ntz, id bigint, prediction double"), 0)
    out = serve_views(spark, preds, view)
    latest = out["prediction"].first()
    assert latest.dt == rows[-1][0] and latest.prediction == 139.0
    bv = out["batch_view"].first()
    assert bv.dt <= rows[-1][0] and abs(bv.avg_temp - round(bv.avg_temp, 2)) < 1e-9
    plot = out["plot"].collect()
    assert {r.series for r in plot} == {"predicted", "real"}
    assert [r.dt for r in plot] == sorted(r.dt for r in plot)


def test_exact_l1_is_partitioning_independent(spark, scratch):
    from tempora.plans.weather_price import price_bucket_averages, weather_bucket_averages, weather_price_table

    w = spark.createDataFrame(_weather_rows(30), WEATHER_COLS)
    p = spark.createDataFrame(_price_rows(30), PRICE_COLS)
    exact = {"avg_temp": 2, "avg_wind_speed": 2}

    def table(wd, pd):
        return weather_price_table(weather_bucket_averages(wd, exact_scales=exact),
                                   price_bucket_averages(pd, exact_scale=2))

    a = {r.dt: (r.avg_temp, r.avg_wind_speed, r.avg_price) for r in table(w.repartition(1), p.repartition(1)).collect()}
    b = {r.dt: (r.avg_temp, r.avg_wind_speed, r.avg_price) for r in table(w.repartition(7), p.repartition(5)).collect()}
    assert a == b and len(a) == 30


def test_cli_score_bounded(spark, scratch):
    from tempora import cli
    from tempora.operators.ml import assemble, fit_linear, save_model

    rows = [(float(i), 1000.0, 70.0, 9000.0, 3.0, 200.0, 40.0, 3.0 * i) for i in range(30)]
    cols = "main_temp double, main_pressure double, main_humidity double, visibility double, " \
           "wind_speed double, wind_deg double, clouds_all double, price double"
    save_model(fit_linear(assemble(spark.createDataFrame(rows, cols))), f"{scratch}/models", "v000001")
    msg = {"dt": 1671260000, "main": {"temp": 5.0, "pressure": 1000, "humidity": 70}, "visibility": 9000,
           "wind": {"speed": 3.0, "deg": 200}, "clouds": {"all": 40}, "id": 3, "cod": 200}
    publish_json(spark.createDataFrame([(json.dumps(msg),)], "value string"), f"{scratch}/topic")
    cli.main(["score", "--messages", f"{scratch}/topic", "--model-dir", f"{scratch}/models",
              "--predictions", f"{scratch}/preds", "--seconds", "8", "--trigger", "1 second"], spark=spark)
    got = KeyedTable(f"{scratch}/preds", keys=["dt", "id"]).read(spark).collect()
    assert len(got) == 1 and got[0].id == 3


def test_cli_averages_replay_cities_views_and_report(spark, scratch):
    from tempora import cli
    from tempora.constants import CITY_COLUMNS, PRICE_MESSAGE_KEYS
    from tempora.streaming.messages import parse_price_messages

    # Averages: what the batch job gives.
    for part in (_weather_rows(30)[:50], _weather_rows(30)[40:]):
        spark.createDataFrame(part, WEATHER_COLS).write.mode("append").parquet(f"{scratch}/in")
        cli.main(["averages", "--readings", f"{scratch}/in", "--schema", WEATHER_COLS, "--table", f"{scratch}/sums", "--available-now"], spark=spark)
    got = averages_of(SumTable(f"{scratch}/sums", keys=["dt"]).read(spark), "dt", {"avg_temp": 0, "avg_clouds": 0})
    want = weather_bucket_averages(spark.read.parquet(f"{scratch}/in"), drop=[])
    assert sorted((r.dt, round(r.avg_temp, 9)) for r in got.collect()) == sorted((r.dt, round(r.avg_temp, 9)) for r in want.collect())
    # Replay and cities.
    with open(f"{scratch}/prices.csv", "w") as f:
        f.write(",".join(PRICE_MESSAGE_KEYS) + "\n")
        for k, country in enumerate(["Belgium", "Belgium", "Greece"]):
            f.write(f"{country},XXX,2022-12-17 0{k}:00:00,2022-12-17 0{k + 1}:00:00,{100 + k}\n")
    cli.main(["replay", "--history", f"{scratch}/prices.csv", "--noise", "0", "--out", f"{scratch}/topic"], spark=spark)
    msgs = parse_price_messages(spark.read.text(f"{scratch}/topic"))
    assert msgs.count() == 720 and {r.Country for r in msgs.collect()} == {"Belgium"}
    with open(f"{scratch}/cities.csv", "w") as f:
        f.write(";".join(CITY_COLUMNS) + '\n1;A;A;Belgium;50.5,4.5\n2;B;B;France;48.0,2.0\n')
    cli.main(["cities", "--cities", f"{scratch}/cities.csv", "--out", f"{scratch}/cities"], spark=spark)
    assert [r["Name"] for r in spark.read.json(f"{scratch}/cities").collect()] == ["A"]
    # Views over the serving tables.
    w, p = _drops(spark, scratch)
    cli.main(["refresh-view", "--weather-dir", w, "--prices-dir", p, "--view", f"{scratch}/view"], spark=spark)
    newest = KeyedTable(f"{scratch}/view", ["dt"]).read(spark).agg({"dt": "max"}).first()[0]
    preds = spark.createDataFrame([(newest, 1, 5.0)], "dt timestamp_ntz, id bigint, prediction double")
    KeyedTable(f"{scratch}/preds", ["dt", "id"]).append(preds)
    assert cli.main(["views", "--predictions", f"{scratch}/preds", "--view", f"{scratch}/view", "--out", f"{scratch}/views"],
                    spark=spark).startswith("3 tables")
    assert all(spark.read.parquet(f"{scratch}/views/{n}").count() >= 1 for n in ("prediction", "batch_view", "plot"))


def test_sweep_removes_old_runs_only(spark, scratch):
    import os
    import uuid

    from tempora.session import ensure_checkpoint_dir, shared_path, sweep_runs

    base = ensure_checkpoint_dir(spark)
    old, new = (shared_path(spark, "sweep_test", unique=True) for _ in range(2))
    kept = f"{base}/sweep_test/a_table"
    foreign = f"{base}/{uuid.uuid4()}"
    for path in (old, new, kept, foreign):
        os.makedirs(f"{path}/part")
        with open(f"{path}/part/x", "w") as f:
            f.write("x")
    for path in (old, kept, foreign):
        for d in (f"{path}/part/x", f"{path}/part", path):
            os.utime(d, (1, 1))
    assert sweep_runs(spark, 30 * 86_400) == 2
    assert not os.path.exists(old) and not os.path.exists(foreign) and os.path.exists(f"{new}/part/x") and os.path.exists(f"{kept}/part/x")
