"""Job entry points for ``spark-submit`` (the batch-view refresh, retrain, live scoring, landing).

    spark-submit --conf spark.checkpoint.dir=hdfs:///shared/ckpt tempora/cli.py refresh-view \\
        --weather-dir hdfs:///drops/weather --prices-dir hdfs:///drops/energy_prices --view hdfs:///serving/data5minutes
    spark-submit ... tempora/cli.py retrain --weather-dir ... --prices-dir ... --model-dir hdfs:///models/price
    spark-submit ... tempora/cli.py score --messages hdfs:///topics/weather --model-dir ... \\
        --predictions hdfs:///serving/predictions --seconds 3600 --iterations 24
    spark-submit ... tempora/cli.py land --messages hdfs:///topics/weather --drops hdfs:///drops/weather
    spark-submit ... tempora/cli.py averages --readings hdfs:///drops/stream --schema "dt bigint, ..." --table hdfs:///serving/sums
    spark-submit ... tempora/cli.py replay --history prices.csv --country Belgium --out hdfs:///topics/prices
    spark-submit ... tempora/cli.py cities --cities cities.csv --country Belgium --out hdfs:///lists/belgium
    spark-submit ... tempora/cli.py views --predictions ... --view ... --out hdfs:///views
    spark-submit ... tempora/cli.py report --weather-dir ... --prices-dir ... --out hdfs:///reports/2024-01-31
    spark-submit ... tempora/cli.py sweep --days 7

Every path is a shared folder; checkpoints go under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import hashlib
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from tempora.constants import DEFAULT_COUNTRY  # noqa: E402
from tempora.session import ensure_checkpoint_dir, get_session, shared_path, sweep_runs  # noqa: E402


def _parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="tempora")
    sub = ap.add_subparsers(dest="job", required=True)

    r = sub.add_parser("refresh-view", help="newest drops -> 5-minute table -> upsert into the batch view")
    r.add_argument("--weather-dir", required=True)
    r.add_argument("--prices-dir", required=True)
    r.add_argument("--view", required=True)
    r.add_argument("--shift-seconds", type=int, default=0)
    r.add_argument("--compact", action="store_true", help="compact and vacuum the view afterwards")

    t = sub.add_parser("retrain", help="newest drops -> 5-minute table -> elastic net -> new model version")
    t.add_argument("--weather-dir", required=True)
    t.add_argument("--prices-dir", required=True)
    t.add_argument("--model-dir", required=True)
    t.add_argument("--version", default=None)
    t.add_argument("--shift-seconds", type=int, default=0)

    s = sub.add_parser("score", help="score weather messages with the newest model, upsert predictions")
    s.add_argument("--messages", required=True)
    s.add_argument("--model-dir", required=True)
    s.add_argument("--predictions", required=True)
    s.add_argument("--rejects", default=None)
    s.add_argument("--seconds", type=float, default=3600)
    s.add_argument("--iterations", type=int, default=1)
    s.add_argument("--trigger", default="5 seconds")
    s.add_argument("--checkpoint", default=None)
    s.add_argument("--max-files-per-trigger", type=int, default=None)

    la = sub.add_parser("land", help="weather or price messages -> flattened Parquet drops named by time")
    la.add_argument("--messages", required=True)
    la.add_argument("--drops", required=True)
    la.add_argument("--kind", choices=("weather", "prices", "any"), default="weather")
    la.add_argument("--checkpoint", default=None)
    la.add_argument("--available-now", action="store_true")

    a = sub.add_parser("averages", help="keep the sums behind the 5-minute averages of a stream of flat readings")
    a.add_argument("--readings", required=True, help="folder of Parquet files that arrive")
    a.add_argument("--schema", required=True, help="their columns, as DDL")
    a.add_argument("--table", required=True)
    a.add_argument("--delay", default=None, help='how late a reading may come ("2 hours"); bounds the state')
    a.add_argument("--checkpoint", default=None)
    a.add_argument("--available-now", action="store_true")

    p = sub.add_parser("replay", help="hourly price history (CSV) -> up-sampled price messages of one country")
    p.add_argument("--history", required=True)
    p.add_argument("--country", default=DEFAULT_COUNTRY)
    p.add_argument("--noise", type=float, default=1.0, help="standard deviation of the noise")
    p.add_argument("--out", required=True)

    c = sub.add_parser("cities", help="city file (CSV) -> the cities of one country")
    c.add_argument("--cities", required=True)
    c.add_argument("--country", default=DEFAULT_COUNTRY)
    c.add_argument("--out", required=True)

    v = sub.add_parser("views", help="current prediction, current batch row, predicted against real -> Parquet")
    v.add_argument("--predictions", required=True)
    v.add_argument("--view", required=True)
    v.add_argument("--as-of", default=None)
    v.add_argument("--out", required=True)

    d = sub.add_parser("report", help="newest drops -> exploration table -> the tables of the distribution report")
    d.add_argument("--weather-dir", required=True)
    d.add_argument("--prices-dir", required=True)
    d.add_argument("--shift-seconds", type=int, default=0)
    d.add_argument("--out", required=True)

    w = sub.add_parser("sweep", help="remove what earlier runs left under spark.checkpoint.dir")
    w.add_argument("--days", type=float, default=7.0, help="only what hasn't been written to for so long")
    return ap


def _checkpoint(spark: SparkSession, job: str, output: str, given: str | None) -> str:
    """A job's own checkpoint: the given one, or one named after its output."""
    return given or shared_path(spark, f"{job}_checkpoint", hashlib.sha256(output.rstrip("/").encode()).hexdigest()[:16])


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> str:
    """Run one job; returns a short description of what was written."""
    args = _parser().parse_args(argv)
    spark = spark or get_session(app_name=f"tempora-{args.job}")
    ensure_checkpoint_dir(spark)

    if args.job == "refresh-view":
        from tempora.constants import BATCH_VIEW_COLUMNS
        from tempora.plans.jobs import refresh_batch_view
        from tempora.sources.sinks import KeyedTable

        view = KeyedTable(args.view, keys=["dt"])
        bid = refresh_batch_view(spark, args.weather_dir, args.prices_dir, view, shift_seconds=args.shift_seconds)
        if args.compact:
            view.compact(spark)
            view.vacuum(spark)
        return f"batch {bid} of {args.view} ({len(BATCH_VIEW_COLUMNS)} columns)"

    if args.job == "retrain":
        from tempora.plans.jobs import retrain

        return retrain(spark, args.weather_dir, args.prices_dir, args.model_dir, version=args.version,
                       shift_seconds=args.shift_seconds)

    if args.job == "score":
        from tempora.sources.sinks import KeyedTable
        from tempora.streaming.scoring import score_for
        from tempora.streaming.sources import message_stream

        preds = KeyedTable(args.predictions, keys=["dt", "id"], compact_every=100)
        stream = message_stream(spark, args.messages, max_files_per_trigger=args.max_files_per_trigger)
        rejects = args.rejects or args.predictions.rstrip("/") + "_rejects"
        score_for(spark, stream, args.model_dir, preds, rejects, _checkpoint(spark, "scoring", args.predictions, args.checkpoint),
                  seconds=args.seconds, iterations=args.iterations, processing_time=args.trigger)
        return f"predictions in {args.predictions}"

    if args.job == "land":
        from tempora.streaming.landing import start_landing
        from tempora.streaming.sources import message_stream, run_available

        q = start_landing(message_stream(spark, args.messages), args.drops, _checkpoint(spark, "landing", args.drops, args.checkpoint),
                          available_now=args.available_now, kind=args.kind)
        if args.available_now:
            run_available(q)
        else:
            q.awaitTermination()
        return f"drops in {args.drops}"

    if args.job == "averages":
        from tempora.constants import WEATHER_AVERAGES
        from tempora.sources.sinks import SumTable
        from tempora.streaming.bucket_stream import start_bucket_averages
        from tempora.streaming.sources import run_available

        readings = spark.readStream.schema(args.schema).parquet(args.readings)
        averages = {k: c for k, c in WEATHER_AVERAGES.items() if c in readings.columns}
        q = start_bucket_averages(readings, averages, SumTable(args.table, keys=["dt"], compact_every=100),
                                  _checkpoint(spark, "averages", args.table, args.checkpoint), delay=args.delay, available_now=args.available_now)
        if args.available_now:
            run_available(q)
        else:
            q.awaitTermination()
        return f"sums of {len(averages)} measures in {args.table}"

    if args.job == "replay":
        from tempora.plans.price_replay import replay_messages
        from tempora.sources.files import read_csv
        from tempora.sources.sinks import publish_json

        publish_json(replay_messages(read_csv(spark, args.history), args.country, noise_sigma=args.noise), args.out)
        return f"price messages in {args.out}"

    if args.job == "cities":
        from tempora.plans.cities import country_cities

        country_cities(spark, args.cities, args.country).write.mode("overwrite").json(args.out)
        return f"cities of {args.country} in {args.out}"

    if args.job in ("views", "report"):
        from tempora.plans.explore import distribution_report, explore_table, explore_weather
        from tempora.plans.jobs import serve_views
        from tempora.sources.files import read_newest_drop
        from tempora.sources.sinks import KeyedTable

        if args.job == "views":
            tables = serve_views(spark, KeyedTable(args.predictions, keys=["dt", "id"]), KeyedTable(args.view, keys=["dt"]), args.as_of)
        else:
            weather = read_newest_drop(spark, args.weather_dir)
            prices = read_newest_drop(spark, args.prices_dir)
            tables = distribution_report(explore_weather(weather), explore_table(weather, prices, args.shift_seconds))
        for name, table in tables.items():
            _plain_names(table).write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
        return f"{len(tables)} tables in {args.out}"

    if args.job == "sweep":
        return f"{sweep_runs(spark, args.days * 86_400)} folders removed"
    raise AssertionError(args.job)


def _plain_names(table: DataFrame) -> DataFrame:
    from tempora.functions.jsonops import clean_column_names

    return clean_column_names(table)


if __name__ == "__main__":
    print(main())
