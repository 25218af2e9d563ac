"""Ordered series and forecasts as streams: up-sampling (I3, E2) and the error of live predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tempora.constants import PRICE_RANGE_PERIODS, PRICE_SOURCE_STEP_SECONDS, PRICE_STEP_SECONDS
from tempora.operators.series import previous_row, upsample_pairs
from tempora.sources.sinks import KeyedTable, SumTable, stream_id

COMPACT_EVERY = 20


def upsample_batch(batch: DataFrame, known: DataFrame | None, series: str, time_col: str, value_col: str,
                   chunk_seconds: int = 30 * 86_400, **upsampling) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(points, newest, late): one step of a series whose last points are ``known``, a row a series.

    A price is paired with the one before it, in the batch or, for a series' first one, in ``known``. Rows that aren't
    newer than their series' known point are late: their pair has been published.
    """
    rows = batch.select(series, time_col, value_col).where(F.col(time_col).isNotNull() & F.col(series).isNotNull())
    late = rows.limit(0)
    if known is not None:
        last = known.select(series, F.col(time_col).alias("__time"), F.col(value_col).alias("__value"))
        rows = rows.join(last, on=series, how="left")
        is_late = F.coalesce(F.col(time_col) <= F.col("__time"), F.lit(False))
        late = rows.where(is_late).select(series, time_col, value_col)
        fresh = rows.where(~is_late)
        before = fresh.where(F.col("__time").isNotNull()).select(
            series, F.col("__time").alias(time_col), F.col("__value").alias(value_col)).distinct()
        rows = fresh.select(series, time_col, value_col, F.lit(False).alias("__old")).unionByName(before.withColumn("__old", F.lit(True)))
    else:
        rows = rows.withColumn("__old", F.lit(False))
    paired = previous_row(rows, [series], [time_col, value_col], [time_col, value_col], chunk_seconds=chunk_seconds, time_col=time_col)
    pairs = paired.where(F.col(f"prev_{time_col}").isNotNull() & ~F.col("__old"))
    points = upsample_pairs(pairs, f"prev_{time_col}", time_col, f"prev_{value_col}", value_col, keep=[series], **upsampling)
    newest = rows.where("NOT __old").groupBy(series).agg(F.max(F.struct(time_col, value_col)).alias("__last")).select(
        series, f"__last.{time_col}", f"__last.{value_col}")
    return points, newest, late


def start_upsampling(prices: DataFrame, last: KeyedTable, directory: str, checkpoint: str, series: str, time_col: str, value_col: str,
                     step_seconds: int = PRICE_STEP_SECONDS, source_step_seconds: int = PRICE_SOURCE_STEP_SECONDS,
                     periods: int | None = PRICE_RANGE_PERIODS, noise_sigma: float = 0.0, available_now: bool = False) -> StreamingQuery:
    """I3 + E2 on a stream: the points between consecutive prices of each series, under ``directory``/points, as prices arrive.

    ``last`` (keyed by ``series``, ordered by ``time_col``) keeps each series' newest price over restarts. A replayed
    micro-batch sees the prices known before it, and rewrites its folder: no pair is lost or published twice. Prices
    that aren't newer than their series' newest go to ``directory``/late; rows without a time or a series are left out.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        n = last.claim(spark, stream_id(spark) or "direct", batch_id)
        written = last.applied_batches(spark)
        if len(written) >= COMPACT_EVERY and n not in written:  # never over a batch that may be replayed
            last.compact(spark)
            last.vacuum(spark)
        batch = batch.persist()
        try:
            points, newest, late = upsample_batch(batch, last.read(spark, up_to=n - 1) if n else None, series, time_col, value_col,
                                                  step_seconds=step_seconds, source_step_seconds=source_step_seconds,
                                                  periods=periods, noise_sigma=noise_sigma)
            points.write.mode("overwrite").parquet(f"{directory}/points/batch={n}")
            late.write.mode("overwrite").parquet(f"{directory}/late/batch={n}")
            last.write_batch(newest, n)
        finally:
            batch.unpersist()

    writer = prices.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


# ---------------------------------------------------------------------------
# Live forecast error.
# ---------------------------------------------------------------------------
def matched_forecasts(predictions: DataFrame, actual: DataFrame, key: str = "dt", predicted_col: str = "prediction",
                      actual_col: str = "avg_price", delay: str = "1 hour") -> DataFrame:
    """(key, prediction, actual) as two streams meet on ``key`` (a timestamp): matches at once, a prediction that no value met
    with a NULL value when the watermark, ``delay`` behind the newest key of the slower stream, has passed it.

    State holds keys within the delay only. What comes later than the delay is left out by Spark and counted in its progress.
    """
    p = predictions.select(F.col(key).cast("timestamp").alias("__p"), F.col(predicted_col).alias("prediction")).withWatermark("__p", delay)
    a = actual.select(F.col(key).cast("timestamp").alias("__a"), F.col(actual_col).alias("actual")).withWatermark("__a", delay)
    joined = p.join(a, F.col("__p") == F.col("__a"), "left_outer")
    return joined.select(F.col("__p").cast("timestamp_ntz").alias(key), "prediction", "actual")


def start_forecast_error(predictions: DataFrame, actual: DataFrame, errors: SumTable, unmatched: str, checkpoint: str,
                         delay: str = "1 hour", available_now: bool = False, **columns) -> StreamingQuery:
    """X3 + L9 live: ``errors`` (keyed by ``day``) sums the errors of matched predictions; those that no value met go to ``unmatched``."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            key = batch.columns[0]
            err = F.col("prediction") - F.col("actual")
            sums = batch.where(err.isNotNull()).groupBy(F.to_date(key).alias("day")).agg(
                F.count(F.lit(1)).alias("n"), F.sum(err * err).alias("squares"), F.sum(F.abs(err)).alias("absolute"))
            (batch.where(F.col("actual").isNull()).select(key, "prediction").write.mode("overwrite")
             .parquet(f"{unmatched}/stream={stream_id(batch.sparkSession)}/batch={int(batch_id)}"))
            errors.upsert_stream_batch(sums, batch_id)
        finally:
            batch.unpersist()

    writer = matched_forecasts(predictions, actual, delay=delay, **columns).writeStream.outputMode("append").foreachBatch(handle)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def error_of(sums: DataFrame) -> DataFrame:
    """n, rmse, mae over all days, as ``operators.joins.forecast_error`` gives them."""
    return sums.agg(F.sum("n").alias("n"), F.sqrt(F.sum("squares") / F.sum("n")).alias("rmse"), (F.sum("absolute") / F.sum("n")).alias("mae"))
