"""Streaming bucket averages (X1) over distinct readings (D5), and scoring of bucket averages.

The stream form of L1's weather half: bucket -> de-duplicate -> average. The distinct readings come
from Spark's keyed state (a key is the whole reading, so that no bucket is hot); what a micro-batch
adds are partial sums and counts by bucket, kept in a ``SumTable``. A micro-batch reads its own rows and nothing
that was landed before, however large a day has grown.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tempora.constants import BUCKET_SECONDS
from tempora.functions.timebuckets import bucket_start
from tempora.sources.sinks import SumTable, stream_id

EVENT_TIME = "_event_time"


def distinct_stream(readings: DataFrame, time_col: str = "dt", width_seconds: int = BUCKET_SECONDS,
                    delay: str | None = None) -> DataFrame:
    """D5 on a stream: the first of the readings that agree in every column, their times by bucket.

    ``time_col`` (epoch seconds) becomes the start of its bucket, as in the batch form. Without ``delay`` the
    state keeps every distinct reading, and a copy may come as late as it likes. With a ``delay`` ("2 hours"),
    a reading whose bucket starts more than that before the newest bucket start of earlier micro-batches is
    late and left out, and the state forgets readings as old as that: ``late_rows`` finds the late
    ones. Readings without a time belong to no bucket and are left out.
    """
    rows = readings.where(F.col(time_col).isNotNull()).withColumn(time_col, bucket_start(time_col, width_seconds))
    if delay is None:
        return rows.dropDuplicates()
    columns = rows.columns
    # Copies agree in the start of their bucket, so one of them isn't late if the other is not.
    rows = rows.withColumn(EVENT_TIME, F.col(time_col).cast("timestamp")).withWatermark(EVENT_TIME, delay)
    return rows.dropDuplicatesWithinWatermark(columns).select(*columns)


def late_rows(landed: DataFrame, kept: DataFrame, time_col: str = "dt", width_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """The side output of ``distinct_stream``: distinct landed readings, by bucket, that the stream didn't keep.

    A reading that isn't late is kept, or is a copy of one that is; what is landed and not among the kept has
    come too late. Both are tables; read the days in question only.
    """
    rows = landed.where(F.col(time_col).isNotNull()).withColumn(time_col, bucket_start(time_col, width_seconds))
    return rows.subtract(kept.select(*rows.columns))


def start_distinct(readings: DataFrame, directory: str, checkpoint: str, time_col: str = "dt",
                   width_seconds: int = BUCKET_SECONDS, delay: str | None = None, available_now: bool = False) -> StreamingQuery:
    """Keep the distinct readings of a stream under ``directory``, a folder a micro-batch; a replay rewrites its folder."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{directory}/stream={stream_id(batch.sparkSession)}/batch={int(batch_id)}")

    writer = (distinct_stream(readings, time_col, width_seconds, delay).writeStream.outputMode("append")
              .foreachBatch(handle).option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def late_count(query: StreamingQuery) -> int:
    """Rows that a query's state has left out as late, in the progress reports that Spark still has."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])


# ---------------------------------------------------------------------------
# Averages from partial sums.
# ---------------------------------------------------------------------------
def partial_sums(rows: DataFrame, key: str, averages: Mapping[str, str | Column],
                 exact_scales: Mapping[str, int] | None = None) -> DataFrame:
    """By ``key``: ``sum_<alias>`` and ``n_<alias>`` (values that aren't NULL) of each measure.

    A measure in ``exact_scales`` is summed in whole units of its last decimal, so that the sum doesn't depend on the order.
    """
    exact_scales = exact_scales or {}
    aggs = []
    for alias, c in averages.items():
        col = F.col(c) if isinstance(c, str) else c
        unit = F.round(col * F.lit(10 ** exact_scales[alias])).cast("bigint") if alias in exact_scales else col.cast("double")
        aggs += [F.sum(unit).alias(f"sum_{alias}"), F.count(col).alias(f"n_{alias}")]
    return rows.groupBy(key).agg(*aggs)


def averages_of(sums: DataFrame, key: str, averages: Mapping[str, str | Column],
                exact_scales: Mapping[str, int] | None = None) -> DataFrame:
    """The averages that ``partial_sums`` stand for; NULL where a measure had no value."""
    exact_scales = exact_scales or {}
    return sums.select(key, *[
        F.try_divide(F.col(f"sum_{a}").cast("double"), F.col(f"n_{a}").cast("double") * F.lit(float(10 ** exact_scales.get(a, 0)))).alias(a)
        for a in averages])


def start_bucket_averages(readings: DataFrame, averages: Mapping[str, str | Column], table: SumTable, checkpoint: str,
                          time_col: str = "dt", width_seconds: int = BUCKET_SECONDS, dedup: bool = True,
                          delay: str | None = None, exact_scales: Mapping[str, int] | None = None,
                          available_now: bool = False) -> StreamingQuery:
    """Keep ``table`` (keyed by ``time_col``) at the sums behind the averages of all that the stream has read.

    Exact copies within a bucket count once, as in the batch job (Q2), whichever micro-batch brings them; ``delay`` bounds
    the state that this takes (``distinct_stream``). ``averages_of(table.read(spark), ...)`` serves open
    buckets too, and equals the batch form once the stream has read its input.
    """
    if delay is not None and not dedup:
        raise ValueError("delay bounds the state of dedup; without dedup there is none")
    rows = distinct_stream(readings, time_col, width_seconds, delay) if dedup else (
        readings.where(F.col(time_col).isNotNull()).withColumn(time_col, bucket_start(time_col, width_seconds)))

    def handle(batch: DataFrame, batch_id: int) -> None:
        table.upsert_stream_batch(partial_sums(batch, time_col, averages, exact_scales), batch_id)

    writer = rows.writeStream.outputMode("append").foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def score_bucket_averages(bucket_avgs: DataFrame, model, features: Sequence[str]) -> DataFrame:
    """The model applied to bucket averages (what it was trained on), not to single readings.

    A bucket with a NULL feature can't be scored: it stays, with a NULL prediction.
    """
    from tempora.operators.ml import assemble

    scored = model.transform(assemble(bucket_avgs, features, handle_invalid="skip")).select("dt", "prediction")
    missing = F.greatest(*[F.col(f).isNull() for f in features], F.lit(False))
    return scored.unionByName(bucket_avgs.where(missing).select("dt", F.lit(None).cast("double").alias("prediction")))
