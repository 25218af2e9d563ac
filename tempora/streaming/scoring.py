"""Live scoring (I1, I2, L5): messages -> features -> prediction -> keyed upsert.

One plan per micro-batch instead of one Spark job per message. The model is
loaded inside ``foreachBatch`` and re-loaded whenever a newer version folder
appears (I2), so a retrain does not need the stream to restart and a folder in
use is never overwritten (versions are new folders).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tempora.constants import FEATURES_7
from tempora.operators.ml import assemble, load_model, newest_model_path
from tempora.sources.sinks import KeyedTable, stream_id
from tempora.streaming.messages import parse_weather_messages


def message_rejects(parsed: DataFrame, features: Sequence[str] = FEATURES_7) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) — malformed JSON, status other than 200, or a NULL feature."""
    bad = F.col("_malformed") | ~F.col("cod").eqNullSafe(F.lit(200))
    for f in features:
        bad = bad | F.col(f).isNull()
    return parsed.where(~bad), parsed.where(bad)


def score(parsed: DataFrame, model, features: Sequence[str] = FEATURES_7) -> DataFrame:
    """I1 on parsed messages: prediction keyed by the message's raw time and city (Q9: ``(dt, id)``)."""
    scored = model.transform(assemble(parsed, features, handle_invalid="skip"))
    return scored.select(F.timestamp_seconds("dt").cast("timestamp_ntz").alias("dt"), "id", "prediction")


class ModelCache:
    """Holds the loaded model and reloads it when a newer version folder exists."""

    def __init__(self, spark: SparkSession, model_dir: str):
        self.spark, self.model_dir = spark, model_dir
        self.path, self.model = None, None

    def current(self):
        newest = newest_model_path(self.spark, self.model_dir)
        if newest != self.path:
            self.model, self.path = load_model(newest), newest
        return self.model


def start_scoring(spark: SparkSession, messages: DataFrame, model_dir: str, predictions: KeyedTable,
                  rejects_path: str, checkpoint: str, features: Sequence[str] = FEATURES_7,
                  available_now: bool = False, processing_time: str | None = None) -> StreamingQuery:
    """Parse -> reject split -> score with the newest model -> upsert predictions on ``(dt, id)``."""
    parsed = parse_weather_messages(messages)
    cache = ModelCache(spark, model_dir)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Two writes read the micro-batch: keep it for the handler (a lost block is
        # recomputed from the checkpointed source offsets).
        batch = batch.persist()
        try:
            good, bad = message_rejects(batch, features)
            predictions.upsert_stream_batch(score(good, cache.current(), features), batch_id)
            own = f"stream={stream_id(spark)}/batch_id={int(batch_id)}"  # a fresh checkpoint is another stream
            bad.drop("weather").write.mode("overwrite").parquet(f"{rejects_path}/{own}")
        finally:
            batch.unpersist()

    writer = parsed.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def score_for(spark: SparkSession, messages: DataFrame, model_dir: str, predictions: KeyedTable, rejects_path: str,
              checkpoint: str, seconds: float, iterations: int = 1, features: Sequence[str] = FEATURES_7,
              processing_time: str = "5 seconds") -> None:
    """``iterations`` runs of ``seconds`` each; every run resumes from the same
    checkpoint (no message is scored twice or lost) and picks up the newest model."""
    from tempora.streaming.sources import run_bounded

    for _ in range(iterations):
        q = start_scoring(spark, messages, model_dir, predictions, rejects_path, checkpoint, features,
                          processing_time=processing_time)
        run_bounded(q, seconds)
