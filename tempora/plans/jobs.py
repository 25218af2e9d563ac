"""The user-facing batch jobs: batch-view refresh (L3), retrain (L4), train/test report."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tempora.constants import BATCH_VIEW_COLUMNS, FEATURES_7, LABEL_COLUMN, TRAIN_FRACTION_PERCENT
from tempora.operators.ml import assemble, evaluate, fit_linear, hash_split, model_summary, save_model
from tempora.operators.projections import to_training_names
from tempora.plans.weather_price import price_bucket_averages, weather_bucket_averages, weather_price_table
from tempora.sources.files import read_newest_drop
from tempora.sources.sinks import KeyedTable


def newest_weather_price_table(spark: SparkSession, weather_dir: str, prices_dir: str,
                               shift_seconds: int = 0) -> DataFrame:
    """A2 twice, then L1: the joined 5-minute table of the newest weather and price drops."""
    weather = weather_bucket_averages(read_newest_drop(spark, weather_dir))
    prices = price_bucket_averages(read_newest_drop(spark, prices_dir), shift_seconds=shift_seconds)
    return weather_price_table(weather, prices)


def refresh_batch_view(spark: SparkSession, weather_dir: str, prices_dir: str, view: KeyedTable,
                       batch_id: int | None = None, shift_seconds: int = 0) -> int:
    """L3: newest drops -> L1 -> upsert into the batch view keyed by ``dt``.

    Executors write the rows; nothing is collected. Returns the batch id used.
    """
    table = newest_weather_price_table(spark, weather_dir, prices_dir, shift_seconds)
    rows = table.select(*BATCH_VIEW_COLUMNS)
    if batch_id is None:
        return view.append(rows)
    view.write_batch(rows, batch_id)
    return batch_id


def retrain(spark: SparkSession, weather_dir: str, prices_dir: str, model_dir: str,
            features: Sequence[str] = FEATURES_7, version: str | None = None, shift_seconds: int = 0) -> str:
    """L4: newest drops -> L1 -> B4 renames -> J1 -> J3 -> J8 into a new version folder."""
    data = to_training_names(newest_weather_price_table(spark, weather_dir, prices_dir, shift_seconds))
    model = fit_linear(assemble(data, features).select("features", LABEL_COLUMN))
    version = version or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d-%H-%M-%S")
    return save_model(model, model_dir, version)


def train_test_report(spark: SparkSession, data: DataFrame, features: Sequence[str], label: str = LABEL_COLUMN,
                      key_cols: Sequence[str] = ("dt",), train_percent: int = TRAIN_FRACTION_PERCENT
                      ) -> tuple[DataFrame, DataFrame]:
    """Split by key hash, fit on train, (training summary, held-out metrics)."""
    assembled = assemble(data, features)
    train, test = hash_split(assembled, list(key_cols), train_percent)
    model = fit_linear(train, label=label)
    return model_summary(spark, model), evaluate(model, test)


def serve_views(spark: SparkSession, predictions: KeyedTable, batch_view: KeyedTable,
                as_of: str | None = None) -> dict[str, DataFrame]:
    """L7-L9 over the serving tables: current prediction, current batch row, predicted vs real.

    ``as_of`` defaults to the newest prediction time (the data's "now"); the
    lookback filters are on the tables' key column ``dt`` and reach their scans.
    """
    from tempora.operators.views import current_batch_row, current_prediction, data_now, predicted_vs_actual

    preds, view = predictions.read(spark), batch_view.read(spark)
    if preds is None or view is None:
        raise ValueError("a serving table has no committed batch yet")
    now = as_of if as_of is not None else data_now(preds)
    return {
        "prediction": current_prediction(preds, now),
        "batch_view": current_batch_row(view, now),
        "plot": predicted_vs_actual(preds, view, now),
    }
