"""Forecast error (X3), overlay (C3), training renames (B4), 8-feature assembly."""

import math

from tempora.constants import FEATURES_8, TRAINING_RENAMES
from tempora.operators.joins import forecast_error, overlay
from tempora.operators.ml import assemble
from tempora.operators.projections import to_training_names


def test_forecast_error_metrics(spark):
    preds = spark.createDataFrame([(1, 10.0), (2, 12.0), (3, 7.0)], "dt int, prediction double")
    real = spark.createDataFrame([(1, 11.0), (2, 10.0), (4, 1.0)], "dt int, avg_price double")
    r = forecast_error(preds, real).first()
    assert r.n == 2 and abs(r.rmse - math.sqrt((1 + 4) / 2)) < 1e-12 and abs(r.mae - 1.5) < 1e-12


def test_overlay_keeps_every_point(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "dt int, value double")
    b = spark.createDataFrame([], "dt int, value double")
    out = overlay({"predicted": a, "real": b}).collect()
    assert sorted((r.series, r.dt) for r in out) == [("predicted", 1), ("predicted", 2)]


def test_training_names_and_eight_features(spark):
    cols = list(TRAINING_RENAMES)
    df = spark.createDataFrame([tuple(float(i) for i in range(len(cols)))], ", ".join(f"{c} double" for c in cols))
    renamed = to_training_names(df)
    assert renamed.columns == [TRAINING_RENAMES[c] for c in cols]
    vec = assemble(renamed, FEATURES_8).first().features
    assert len(vec) == 8
