"""Model operators (G2, J1-J9): split, assemble, fit, summarize, evaluate, predict, save, load.

MLlib does the distributed work: ``LinearRegression.fit`` aggregates the Gram
matrix / gradients over partitions (tree aggregation), so only
coefficient-sized data reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.constants import ELASTIC_NET_PARAMS, FEATURES_7, LABEL_COLUMN, TRAIN_FRACTION_PERCENT


def hash_split_label(key_cols: Sequence[str], train_percent: int = TRAIN_FRACTION_PERCENT) -> "F.Column":
    """G2, reproducible form: 'train' when the first 8 hex digits of md5(key) mod 100 < train_percent."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    bucket = F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % F.lit(100)
    return F.when(bucket < F.lit(train_percent), F.lit("train")).otherwise(F.lit("test"))


def hash_split(df: DataFrame, key_cols: Sequence[str], train_percent: int = TRAIN_FRACTION_PERCENT
               ) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash; stable across runs, engines and partitionings."""
    label = hash_split_label(key_cols, train_percent)
    return df.where(label == "train"), df.where(label == "test")


def random_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3), seed: int | None = 42) -> list[DataFrame]:
    """G2, the original's form: ``randomSplit`` (seeded here; the original was not)."""
    return df.randomSplit(list(weights), seed)


def assemble(df: DataFrame, features: Sequence[str] = FEATURES_7, output: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """Feature vector from numeric columns.

    ``handle_invalid='error'`` (the original) fails on a NULL feature; 'skip'
    drops the row (streams route such rows to a reject table first).
    """
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=handle_invalid).transform(df)


def fit_linear(df: DataFrame, features_col: str = "features", label: str = LABEL_COLUMN,
               max_iter: int = ELASTIC_NET_PARAMS["maxIter"], reg_param: float = ELASTIC_NET_PARAMS["regParam"],
               elastic_net: float = ELASTIC_NET_PARAMS["elasticNetParam"], solver: str = "auto"
               ) -> LinearRegressionModel:
    """Elastic-net linear regression (defaults are the original parameters)."""
    lr = LinearRegression(featuresCol=features_col, labelCol=label, maxIter=max_iter, regParam=reg_param,
                          elasticNetParam=elastic_net, solver=solver)
    return lr.fit(df)


def model_summary(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    """Coefficients, intercept, iterations, objective history, RMSE, r^2 as one row."""
    s = model.summary
    row = (
        [float(c) for c in model.coefficients],
        float(model.intercept),
        int(s.totalIterations),
        [float(v) for v in s.objectiveHistory],
        float(s.rootMeanSquaredError),
        float(s.r2),
        int(s.numInstances),
    )
    return spark.createDataFrame(
        [row],
        "coefficients array<double>, intercept double, iterations int, objective_history array<double>, "
        "rmse double, r2 double, n bigint",
    )


def residuals(model: LinearRegressionModel) -> DataFrame:
    """Training residuals (a distributed DataFrame)."""
    return model.summary.residuals


def evaluate(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    """RMSE / MAE / r^2 on held-out rows, computed by one aggregate over the predictions."""
    pred = model.transform(df)
    label, p = F.col(model.getLabelCol()), F.col(model.getPredictionCol())
    err = p - label
    return pred.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        (F.lit(1.0) - F.sum(err * err) / (F.count(F.lit(1)) * F.var_pop(label))).alias("r2"),
    )


def predict(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    """Batch prediction (adds ``prediction``)."""
    return model.transform(df)


MODEL_MARKER = "_COMPLETE"


def save_model(model: LinearRegressionModel, directory: str, version: str) -> str:
    """Save to ``directory/version`` (a new folder per version; a folder in use is never overwritten).

    MODEL_MARKER is written last: a folder without it is still being saved, or was left half-way.
    """
    path = directory.rstrip("/") + "/" + version
    model.write().overwrite().save(path)
    sc = SparkSession.active().sparkContext
    marker = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/{MODEL_MARKER}")
    marker.getFileSystem(sc._jsc.hadoopConfiguration()).create(marker, True).close()
    return path


def load_model(path: str) -> LinearRegressionModel:
    """J9."""
    return LinearRegressionModel.load(path)


def newest_model_path(spark: SparkSession, directory: str) -> str:
    """The version saved last, whatever the versions' names: by the time of the completeness marker, then by name."""
    sc = spark.sparkContext
    pattern = sc._jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/*/{MODEL_MARKER}")
    found = pattern.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(pattern) or []
    versions = [(s.getModificationTime(), s.getPath().getParent().getName()) for s in found]
    if not versions:
        raise ValueError(f"no complete model under {directory}")
    return f"{directory.rstrip('/')}/{max(versions)[1]}"
