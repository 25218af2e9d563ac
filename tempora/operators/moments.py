"""Training from mergeable second moments (J3, L4): count, means and covariances by day, and elastic net on them.

The rows of a day leave a row of statistics in a keyed table; a refresh reads the new days only, and a fit reads the
statistics of all days, whatever the number of readings behind them. Means and covariances are
combined about the common mean, so that large means don't cost digits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.constants import ELASTIC_NET_PARAMS
from tempora.sources.sinks import KeyedTable


def _pairs(columns: Sequence[str]) -> list[tuple[int, int]]:
    return list(combinations_with_replacement(range(len(columns)), 2))


def second_moments(rows: DataFrame, key: str | Column, columns: Sequence[str], key_name: str = "day") -> DataFrame:
    """(key, n, m_i, c_i_j) by key: number of rows, means, and sums of products of deviations from the key's means.

    ``i`` and ``j`` are places in ``columns``. Rows with a NULL in any of them, or a NULL key, are left out.
    """
    x = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]
    rows = rows.select((F.col(key) if isinstance(key, str) else key).alias(key_name), *x).dropna()
    return rows.groupBy(key_name).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(f"x{i}").alias(f"m_{i}") for i in range(len(columns))],
        *[(F.covar_pop(f"x{i}", f"x{j}") * F.count(F.lit(1))).alias(f"c_{i}_{j}") for i, j in _pairs(columns)])


@dataclass
class Moments:
    """Of all rows: their number, the means, and the covariances (divisor n)."""

    columns: list[str]
    n: int
    mean: np.ndarray
    cov: np.ndarray


def combine_moments(table: DataFrame, columns: Sequence[str]) -> Moments:
    """The moments of all keys together; only the sums, as many as pairs of columns, reach the driver."""
    k = len(columns)
    totals = table.agg(F.sum("n"), *[F.sum(F.col("n") * F.col(f"m_{i}")) for i in range(k)]).first()
    n = int(totals[0] or 0)
    if not n:
        return Moments(list(columns), 0, np.zeros(k), np.zeros((k, k)))
    mean = np.array(totals[1:], dtype=np.float64) / n
    off = [F.col(f"m_{i}") - F.lit(float(mean[i])) for i in range(k)]
    sums = table.agg(*[F.sum(F.col(f"c_{i}_{j}") + F.col("n") * off[i] * off[j]) for i, j in _pairs(columns)]).first()
    cov = np.zeros((k, k))
    for (i, j), s in zip(_pairs(columns), sums):
        cov[i, j] = cov[j, i] = s / n
    return Moments(list(columns), n, mean, cov)


@dataclass
class LinearFit:
    coefficients: np.ndarray
    intercept: float
    iterations: int
    rmse: float
    r2: float


def elastic_net(moments: Moments, label: str, reg_param: float = ELASTIC_NET_PARAMS["regParam"],
                mixing: float = ELASTIC_NET_PARAMS["elasticNetParam"], max_iter: int = 10_000, tol: float = 1e-13) -> LinearFit:
    """Least squares with an elastic-net penalty by coordinate descent on the covariances.

    The objective is MLlib's: features and label scaled to unit (population) deviation, half the mean squared
    error plus regParam / deviation(label) * (mixing * |w|_1 + (1 - mixing) / 2 * |w|_2^2). A feature without variance
    gets 0; a label without variance is predicted by its mean. Raises ValueError without rows.
    """
    if not moments.n:
        raise ValueError("no rows to train from")
    at = moments.columns.index(label)
    rest = [i for i in range(len(moments.columns)) if i != at]
    dev = np.sqrt(np.maximum(np.diag(moments.cov), 0))
    sy, sx = dev[at], dev[rest]
    w = np.zeros(len(rest))
    done = 0
    if sy > 0:
        live = sx > 0
        scale = np.where(live, sx, 1.0)
        gram = moments.cov[np.ix_(rest, rest)] / np.outer(scale, scale)
        corr = moments.cov[rest, at] / (scale * sy)
        l1, l2 = mixing * reg_param / sy, (1 - mixing) * reg_param / sy
        for done in range(1, max_iter + 1):
            moved = 0.0
            for j in np.flatnonzero(live):
                r = corr[j] - gram[j] @ w + gram[j, j] * w[j]
                new = np.sign(r) * max(abs(r) - l1, 0) / (gram[j, j] + l2)
                moved, w[j] = max(moved, abs(new - w[j])), new
            if moved <= tol:
                break
        w = w * sy / scale
    intercept = float(moments.mean[at] - w @ moments.mean[rest])
    cov_xy = moments.cov[rest, at]
    mse = max(0.0, float(sy ** 2 - 2 * w @ cov_xy + w @ moments.cov[np.ix_(rest, rest)] @ w))
    return LinearFit(w, intercept, done, mse ** 0.5, 1 - mse / sy ** 2 if sy > 0 else float("nan"))


def as_model(spark: SparkSession, fit: LinearFit, features_col: str = "features") -> LinearRegressionModel:
    """The fit as an MLlib model, to be saved, loaded and applied like any other."""
    jvm = spark.sparkContext._jvm
    java = jvm.org.apache.spark.ml.regression.LinearRegressionModel(
        f"moments_{abs(hash((fit.intercept, *fit.coefficients))):x}",
        spark.sparkContext._jvm.org.apache.spark.ml.linalg.Vectors.dense(_doubles(spark, fit.coefficients)), float(fit.intercept))
    model = LinearRegressionModel(java)
    model._transfer_params_from_java()
    return model._set(featuresCol=features_col)


def _doubles(spark: SparkSession, values: Sequence[float]):
    gateway = spark.sparkContext._gateway
    out = gateway.new_array(gateway.jvm.double, len(values))
    for i, v in enumerate(Vectors.dense(values)):
        out[i] = float(v)
    return out


def refresh_moments(rows: DataFrame, key: str | Column, columns: Sequence[str], table: KeyedTable) -> int:
    """The statistics of the keys in ``rows`` into a table keyed by them; a key that comes again is replaced as a whole."""
    return table.append(second_moments(rows, key, columns, table.keys[0]))
