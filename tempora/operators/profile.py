"""Distribution profiles (D7-D10): histogram data, box statistics, paired-variable summaries.

The plots of the original are drawn from these tables. Statistics are computed
by aggregates; the only values brought to the driver are one-row summaries
(min, max, count, quartiles) used to fix bin edges.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.operators.joins import sized_broadcast
from tempora.operators.quantiles import group_quantiles, has_few_distinct


def categorical_histogram(df: DataFrame, column: str, alias: str = "count") -> DataFrame:
    """Rows per category (NULL is a category)."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(alias))


def _quantiles(df: DataFrame, value: str, probs: Sequence[float], exact: bool, by: Sequence[str] = ()) -> DataFrame:
    """(*by, n, quantiles). Exact: by Spark's percentile, whose buffer holds a group's different values, if no group has many
    (``has_few_distinct``); else by range refinement, which holds none. Not exact: a mergeable sketch."""
    rows = df.where(F.col(value).isNotNull())
    if exact and not has_few_distinct(rows, value, by):
        return group_quantiles(rows, value, probs, by)
    q = F.percentile(value, list(probs)) if exact else F.percentile_approx(value, list(probs), 10_000)
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), q.alias("quantiles"))


def auto_bin_count(n: int, lo: float, hi: float, q1: float, q3: float) -> int:
    """The 'auto' rule of the plotting default: the smaller bin width of Sturges and
    Freedman-Diaconis (Sturges alone when the IQR is 0), bins = ceil(range / width)."""
    if n == 0 or hi <= lo:
        return 1
    sturges = (hi - lo) / (math.log2(n) + 1.0)
    fd = 2.0 * (q3 - q1) * n ** (-1.0 / 3.0)
    width = min(fd, sturges) if fd > 0 else sturges
    return max(1, int(math.ceil((hi - lo) / width)))


def numeric_histogram(df: DataFrame, column: str, bins: int | str = "auto", exact: bool = True) -> DataFrame:
    """Equal-width histogram of a numeric column over [min, max].

    ``bins='auto'`` chooses the count from one summary row (n, min, max,
    quartiles); with a given count no quartiles are computed. Bin i covers
    [lo + i*w, lo + (i+1)*w); the maximum falls in the last bin. NULL, NaN and
    infinite values are in no bin. Output: bin, bin_lo, bin_hi, count (empty bins are not listed).
    """
    x = F.col(column)
    finite = df.where(F.abs(x.cast("double")) < F.lit(math.inf))
    auto = bins == "auto"
    stats = finite.agg(F.count(x).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    n, lo, hi = stats["n"], stats["lo"], stats["hi"]
    if n == 0:
        return df.sparkSession.createDataFrame([], "bin int, bin_lo double, bin_hi double, count bigint")
    k = auto_bin_count(n, lo, hi, *_quantiles(finite, column, [0.25, 0.75], exact).first()["quantiles"]) if auto else int(bins)
    width = (hi - lo) / k if hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(k - 1)).cast("int")
    counted = finite.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return counted.select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
        "count",
    )


def box_stats(df: DataFrame, category: str, value: str, exact: bool = True) -> DataFrame:
    """Per category: n, quartiles, whiskers (furthest points within 1.5 IQR), outlier count.

    Two aggregate passes; the quartiles, one row a category, meet the rows by a size-checked
    broadcast, so that a hot category is not shuffled. A NULL category has no row.
    ``exact=True`` gives exact quantiles in bounded memory (``_quantiles``); ``exact=False`` uses mergeable
    sketches. The original draws these over per-bucket tables, whose size is bounded by the time range.
    """
    q = _quantiles(df, value, [0.25, 0.5, 0.75], exact, [category])
    q = q.select(category, "n", F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("median"),
                 F.col("quantiles")[2].alias("q3")).withColumn("iqr", F.col("q3") - F.col("q1"))
    lo_fence = F.col("q1") - F.lit(1.5) * F.col("iqr")
    hi_fence = F.col("q3") + F.lit(1.5) * F.col("iqr")
    v = F.col(value)
    q = sized_broadcast(q.where(F.col(category).isNotNull()))
    # The per-category quartiles are constant within a category: carried through the
    # fence aggregate with ``first`` instead of a second join back to them.
    joined = df.where(v.isNotNull()).join(q, on=category, how="inner")
    carried = ["n", "q1", "median", "q3", "iqr"]
    return joined.groupBy(category).agg(
        *[F.first(c).alias(c) for c in carried],
        F.min(F.when(v >= lo_fence, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi_fence, v)).alias("whisker_hi"),
        F.count(F.when((v < lo_fence) | (v > hi_fence), 1)).alias("n_outliers"),
    )


def pair_stats(df: DataFrame, x: str, y: str) -> DataFrame:
    """Relation of two variables: n, Pearson r, least-squares slope / intercept / r^2."""
    return df.agg(
        F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"),
        F.corr(x, y).alias("corr"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def pair_sample(df: DataFrame, x: str, y: str, fraction: float, seed: int = 42) -> DataFrame:
    """D10 scatter data: a seeded Bernoulli sample of (x, y) points (sampling is the feature)."""
    return df.select(x, y).sample(withReplacement=False, fraction=fraction, seed=seed)
