"""Exact quantiles by range refinement, and elastic net from second moments, against numpy and MLlib."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tempora.operators.ml import assemble, evaluate, fit_linear, load_model, predict, save_model
from tempora.operators.moments import (
    as_model,
    combine_moments,
    elastic_net,
    refresh_moments,
    second_moments,
)
from tempora.operators.profile import box_stats, numeric_histogram
from tempora.operators.quantiles import group_quantiles
from tempora.sources.sinks import KeyedTable

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]


def values(kind, n, rng):
    if kind == "normal":
        return rng.normal(size=n)
    if kind == "scales":
        return rng.choice([-1, 1], n) * 10.0 ** rng.uniform(-300, 300, n)
    if kind == "ties":
        return rng.integers(-3, 4, n).astype(float)
    if kind == "hot":
        return np.where(rng.random(n) < 0.6, 5.0, rng.normal(size=n))
    return 1.0 + rng.integers(0, 50, n) * 2.0 ** -52  # neighbours


@pytest.mark.parametrize("kind", ["normal", "scales", "ties", "hot", "near"])
def test_quantiles_of_hard_distributions(spark, kind):
    rng = np.random.default_rng(3)
    groups = {"a": values(kind, 400, rng), "b": values(kind, 3, rng), None: values(kind, 50, rng)}
    rows = [(g, float(v)) for g, x in groups.items() for v in x] + [("a", None), ("a", math.nan), ("c", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r.g: r for r in group_quantiles(df, "v", PROBS, ["g"], cells=128).collect()}
    assert set(got) == set(groups)
    for g, x in groups.items():
        s = np.sort(x)
        assert got[g].n == len(x)
        for p, q in zip(PROBS, got[g].quantiles):
            at = (len(x) - 1) * p
            a, b = s[math.floor(at)], s[math.ceil(at)]
            assert q == (a if a == b else a + (b - a) * (at - math.floor(at)))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, width=64), min_size=1, max_size=25))
def test_every_rank_of_any_doubles(spark, x):
    probs = [k / max(1, len(x) - 1) for k in range(len(x))]
    (r,) = group_quantiles(spark.createDataFrame([(v,) for v in x], "v double"), "v", probs, cells=64).collect()
    s = sorted(x)
    for k, (p, q) in enumerate(zip(probs, r.quantiles)):
        place = (len(x) - 1) * p
        assert q in (s[math.floor(place)], s[math.ceil(place)]) or s[math.floor(place)] < q < s[math.ceil(place)]
        assert place != k or q == s[k]


def test_profiles_with_many_distinct_values_use_refinement(spark, monkeypatch):
    """The same result whichever way the quartiles come."""
    from tempora.operators import profile

    df = spark.range(5_000).select((F.col("id") % 3).cast("string").alias("c"), (F.hash("id") / 1000).alias("v"))
    plain = [sorted(map(tuple, f.collect())) for f in (box_stats(df, "c", "v"), numeric_histogram(df, "v"))]
    monkeypatch.setattr(profile, "has_few_distinct", lambda *a: False)
    refined = [sorted(map(tuple, f.collect())) for f in (box_stats(df, "c", "v"), numeric_histogram(df, "v"))]
    for a, b in zip(plain, refined):
        assert len(a) == len(b) > 2
        assert all(x == y or math.isclose(x, y, rel_tol=1e-12) for r, s in zip(a, b) for x, y in zip(r, s))


def test_quantile_passes_hold_few_rows(spark):
    df = spark.range(200_000).select(F.rand(5).alias("v"))
    (r,) = group_quantiles(df, "v", [0.5], cells=64).collect()
    (p,) = df.agg(F.percentile("v", 0.5)).first()
    assert math.isclose(r.quantiles[0], p, rel_tol=1e-15) and r.n == 200_000


# ---------------------------------------------------------------------------
# Second moments.
# ---------------------------------------------------------------------------
FEATURES = [f"x{i}" for i in range(5)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 5)) * [1, 30, 0.1, 5, 1] + [1e3, -300, 0, 20, 7]
    x[:, 4] = 7.0  # without variance
    y = 2.0 * x[:, 0] - 0.3 * x[:, 1] + 9 * x[:, 2] + rng.normal(size=600) * 3 + 100
    rows = [(int(i % 12), *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "day int, " + ", ".join(f"{c} double" for c in FEATURES) + ", y double").cache()


@pytest.mark.parametrize("reg, mixing", [(0.3, 0.8), (0.0, 0.0), (2.0, 1.0), (5.0, 0.0), (40.0, 1.0)])
def test_elastic_net_has_mllibs_coefficients(spark, data, reg, mixing):
    m = combine_moments(second_moments(data, "day", [*FEATURES, "y"]), [*FEATURES, "y"])
    got = elastic_net(m, "y", reg, mixing)
    train = assemble(data, FEATURES)
    want = fit_linear(train, label="y", max_iter=2_000, reg_param=reg, elastic_net=mixing)
    want_tight = want if reg == 0 else _tight(train, reg, mixing)
    assert np.allclose(got.coefficients, want_tight.coefficients.toArray(), rtol=1e-6, atol=1e-6)
    assert math.isclose(got.intercept, want_tight.intercept, rel_tol=1e-6, abs_tol=1e-3)
    assert math.isclose(got.rmse, want_tight.summary.rootMeanSquaredError, rel_tol=1e-6)
    assert math.isclose(got.r2, want_tight.summary.r2, abs_tol=1e-6) and m.n == 600


def _tight(train, reg, mixing):
    from pyspark.ml.regression import LinearRegression

    return LinearRegression(labelCol="y", maxIter=5_000, tol=1e-14, regParam=reg, elasticNetParam=mixing).fit(train)


def test_days_are_read_once_and_replaced(spark, data, scratch):
    table = KeyedTable(f"{scratch}/moments", keys=["day"])
    columns = [*FEATURES, "y"]
    refresh_moments(data.where("day < 6"), "day", columns, table)
    refresh_moments(data.where("day >= 6").withColumn("y", F.lit(0.0)), "day", columns, table)  # wrong at first
    refresh_moments(data.where("day >= 6"), "day", columns, table)
    assert table.read(spark).count() == 12
    m = combine_moments(table.read(spark), columns)
    x = np.array([[r[c] for c in columns] for r in data.collect()])
    assert np.allclose(m.mean, x.mean(0), rtol=1e-13) and np.allclose(m.cov, np.cov(x.T, bias=True), rtol=1e-9, atol=1e-9)


def test_the_fit_is_a_model_to_save_and_apply(spark, data, scratch):
    m = combine_moments(second_moments(data, "day", [*FEATURES, "y"]), [*FEATURES, "y"])
    fit = elastic_net(m, "y")
    model = load_model(save_model(as_model(spark, fit), f"{scratch}/models", "v1"))
    rows = predict(model, assemble(data, FEATURES)).select("prediction", *FEATURES).limit(20).collect()
    assert all(math.isclose(r.prediction, fit.intercept + sum(w * r[c] for w, c in zip(fit.coefficients, FEATURES)), rel_tol=1e-12) for r in rows)
    assert evaluate(model.setPredictionCol("prediction"), assemble(data.withColumnRenamed("y", "label"), FEATURES)).first().rmse > 0


def test_moments_of_nulls_single_rows_and_nothing(spark):
    rows = [(1, 2.0, 3.0), (1, None, 4.0), (None, 1.0, 1.0), (2, 5.0, 6.0)]
    df = spark.createDataFrame(rows, "day int, x double, y double")
    m = combine_moments(second_moments(df, "day", ["x", "y"]), ["x", "y"])
    assert m.n == 2 and m.mean.tolist() == [3.5, 4.5] and np.allclose(m.cov, [[2.25, 2.25], [2.25, 2.25]])
    none = combine_moments(second_moments(df.limit(0), "day", ["x", "y"]), ["x", "y"])
    with pytest.raises(ValueError, match="no rows"):
        elastic_net(none, "y")
    one = elastic_net(combine_moments(second_moments(df.where("day = 2"), "day", ["x", "y"]), ["x", "y"]), "y")
    assert one.coefficients.tolist() == [0.0] and one.intercept == 6.0
