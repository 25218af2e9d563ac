"""Small operators: name cleaning (H10), reject split (B12), aliased sorted projection (B5/F1),
global max (D6), random split (G2), seeded sample (D10), serving read (A13)."""

from pyspark.sql import functions as F

from tempora.functions.jsonops import clean_column_names
from tempora.operators.aggregates import global_max
from tempora.operators.ml import random_split
from tempora.operators.profile import pair_sample
from tempora.operators.projections import select_aliased, split_by, status_ok
from tempora.sources.files import read_serving_table


def test_clean_column_names(spark):
    df = spark.createDataFrame([(1, 2.0)], "`ISO3 Code` int, `Price (EUR/MWhe)` double")
    assert clean_column_names(df).columns == ["ISO3_Code", "Price__EUR_MWhe_"]


def test_split_by_keeps_every_row(spark):
    df = spark.createDataFrame([(200,), (404,), (None,)], "cod int")
    ok, rejected = split_by(df, status_ok("cod"))
    assert [r.cod for r in ok.collect()] == [200]
    assert sorted(r.cod or 0 for r in rejected.collect()) == [0, 404]


def test_select_aliased_sorted_by_source_column(spark):
    df = spark.createDataFrame([(3, 30.0, "c"), (1, 10.0, "a"), (2, 20.0, "b")], "dt int, main_temp double, n string")
    out = select_aliased(df, {"main_temp": "temp", "n": "city name"}, order_by="dt")
    assert out.columns == ["temp", "city name"]
    assert [r["city name"] for r in out.collect()] == ["a", "b", "c"]


def test_global_max_random_split_and_sample(spark, scratch):
    df = spark.range(1000).select(F.col("id").alias("x"), (F.col("id") * 2).alias("y"))
    assert global_max(df, "x").first()[0] == 999
    a, b = random_split(df, seed=7)
    assert a.count() + b.count() == 1000 and a.count() > b.count()
    s1 = pair_sample(df, "x", "y", 0.1, seed=3).collect()
    assert s1 == pair_sample(df, "x", "y", 0.1, seed=3).collect() and 0 < len(s1) < 1000
    df.write.parquet(f"{scratch}/t")
    assert read_serving_table(spark, f"{scratch}/t", ["y"]).columns == ["y"]


def test_sketch_profiles_track_exact_ones(spark):
    from tempora.operators.profile import box_stats, numeric_histogram

    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    exact = {r.event_type: r for r in box_stats(ev, "event_type", "value", exact=True).collect()}
    approx = {r.event_type: r for r in box_stats(ev, "event_type", "value", exact=False).collect()}
    assert set(exact) == set(approx)
    for k, e in exact.items():
        a = approx[k]
        assert a.n == e.n
        for q in ("q1", "median", "q3"):
            assert abs(getattr(a, q) - getattr(e, q)) <= 0.02 * (e.q3 - e.q1 + 1e-9) + 1.0
    h_exact = numeric_histogram(ev, "value", bins="auto", exact=True)
    h_approx = numeric_histogram(ev, "value", bins="auto", exact=False)
    assert h_exact.agg(F.sum("count")).first()[0] == h_approx.agg(F.sum("count")).first()[0] == ev.count()


def test_histogram_leaves_out_values_that_are_not_finite(spark):
    from tempora.operators.profile import numeric_histogram

    values = [0.0, 1.0, 2.0, 4.0, float("nan"), float("inf"), float("-inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = numeric_histogram(df, "x", bins=2).orderBy("bin").collect()
    assert [(r.bin, r.bin_lo, r.bin_hi, r["count"]) for r in got] == [(0, 0.0, 2.0, 2), (1, 2.0, 4.0, 2)]
    assert numeric_histogram(df, "x").agg(F.sum("count")).first()[0] == 4
    assert numeric_histogram(df.where("x IS NULL OR isnan(x)"), "x").count() == 0


def test_read_csv_with_declared_schema(spark, scratch):
    from tempora.sources.files import read_csv

    path = f"{scratch}/p.csv"
    with open(path, "w") as f:
        f.write("Country,Price\nBelgium,100.5\nFrance,90\n")
    df = read_csv(spark, path, schema="Country string, Price double")
    assert dict(df.dtypes) == {"Country": "string", "Price": "double"}
    assert sorted((r.Country, r.Price) for r in df.collect()) == [("Belgium", 100.5), ("France", 90.0)]
