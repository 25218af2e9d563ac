"""Exact quantiles in bounded memory: distributed selection by range refinement.

A rank is looked for in a range of values that is known to hold it, at first the whole. One pass counts the
range's rows in at most ``cells`` equal cells (equal in exponents while the ends are far apart), with each cell's
least and greatest value; the cell that holds the rank is the next range. A rank is found once its range is a single value. Every pass is a partial
aggregate with at most ``cells`` rows a range: nothing grows with the number of rows or of
distinct values. The ranges of a pass, one a quantile and group at most, are broadcast up to
BROADCAST_ROWS of them, so that a hot group isn't shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.operators.joins import BROADCAST_ROWS

CELLS = 1_024
FEW_DISTINCT = 100_000   # values of a group that Spark's own exact percentile may hold


def _curve(x: Column) -> Column:
    """By exponents: never falling, finite, 0 for 0, from 6 (the least magnitude) to 2,110 above and below."""
    return F.signum(x) * F.least(F.coalesce(F.log2(F.abs(x)), F.lit(-1080.0)) + 1080.0, F.lit(2110.0))


def _far_apart(lo: Column, hi: Column) -> Column:
    """Whether cells should follow exponents: the ends differ in sign, or by more than a factor of 4."""
    return (F.signum(lo) != F.signum(hi)) | (F.greatest(F.abs(lo), F.abs(hi)) / 4 > F.least(F.abs(lo), F.abs(hi)))


def _held(table: DataFrame, max_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, int]:
    """(table, rows) computed once: in the plan itself if there are ``max_rows`` or fewer, else in the shared checkpoint folder."""
    rows = table.limit(max_rows + 1).collect()
    return (table.sparkSession.createDataFrame(rows, table.schema) if len(rows) <= max_rows else table.checkpoint()), len(rows)


def _cell(x: Column, lo: Column, hi: Column, curved: Column, cells: int) -> Column:
    """0 to cells - 1, never falling as x grows; lo is in the first cell and hi > lo in the last."""
    def at(v: Column, a: Column, b: Column) -> Column:
        return F.least(F.floor((v - a) / (b - a) * cells), F.lit(cells - 1))

    return F.when(curved, at(_curve(x), _curve(lo), _curve(hi))).otherwise(at(x, lo, hi)).cast("int")


def group_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (), cells: int = CELLS) -> DataFrame:
    """(*by, n, quantiles): the exact quantiles of ``value`` per group, between neighbours by linear interpolation.

    Equal to SQL's ``quantile_cont``. NULL and NaN values are left out, a group without others has no
    row; infinite values stand at the ends (between a finite and an infinite neighbour the quantile is
    infinite). NULLs in ``by`` form a group. Two or three passes, as a rule; with 1,024 cells at most eight,
    since doubles have 11 bits of exponent and 52 of fraction.
    """
    if cells < 2:
        raise ValueError("cells must be 2 or more")
    keys = [F.col(c).alias(f"g{i}") for i, c in enumerate(by)]
    x = F.col(value).cast("double")
    rows = df.select(F.struct(F.lit(0).alias("all"), *keys).alias("g"), x.alias("x")).where("x IS NOT NULL AND NOT isnan(x)")
    whole = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    whole, _ = _held(whole)  # a row a group; every pass starts from it
    places = [(F.col("n") - 1).cast("double") * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(p), F.ceil(p)) for p in places])))
    targets = whole.select("g", F.explode(ranks).alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below"))
    found = targets.where("lo >= hi").select("g", "rank", "lo")
    open_, n_open = _held(targets.where("lo < hi"))
    while n_open:
        ranges = open_.select("g", "lo", "hi", _far_apart(F.col("lo"), F.col("hi")).alias("curved")).distinct()
        ranges = F.broadcast(ranges) if n_open <= BROADCAST_ROWS else ranges
        inside = rows.join(ranges, "g").where("x >= lo AND x <= hi")  # ranges of a group don't overlap: a row is in one at most
        cell = _cell(F.col("x"), F.col("lo"), F.col("hi"), F.col("curved"), cells)
        counted = inside.groupBy("g", "lo", "hi", cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("c"), F.min("x").alias("least"), F.max("x").alias("most"))
        earlier = Window.partitionBy("g", "lo", "hi").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        counted = counted.withColumn("before", F.coalesce(F.sum("c").over(earlier), F.lit(0)))
        nearer = open_.join(counted, ["g", "lo", "hi"]).where("rank >= below + before AND rank < below + before + c")
        nearer, _ = _held(nearer.select("g", "rank", F.col("least").alias("lo"), F.col("most").alias("hi"),
                                        (F.col("below") + F.col("before")).alias("below")))
        found = found.unionByName(nearer.where("lo >= hi").select("g", "rank", "lo"))
        open_, n_open = _held(nearer.where("lo < hi"))
    found = found.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "lo"))).alias("v"))  # two a quantile at most
    out = whole.join(found, "g")

    def between(place: Column) -> Column:
        a, b = F.col("v")[F.floor(place)], F.col("v")[F.ceil(place)]
        return F.when(a == b, a).otherwise(a + (b - a) * (place - F.floor(place)))

    return out.select(*[F.col(f"g.g{i}").alias(c) for i, c in enumerate(by)], "n", F.array(*[between(p) for p in places]).alias("quantiles"))


def has_few_distinct(df: DataFrame, value: str, by: Sequence[str] = (), most: int = FEW_DISTINCT) -> bool:
    """Whether every group has about ``most`` different values or fewer (a mergeable sketch, one pass)."""
    counted = df.groupBy(*by).agg(F.approx_count_distinct(value).alias("n"))
    return (counted.agg(F.max("n")).first()[0] or 0) <= most
