"""Grouped aggregates (D1-D6, D11) and the group-wise mode.

Everything here is algebraic (avg, count, min/max of a struct), so Spark runs a
partial aggregate before each shuffle: a bucket or category holding a large
share of all rows is pre-combined on the map side and never lands whole in one
task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def exact_avg(c: str | Column, scale: int) -> Column:
    """Average of a measure with ``scale`` decimals, from an exact 64-bit sum of its scaled units.

    ``avg`` of doubles depends on summation order, so its last bits change with
    partitioning; this form gives the same double on every run and engine
    (sum of units / (count * 10^scale)). An overflowing sum raises (ANSI) rather
    than returning a wrong value.
    """
    col = F.col(c) if isinstance(c, str) else c
    unit = 10 ** int(scale)
    return F.sum(F.round(col * F.lit(unit)).cast("bigint")).cast("double") / (
        F.count(col).cast("double") * F.lit(float(unit)))


def group_averages(df: DataFrame, keys: str | Sequence[str], averages: Mapping[str, str | Column],
                   truncated: Sequence[str] = (), exact_scales: Mapping[str, int] | None = None) -> DataFrame:
    """``avg`` of each measure per group (NULLs skipped); ``truncated`` aliases become int (H5).

    ``exact_scales`` maps an alias to the number of decimals of its measure, to
    average it exactly (``exact_avg``) instead of by floating summation.
    """
    exact_scales = exact_scales or {}
    aggs = [
        (exact_avg(c, exact_scales[a]) if a in exact_scales else F.avg(F.col(c) if isinstance(c, str) else c)).alias(a)
        for a, c in averages.items()
    ]
    out = df.groupBy(*_cols(keys)).agg(*aggs)
    if truncated:
        out = out.withColumns({a: F.col(a).cast("int") for a in truncated})
    return out


def distinct_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Full-row distinct (or on ``subset``). Run it *after* bucketing and *before*
    dropping columns to keep the original semantics (two equal readings of one city in
    a bucket collapse; equal readings of two cities do not)."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def count_by(df: DataFrame, *keys: str, alias: str = "count") -> DataFrame:
    """Rows per group; a NULL key is its own group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def global_max(df: DataFrame, column: str, alias: str | None = None) -> DataFrame:
    """One-row maximum."""
    return df.agg(F.max(column).alias(alias or f"max_{column}"))


def _mode_pick(count: Column, category: Column) -> Column:
    # Smallest struct = highest count, then non-NULL before NULL, then smallest value.
    return F.struct((-count).alias("neg_count"), category.isNull().alias("is_null"), category.alias("value"))


def mode_per_group(df: DataFrame, keys: str | Sequence[str], category: str, alias: str,
                   count_alias: str | None = None) -> DataFrame:
    """Most frequent ``category`` per group, NULL counted as a category.

    Ties go to the smallest value, NULL last (the original ranking left ties to
    chance). Implemented as two partial-aggregated group-bys instead of a window
    over each group, so a hot group is never sorted in one task.
    """
    keys = _cols(keys)
    counts = df.groupBy(*keys, category).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*keys).agg(F.min(_mode_pick(F.col("_n"), F.col(category))).alias("_m"))
    cols = [*keys, F.col("_m.value").alias(alias)]
    if count_alias:
        cols.append((-F.col("_m.neg_count")).alias(count_alias))
    return best.select(*cols)


def mode_aggregate(df: DataFrame, keys: str | Sequence[str], category: str, alias: str) -> DataFrame:
    """SQL ``mode()``; ignores NULLs, smallest value on ties; NULL for a group without other values. Equals E1 when no NULLs.

    In two partial aggregates, as E1: Spark's own ``mode`` holds all of a group's different values in one buffer.
    """
    keys = _cols(keys)
    counts = df.groupBy(*keys, category).agg(F.count(category).alias("_n"))  # 0 for NULL
    best = counts.groupBy(*keys).agg(F.min(_mode_pick(F.col("_n"), F.col(category))).alias("_m"))
    return best.select(*keys, F.col("_m.value").alias(alias))


def modes_and_averages(df: DataFrame, key: str, modes: Mapping[str, str], averages: Mapping[str, str],
                       truncated: Sequence[str] = (), exact_scales: Mapping[str, int] | None = None) -> DataFrame:
    """L2 core in one shared pass: several E1 modes and D2 averages per ``key``.

    One Expand + partial aggregate over grouping sets ``(key, c1) ... (key, cN), (key)``
    computes every category count and every average with a single shuffle; a second
    group-by on ``key`` picks each mode and carries the averages. This replaces
    N+1 separate aggregations of the same rows and N joins on ``key``.
    """
    exact_scales = exact_scales or {}
    mode_items = list(modes.items())
    sets = [[key, c] for _, c in mode_items] + [[key]]
    first = (
        df.groupingSets(sets, key, *[c for _, c in mode_items])
        .agg(
            F.grouping_id().alias("_gid"),
            F.count(F.lit(1)).alias("_n"),
            *[(exact_avg(c, exact_scales[a]) if a in exact_scales else F.avg(c)).alias(a)
              for a, c in averages.items()],
        )
    )
    # grouping_id bit i is 1 when the i-th grouping column is absent from the set.
    n_cols = 1 + len(mode_items)
    picks = []
    for idx, (alias, col) in enumerate(mode_items):
        present_only = (1 << (n_cols - 1)) - 1 - (1 << (n_cols - 2 - idx))
        picks.append(
            F.min(F.when(F.col("_gid") == present_only, _mode_pick(F.col("_n"), F.col(col)))).alias(f"_m{idx}")
        )
    key_only = (1 << (n_cols - 1)) - 1
    carry = [F.max(F.when(F.col("_gid") == key_only, F.col(a))).alias(a) for a in averages]
    second = first.groupBy(key).agg(*picks, *carry)
    out = second.select(
        key,
        *[F.col(f"_m{idx}.value").alias(alias) for idx, (alias, _) in enumerate(mode_items)],
        *[F.col(a) for a in averages],
    )
    if truncated:
        out = out.withColumns({a: F.col(a).cast("int") for a in truncated})
    return out
