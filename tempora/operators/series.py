"""Ordered-series operators: predecessor pairing (E2) and up-sampling.

A window over a whole series sends the series to one task. ``previous_row``
avoids that for long series: rows are windowed per (series, chunk), and the
first row of each chunk takes its predecessor from the last row of the previous
non-empty chunk, found on a small per-chunk table (one row per series and
chunk). Chunks are spans of time, or ranges of the full sort key sampled by
Spark's range partitioner (which also split a hot series or a hot instant).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.constants import PRICE_RANGE_PERIODS, PRICE_SOURCE_STEP_SECONDS, PRICE_STEP_SECONDS
from tempora.functions.scalar import even_timestamp, gaussian_noise, linspace_value
from tempora.functions.timebuckets import epoch_seconds, floor_to_width
from tempora.operators.joins import sized_broadcast


def previous_row(df: DataFrame, series: Sequence[str], order: Sequence[str], carry: Sequence[str],
                 chunk_seconds: int | None = 86_400, time_col: str | None = None,
                 prefix: str = "prev_", chunking: str = "time", num_chunks: int | None = None) -> DataFrame:
    """Add ``prev_<c>`` for each ``carry`` column, taken from the preceding row of the series.

    ``order`` is the full sort key (time first, then a tie-breaker that makes it
    unique). Chunking decides how a series is cut into window partitions, whose
    boundaries are then stitched with a small per-chunk table:

    - ``chunking="time"``: chunks of ``chunk_seconds`` of ``time_col`` (one
      shuffle). A window task holds one series' rows of one chunk, so the width
      bounds it; rows sharing a single instant stay together.
    - ``chunking="range"``: ``num_chunks`` ranges of the full sort key, with
      boundaries sampled by Spark's range partitioner, so a hot series and even
      a hot instant are split evenly. The chunk ids are fixed once with a
      reliable ``checkpoint()`` (in ``spark.checkpoint.dir``) so that every
      branch of the plan sees the same assignment.
    - ``chunk_seconds=None`` with ``chunking="time"``: one window per series.

    The first row of a series has NULL predecessors (B14 drops it with
    ``where(prev_x IS NOT NULL)``).
    """
    series, order, carry = list(series), list(order), list(carry)
    time_col = time_col or order[0]
    chunk = "__chunk"
    if chunking == "range":
        n = num_chunks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        d = df.repartitionByRange(n, *series, *order).withColumn(chunk, F.spark_partition_id().cast("bigint"))
        from tempora.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(df.sparkSession)
        fixed = d.checkpoint(eager=True)
        # Whole chunks to tasks by range (about one chunk per task; hashing chunk ids would
        # let several collide), for the window.
        d = fixed.repartitionByRange(n, *series, chunk)
    elif chunk_seconds is None:
        w = Window.partitionBy(*series).orderBy(*order)
        return df.withColumns({f"{prefix}{c}": F.lag(c).over(w) for c in carry})
    else:
        d = df.withColumn(chunk, floor_to_width(epoch_seconds(time_col), chunk_seconds))
    w = Window.partitionBy(*series, chunk).orderBy(*order)
    d = d.withColumns({f"__lag_{c}": F.lag(c).over(w) for c in carry}).withColumn("__first", F.row_number().over(w) == 1)

    # Last row of each (series, chunk): algebraic max over the sort key, partial-aggregated.
    last = (fixed if chunking == "range" else d).groupBy(*series, chunk).agg(
        F.max(F.struct(*[F.col(o) for o in order], *[F.col(c).alias(f"v_{c}") for c in carry])).alias("__last")
    )
    # Predecessor chunk's last row, per chunk: a window over the small per-chunk table.
    wc = Window.partitionBy(*series).orderBy(chunk)
    boundary = last.select(*series, chunk, F.lag("__last").over(wc).alias("__prev_last"))
    if chunking == "range":
        boundary = sized_broadcast(boundary)
    joined = d.join(boundary, on=[*series, chunk], how="left")
    out = joined.withColumns({
        f"{prefix}{c}": F.when(F.col("__first"), F.col(f"__prev_last.v_{c}")).otherwise(F.col(f"__lag_{c}"))
        for c in carry
    })
    return out.drop(chunk, "__first", "__prev_last", *[f"__lag_{c}" for c in carry])


def first_offset(df: DataFrame, series: Sequence[str], order: Sequence[str], utc_col: str, local_col: str,
                 out: str = "offset_seconds") -> DataFrame:
    """Per series, ``local - utc`` of its first row (seconds); constant, so no daylight saving.

    The series' least time comes from a hash aggregate, and the tie-break looks only at the rows of
    that time. Both tables have one row a series and meet the rows by a size-checked broadcast, so
    that a hot series is not shuffled. Rows without a time are never first; a series of which no
    row has a time, or whose name is NULL, has a NULL offset.
    """
    series, order = list(series), list(order)
    if not series:  # one series: join on a constant key (a hash join, not a cartesian product)
        res = first_offset(df.withColumn("__one", F.lit(0)), ["__one"], order, utc_col, local_col, out)
        return res.drop("__one")
    times = sized_broadcast(df.groupBy(*series).agg(F.min(order[0]).alias("__time")))
    at_first = df.join(times, on=series).where(F.col(order[0]) == F.col("__time"))
    firsts = at_first.groupBy(*series).agg(
        F.min(F.struct(*[F.col(o) for o in order], F.col(utc_col).alias("u"), F.col(local_col).alias("l"))).alias("_f")
    ).select(*series, (F.unix_micros(F.col("_f.l").cast("timestamp")) - F.unix_micros(F.col("_f.u").cast("timestamp")))
             .alias("__offset_us"))
    return df.join(sized_broadcast(firsts), on=series, how="left").withColumn(
        out, (F.col("__offset_us") / 1_000_000)).drop("__offset_us")


def upsample_pairs(pairs: DataFrame, t0: str, t1: str, p0: str, p1: str,
                   step_seconds: int = PRICE_STEP_SECONDS, source_step_seconds: int = PRICE_SOURCE_STEP_SECONDS,
                   periods: int | None = PRICE_RANGE_PERIODS, endpoint: bool = True,
                   noise_sigma: float = 0.0, seed: int = 42, keep: Sequence[str] = ()) -> DataFrame:
    """Each consecutive pair (t0, p0) -> (t1, p1) becomes N = source_step // step rows.

    Values: ``linspace(p0, p1, N)`` (both ends included; ``endpoint=False`` keeps
    the end out) plus optional seeded noise. Times: ``periods`` evenly spaced
    instants from t0 to t1 (both ends), of which the first N are used; the
    original hard-codes 721 periods, right for 5 s over 3600 s only, so
    ``periods=None`` derives N + 1. A gap in the source stretches the same N
    points over the longer interval; ``gap_seconds`` exposes its length.
    Rows are generated inside each task from ``sequence`` (no shuffle).
    """
    n = source_step_seconds // step_seconds
    if n < 1:
        raise ValueError(f"step_seconds ({step_seconds}) must not exceed source_step_seconds ({source_step_seconds})")
    periods = periods or n + 1
    idx = "point"
    out = pairs.select(*keep, t0, t1, p0, p1, F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(idx))
    return out.select(
        *keep,
        F.col(idx),
        even_timestamp(F.col(t0), F.col(t1), F.col(idx), periods).alias("ts"),
        (linspace_value(F.col(p0), F.col(p1), F.col(idx), n, endpoint) + gaussian_noise(noise_sigma, seed)).alias(
            "price"),
        (epoch_seconds(t1) - epoch_seconds(t0)).alias("gap_seconds"),
    )
