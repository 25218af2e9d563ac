"""Scalar Column helpers: unit conversion, truncation, formatting, series maths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tempora.constants import KELVIN_OFFSET


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncate_int(c: str | Column) -> Column:
    """H5: drop the fraction (toward zero) and keep a 32-bit int, as ``int(x)``."""
    return _col(c).cast("int")


def kelvin_to_celsius(c: str | Column) -> Column:
    """H6: Kelvin -> Celsius with 273.15 (the one-degree-off 272.15 variant is not kept)."""
    return _col(c) - F.lit(KELVIN_OFFSET)


def two_decimals(c: str | Column) -> Column:
    """H12, numeric form: the value of its '%.2f' text, as the original's views return it.

    '%.2f' rounds the exact binary value (1.005 is 1.00499... and gives 1.00),
    whereas ``round(x, 2)`` rounds the shortest decimal text half-up (1.01);
    formatting then parsing keeps the original's numbers. NaN and infinity stay.
    """
    x = _col(c).cast("double")
    special = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(special, x).otherwise(two_decimals_text(c).try_cast("double"))


def two_decimals_text(c: str | Column) -> Column:
    """H12, text form: '%.2f' without thousands separators (e.g. '1013.00')."""
    return F.call_function("format_number", _col(c), F.lit("0.00"))


def split_pair(text: str | Column, sep: str = ",") -> tuple[Column, Column]:
    """H7: "a,b" -> (a, b) as doubles; malformed parts become NULL."""
    t = _col(text)
    a = F.trim(F.split_part(t, F.lit(sep), F.lit(1))).try_cast("double")
    b = F.trim(F.split_part(t, F.lit(sep), F.lit(2))).try_cast("double")
    return a, b


def int_div(a: str | Column, b: str | Column | int) -> Column:
    """Integer division (toward zero), e.g. 3600 // 5; exact over the whole range of a long."""
    rhs = (F.lit(b) if isinstance(b, int) else _col(b)).cast("bigint")
    return F.call_function("div", _col(a).cast("bigint"), rhs)


def linspace_value(start: str | Column, stop: str | Column, i: str | Column, n: int, endpoint: bool = True) -> Column:
    """The ``i``-th of ``n`` evenly spaced values from start to stop.

    With ``endpoint`` (the default) both ends are included: i / (n - 1).
    """
    denom = (n - 1) if endpoint else n
    s, e = _col(start), _col(stop)
    if denom <= 0:
        return s
    return s + (e - s) * _col(i) / F.lit(float(denom))


def even_timestamp(start: str | Column, stop: str | Column, i: str | Column, periods: int) -> Column:
    """The ``i``-th of ``periods`` evenly spaced instants from start to stop (both ends).

    Exact integer microseconds: start + floor((stop - start) * i / (periods - 1)).
    """
    s_us = F.unix_micros(_col(start).cast("timestamp"))
    e_us = F.unix_micros(_col(stop).cast("timestamp"))
    num = (e_us - s_us) * _col(i).cast("bigint")
    d = F.lit(int(periods - 1))
    # Exact division that rounds down, for a series that runs backwards too.
    step = F.call_function("div", num - F.pmod(num, d), d)
    return F.timestamp_micros(s_us + step).cast("timestamp_ntz")


def gaussian_noise(sigma: float, seed: int) -> Column:
    """N(0, sigma^2) per row, seeded; sigma=0 gives exact zeros for checked runs."""
    if sigma == 0:
        return F.lit(0.0)
    return F.randn(seed) * F.lit(float(sigma))
