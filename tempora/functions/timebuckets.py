"""Time handling as Column expressions (all JVM-side, codegen-friendly).

Convention: an *epoch* column is 64-bit whole seconds since 1970-01-01 UTC; a
*bucket* is the start instant of a fixed-width interval aligned to the epoch.
Results are ``timestamp_ntz`` so they read back identically in any session zone
(the session itself runs in UTC, see ``tempora.session``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tempora.constants import BUCKET_SECONDS, DROP_NAME_FORMAT, DROP_NAME_PREFIX_LENGTH, PRICE_TEXT_FORMAT


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Timestamp (zoned or ntz) -> whole epoch seconds, floored (H4 inverse)."""
    return F.unix_seconds(_col(ts).cast("timestamp"))


def epoch_micros(ts: str | Column) -> Column:
    return F.unix_micros(_col(ts).cast("timestamp"))


def seconds_to_ts(epoch: str | Column) -> Column:
    """Epoch seconds -> ``timestamp_ntz`` (H4)."""
    return F.timestamp_seconds(_col(epoch)).cast("timestamp_ntz")


def floor_to_width(epoch: str | Column, width_seconds: int = BUCKET_SECONDS) -> Column:
    """Epoch seconds floored to a multiple of ``width_seconds`` (64-bit, exact).

    The original ``int(x / w) * w`` truncates toward zero and overflows 32 bits
    after 2038; ``x - pmod(x, w)`` floors and stays in 64 bits. Both agree for
    non-negative epochs before 2038.
    """
    e = _col(epoch).cast("bigint")
    return e - F.pmod(e, F.lit(int(width_seconds)))


def bucket_start(epoch: str | Column, width_seconds: int = BUCKET_SECONDS, shift_seconds: int = 0) -> Column:
    """H1 (+H3): start of the ``width_seconds`` bucket of an epoch, after an optional shift."""
    e = _col(epoch).cast("bigint")
    if shift_seconds:
        e = e + F.lit(int(shift_seconds))
    return seconds_to_ts(floor_to_width(e, width_seconds))


def ts_bucket_start(ts: str | Column, width_seconds: int = BUCKET_SECONDS, shift_seconds: int = 0) -> Column:
    """H1 for a timestamp column: floors to whole seconds, then to the bucket."""
    return bucket_start(epoch_seconds(ts), width_seconds, shift_seconds)


# Text layouts accepted for event times: plain, with a fraction, 'T' separated, bare date.
ACCEPTED_TIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd",
)


def parse_time_text(text: str | Column, formats: tuple[str, ...] = (PRICE_TEXT_FORMAT,)) -> Column:
    """H2: text -> timestamp, trying ``formats`` in order; NULL when none parses.

    Replaces the lenient LEGACY parser (which accepted trailing garbage): every
    pattern must match the whole text, and unparsed rows are left NULL so that
    callers can route them to a reject table instead of failing the job.
    """
    t = F.trim(_col(text))
    parsed = [F.try_to_timestamp(t, F.lit(fmt)) for fmt in formats]
    return (F.coalesce(*parsed) if len(parsed) > 1 else parsed[0]).cast("timestamp_ntz")


def parse_time_epoch(text: str | Column, formats: tuple[str, ...] = (PRICE_TEXT_FORMAT,)) -> Column:
    """H2 as in the price job: text -> epoch seconds (NULL when unparsable)."""
    return epoch_seconds(parse_time_text(text, formats))


def drop_name_time(name: str | Column) -> Column:
    """H8: the leading ``yyyy-MM-dd-HH-mm-ss`` of a drop name as a timestamp (NULL if bad)."""
    prefix = F.substring(_col(name), 1, DROP_NAME_PREFIX_LENGTH)
    return F.try_to_timestamp(prefix, F.lit(DROP_NAME_FORMAT)).cast("timestamp_ntz")


def minus_interval(as_of: str | Column, interval: str) -> Column:
    """``as_of - INTERVAL`` with the interval given as text, e.g. '9 hours 30 minutes'."""
    base = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    return base - F.expr(f"INTERVAL {interval}")


def plus_seconds(ts: str | Column, seconds: str | Column) -> Column:
    """Timestamp + a (possibly per-row) number of seconds, exact to the microsecond."""
    return F.timestamp_micros(epoch_micros(ts) + _col(seconds).cast("bigint") * F.lit(1_000_000)).cast(
        "timestamp_ntz"
    )
