"""Scalar column expressions: defaults, times, text assembly, buckets, encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECONDS_PER_DAY = 86400.0
SECONDS_PER_HOUR = 3600.0


def epoch_seconds(c: Column, dtype: T.DataType) -> Column:
    """Seconds since 1970 as DOUBLE, with microseconds.

    A zone-less timestamp goes through an interval, so the session zone never
    shifts it; a zoned one has exact microseconds; numbers are taken as seconds.
    """
    if isinstance(dtype, T.TimestampNTZType):
        since = c - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return since.cast("interval second").cast("decimal(18,6)").cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c) / F.lit(1e6)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c) * F.lit(SECONDS_PER_DAY)
    if isinstance(dtype, T.NumericType):
        return c.cast("double")
    raise TypeError(f"no epoch form for {dtype.simpleString()}")


def or_zero(c: Column) -> Column:
    """Number with null and NaN replaced by 0."""
    return F.coalesce(F.nanvl(c.cast("double"), F.lit(0.0)), F.lit(0.0))


def log_count(c: Column) -> Column:
    """log(1+x) of a count or total; a missing one counts as 0."""
    return F.log1p(F.coalesce(c.cast("double"), F.lit(0.0)))


def log_read_time(c: Column) -> Column:
    """log(1+x) of a reading time; null and NaN count as 0, negatives are clipped."""
    return F.log1p(F.greatest(or_zero(c), F.lit(0.0)))


def time_of_day(ts: Column) -> Column:
    """Fraction of the UTC day in [0, 1)."""
    return F.pmod(ts, F.lit(SECONDS_PER_DAY)) / F.lit(SECONDS_PER_DAY)


def freshness(imp_ts: Column, published: Column) -> Column:
    """log(1 + hours) between publication and impression, either way round."""
    return F.log1p(F.abs(imp_ts - published) / F.lit(SECONDS_PER_HOUR))


def recency(imp_ts: Column, read_ts: Column) -> Column:
    """log(1 + hours) since an item was read; reads after the impression count as 0."""
    return F.log1p(F.greatest((imp_ts - read_ts) / F.lit(SECONDS_PER_HOUR), F.lit(0.0)))


def full_title(title: Column, subtitle: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(subtitle, F.lit("")))


def text_head(c: Column, n: int | None) -> Column:
    """First `n` characters, or the whole text when `n` is None; null becomes ''."""
    text = F.coalesce(c, F.lit(""))
    return text if n is None else F.substring(text, 1, n)


def with_prefix(c: Column, prefix: str = "passage: ") -> Column:
    return F.concat(F.lit(prefix), c)


def bucketize(v: Column, buckets: int) -> Column:
    """Clamp to [0, 1] and cut into `buckets` codes, the top one only at exactly 1."""
    clamped = F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0))
    return (clamped * F.lit(float(buckets - 1))).cast("int")


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))
