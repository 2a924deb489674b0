"""Reading-quality predicates and buckets of one history item."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.functions.scalar import bucketize

# They decide which class an item falls in and must not be tuned.
HIGH_LOG_TIME = 4.0
HIGH_SCROLL = 0.2
LOW_LOG_TIME = 1.3
LOW_SCROLL = 0.1
MAX_LOG_TIME = 6.0
TIME_BUCKETS = 20
SCROLL_BUCKETS = 11


def is_high(log_time: Column, scroll: Column) -> Column:
    """Read long and scrolled."""
    return (log_time > F.lit(HIGH_LOG_TIME)) & (scroll > F.lit(HIGH_SCROLL))


def is_low(log_time: Column, scroll: Column) -> Column:
    """Left at once or never scrolled, unless the item counts as high."""
    skimmed = (log_time < F.lit(LOW_LOG_TIME)) | (scroll < F.lit(LOW_SCROLL))
    return skimmed & ~is_high(log_time, scroll)


def time_bucket(log_time: Column) -> Column:
    return bucketize(log_time / F.lit(MAX_LOG_TIME), TIME_BUCKETS)


def scroll_bucket(scroll: Column) -> Column:
    return bucketize(scroll, SCROLL_BUCKETS)
