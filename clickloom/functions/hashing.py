"""Seeded hash keys: the same order on any partitioning, and in any SQL engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(seed: int, *parts: Column) -> Column:
    """Hex md5 of the seed and the parts joined by '|'; sorts like a random draw."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_number(key: Column) -> Column:
    """First 32 bits of a hex key as a non-negative BIGINT."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")


def shard_of(key: Column, shards: int, seed: int = 0) -> Column:
    """Stable shard number of a key, for readers outside Spark."""
    return F.pmod(hash_number(hash_key(seed, key)), F.lit(shards))
