"""Lookup join for skewed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join a one-row-per-key table to rows of which a third may share one key.

    A small table is broadcast, by Spark's own size check. Beyond that Spark splits a hot
    key's partition at run time, but only where both inputs of the join are plain
    exchanges: a table that is itself an aggregate or join on the key would bring its
    partitioning along and switch that off. Wrapping the key in a struct gives the table
    an exchange of its own, one row per key, and leaves the hot rows free to be split.
    """
    wrapped = F.struct(key)
    keyed = table.where(F.col(key).isNotNull()).withColumn("_key", wrapped).drop(key)
    return rows.withColumn("_key", wrapped).join(keyed, "_key", how).drop("_key")
