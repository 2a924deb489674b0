"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.plans.clicklog import ClickLog
from clickloom.plans.oracle import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, **holdouts: bool) -> Callable:
    """Register a plan over a ClickLog under a name, as a callable of (session, folder).

    `holdouts` are those of ClickLog, for queries whose feature they are.
    """

    def register(fn: Callable[[ClickLog], DataFrame]) -> Callable[[ClickLog], DataFrame]:
        QUERIES[name] = lambda spark, folder: fn(ClickLog(spark, folder, **holdouts))
        if oracle is not None:
            ORACLES[name] = with_views(oracle, **holdouts)
        return fn

    return register


def r6(c: Column | str, name: str | None = None) -> Column:
    """Round to 6 digits, with no negative zero, as DOUBLE."""
    c = F.col(c) if isinstance(c, str) else c
    rounded = F.round(c.cast("double"), 6) + F.lit(0.0)
    return rounded.alias(name) if name else rounded


def big(c: Column | str, name: str | None = None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    cast = c.cast("bigint")
    return cast.alias(name) if name else cast
