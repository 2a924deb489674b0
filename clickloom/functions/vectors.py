"""Vector expressions over ARRAY columns, evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickloom.functions.arrays import map_with


def as_doubles(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x
    )


def l2_norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))


def scaled(v: Column, by: Column) -> Column:
    return map_with(v, by, lambda x, b: x * b)


def l2_normalize(v: Column, eps: float | None = None) -> Column:
    """Divide by the length, or by length + eps.

    Without eps a zero vector stays zero, and NaN components become 0.
    """
    norm = l2_norm(v)
    if eps is not None:
        return map_with(v, norm + F.lit(eps), lambda x, n: x / n)
    return map_with(
        v, norm, lambda x, n: F.nanvl(x / F.when(n == 0, F.lit(1.0)).otherwise(n), F.lit(0.0))
    )


def combine_views(overall: Column, high: Column, low: Column, weight: Column) -> Column:
    """overall + high - weight * low, component by component."""
    boosted = F.zip_with(overall, high, lambda a, b: a + b)
    return F.zip_with(boosted, low, lambda a, b: a - weight * b)
