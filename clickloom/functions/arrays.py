"""Column expressions over one row's list; none of them moves rows."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.scalar import epoch_seconds, recency


def map_with(a: Column, value: Column, fn: Callable[[Column, Column], Column]) -> Column:
    """fn(element, value) for each element, with `value` computed once per row.

    A column used inside a lambda can be replaced by the expression it stands for when
    projections are merged, and would then be computed again for every element.
    """
    return F.zip_with(a, F.array_repeat(value, F.size(a)), fn)


def empty_list(element: str) -> Column:
    return F.array().cast(f"array<{element}>")


def or_empty(a: Column, element: str) -> Column:
    """Null list to empty list, elements cast."""
    return F.coalesce(a.cast(f"array<{element}>"), empty_list(element))


def divided(a: Column, by: float) -> Column:
    return F.transform(a, lambda x: x.cast("double") / F.lit(by))


def epoch_list(a: Column, dtype: T.ArrayType) -> Column:
    return F.transform(a, lambda x: epoch_seconds(x, dtype.elementType))


def head(a: Column, n: int) -> Column:
    return F.slice(a, 1, n)


def tail(a: Column, n: int) -> Column:
    """Last `n` elements; a shorter list is kept whole (a negative start would lose it)."""
    return F.slice(a, F.greatest(F.size(a) - F.lit(n - 1), F.lit(1)), F.lit(n))


def zeros(n: Column | int, element: str = "double") -> Column:
    count = F.lit(n) if isinstance(n, int) else n
    return F.array_repeat(F.lit(0).cast(element), count)


def pad_left(a: Column, n: int, element: str = "double") -> Column:
    """Zeros first, so the last element always sits at index n-1."""
    return F.concat(zeros(F.lit(n) - F.size(a), element), a.cast(f"array<{element}>"))


def pad_right(a: Column, n: int, element: str = "double") -> Column:
    """Zeros last, so the last element sits at index size-1."""
    return F.concat(a.cast(f"array<{element}>"), zeros(F.lit(n) - F.size(a), element))


def valid_mask(ids: Column) -> Column:
    """True where an id is a real one; 0 stands for padding or unknown."""
    return F.transform(ids, lambda x: x != F.lit(0))


def real_ids(ids: Column) -> Column:
    return F.filter(ids, lambda x: x != F.lit(0))


def not_clicked(inview: Column, clicked: Column) -> Column:
    """In-view ids without the clicked ones: distinct, in order of first appearance."""
    return F.array_except(inview, clicked)


def click_flags(inview: Column, clicked: Column) -> Column:
    """1 for each in-view id that was clicked, else 0."""
    return map_with(inview, clicked, lambda x, c: F.array_contains(c, x).cast("int"))


def flagged(ids: Column, flags: Column) -> Column:
    """Ids whose parallel flag equals 1, in order."""
    pairs = F.zip_with(ids, flags, lambda i, f: F.struct(i.alias("id"), f.alias("flag")))
    return F.transform(F.filter(pairs, lambda p: p["flag"] == F.lit(1)), lambda p: p["id"])


def recency_list(read_ts: Column, imp_ts: Column) -> Column:
    """log(1 + hours) between each read and the impression."""
    return map_with(read_ts, imp_ts, lambda read, imp: recency(imp, read))


def sinusoidal(x: Column, dim: int = 16, base: float = 10000.0) -> Column:
    """Sine block, then cosine block, over dim/2 geometric frequencies."""
    half = dim // 2
    freqs = F.array(*[F.lit(math.exp(-j * math.log(base) / half)) for j in range(half)])
    angles = map_with(freqs, x, lambda f, v: v * f)
    return F.concat(F.transform(angles, F.sin), F.transform(angles, F.cos))
