"""User histories: long form, the three cut policies, padding, cold start.

A history item travels as one struct, so its id, scroll, time and second can never
drift apart. Cuts are row_number filters, which Spark applies before the exchange
as well: a user with a third of all reads still sends at most `n` rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.functions import arrays, scalar
from clickloom.operators.joins import lookup

LIST_COLUMNS = (
    "article_id_fixed",
    "scroll_percentage_fixed",
    "read_time_fixed",
    "impression_time_fixed",
)


def explode_history(history: DataFrame) -> DataFrame:
    """Four parallel lists to one row per item; a user without items keeps one null row.

    The id list says how many items there are: a shorter list gives nulls at its end, and what
    a longer one has beyond is left out (`misaligned_histories` counts such rows).
    """
    ids, *others = LIST_COLUMNS
    names = ("article_id", "scroll_percentage", "read_time", "impression_time")
    items = F.transform(ids, lambda x, i: F.struct(
        x.alias("article_id"),
        *[F.get(c, i).alias(n) for c, n in zip(others, names[1:], strict=True)],
    ))
    return history.select("user_id", F.posexplode_outer(items).alias("pos", "item")).select(
        "user_id", "pos", *[F.col("item")[n].alias(n) for n in names]
    )


def misaligned_histories(history: DataFrame) -> DataFrame:
    """`n_rows` and, of those, `n_misaligned`: rows whose lists differ in length (null: 0)."""
    sizes = [F.coalesce(F.size(F.col(c)), F.lit(0)) for c in LIST_COLUMNS]
    sizes = [F.greatest(s, F.lit(0)) for s in sizes]
    uneven = F.greatest(*sizes) != F.least(*sizes)
    return history.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(uneven).alias("n_misaligned"))


def clean_items(items: DataFrame) -> DataFrame:
    """Scroll in [0, 1] and read time with null and NaN as 0, log read time, epoch second."""
    ts = scalar.epoch_seconds(F.col("impression_time"), items.schema["impression_time"].dataType)
    keep = [c for c in items.columns if c not in ("scroll_percentage", "read_time", "impression_time")]
    return items.select(
        *keep,
        (scalar.or_zero(F.col("scroll_percentage")) / F.lit(100.0)).alias("scroll"),
        scalar.or_zero(F.col("read_time")).alias("read_time"),
        scalar.log_read_time(F.col("read_time")).alias("log_time"),
        ts.alias("ts"),
    )


def cut_history(
    items: DataFrame, policy: str, n: int, stored: Sequence[str], time: str = "impression_time"
) -> DataFrame:
    """At most `n` items per user.

    'head': the first in stored order; 'tail': the last in stored order; 'recent':
    the last by time, equal times in stored order. `stored` names the columns that
    give the stored order and must be unique per user. Null items are dropped.
    """
    if policy == "head":
        order = [F.asc(c) for c in stored]
    elif policy in ("tail", "recent"):
        order = [F.desc(c) for c in _oldest_first(policy, stored, time)]
    else:
        raise ValueError(f"unknown history policy {policy!r}")
    w = W.partitionBy("user_id").orderBy(*order)
    return (
        items.where(F.col("article_id").isNotNull())
        .withColumn("_age", F.row_number().over(w))
        .where(F.col("_age") <= n)
        .drop("_age")
    )


def _oldest_first(policy: str, stored: Sequence[str], time: str) -> list[str]:
    return [time, *[c for c in stored if c != time]] if policy == "recent" else list(stored)


CLEAN_FIELDS = ("article_id", "scroll", "read_time", "log_time", "ts")


def history_lists(
    items: DataFrame,
    policy: str,
    n: int,
    stored: Sequence[str],
    fields: Sequence[str] = CLEAN_FIELDS,
    time: str = "impression_time",
) -> DataFrame:
    """One row per user: `hist`, an array of at most `n` item structs, oldest first.

    Raw items are cut first and cleaned after, so only the kept ones are computed on;
    the lists ride on the cut's exchange.
    """
    cut = cut_history(items, policy, n, stored, time)
    order = _oldest_first(policy, stored, time)
    cut = cut.withColumns({f"_o{i}": F.col(c) for i, c in enumerate(order)})
    rows = clean_items(cut) if set(fields) - set(items.columns) else cut
    item = F.struct(*[f"_o{i}" for i in range(len(order))], *fields)
    kept = F.transform(
        F.array_sort(F.collect_list(item)), lambda x: F.struct(*[x[f].alias(f) for f in fields])
    )
    return rows.groupBy("user_id").agg(kept.alias("hist"))


def list_items(lists: DataFrame) -> DataFrame:
    """Items of the kept lists in long form.

    Several profiles made from one list table share its scan and exchange; separate cuts
    would read only their own columns and so repeat both.
    """
    return lists.select("user_id", F.inline_outer("hist")).where(F.col("article_id").isNotNull())


def field(hist: str, name: str) -> Column:
    """One field of a struct list, as a list."""
    return F.col(hist)[name]


def padded(lists: DataFrame, n: int, side: str, fields: Sequence[str]) -> DataFrame:
    """Fixed-length lists per user, zeros on the given side."""
    pad = arrays.pad_left if side == "left" else arrays.pad_right
    types = lists.schema["hist"].dataType.elementType
    return lists.select(
        "user_id",
        *[pad(field("hist", f), n, types[f].dataType.simpleString()).alias(f) for f in fields],
    )


def with_history(behaviors: DataFrame, lists: DataFrame) -> DataFrame:
    """Attach each impression's user history; an absent user gets an empty list."""
    element = lists.schema["hist"].dataType.simpleString()
    joined = lookup(behaviors, lists, "user_id")
    return joined.withColumn("hist", F.coalesce("hist", F.array().cast(element)))


def with_padded_history(
    behaviors: DataFrame, lists: DataFrame, n: int, side: str, fields: Sequence[str]
) -> DataFrame:
    """Attach fixed-length lists; an absent user gets all zeros."""
    wide = padded(lists, n, side, fields)
    joined = lookup(behaviors, wide, "user_id")
    for f in fields:
        element = wide.schema[f].dataType.elementType.simpleString()
        joined = joined.withColumn(f, F.coalesce(f, arrays.zeros(n, element)))
    return joined


def history_sizes(items: DataFrame) -> DataFrame:
    """Items per user."""
    return items.groupBy("user_id").agg(F.count("article_id").alias("n_items"))
