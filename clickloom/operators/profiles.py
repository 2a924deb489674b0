"""User profile vectors: one row per user, computed once and joined to impressions.

Vectors meet the reads only after the cut, so at most `n` vectors per user are
shuffled, and the sums are partial aggregates. The vector table is one row per
article: Spark broadcasts it when its size is below the session's threshold and
otherwise shuffles both sides, splitting a hot article at run time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.functions import quality, scalar, vectors
from clickloom.operators.joins import lookup

DENOISE = 0.5  # fixed value, weighted through the logistic function


def article_vectors(embeddings: DataFrame, key: str, vector: str, eps: float | None = None,
                    normalize: bool = False) -> DataFrame:
    """(article_id, vector) in DOUBLE, as given or L2-normalised."""
    base = embeddings.select(
        F.col(key).alias("article_id"), vectors.as_doubles(F.col(vector)).alias("vector")
    )
    if not normalize:
        return base
    return base.select("article_id", vectors.l2_normalize(F.col("vector"), eps).alias("vector"))


def _with_item_count(cut: DataFrame) -> DataFrame:
    """Items per user after the cut; rides on the cut's own exchange."""
    return cut.withColumn("_items", F.count(F.lit(1)).over(W.partitionBy("user_id")))


def _packed(article_vecs: DataFrame) -> DataFrame:
    """Vectors in the form the summarizer takes, made once per article."""
    return article_vecs.select(
        "article_id", array_to_vector("vector").alias("_v"), F.size("vector").alias("_width")
    )


def _sum(vector: Column) -> Column:
    return vector_to_array(Summarizer.sum(vector))


def mean_profiles(cut: DataFrame, article_vecs: DataFrame, mask_unknown: bool = True) -> DataFrame:
    """(user_id, profile): mean vector of the user's items.

    mask_unknown leaves items without a vector out of the mean; otherwise they count
    as zero vectors.
    """
    items = _with_item_count(cut).select("user_id", "article_id", "_items")
    joined = lookup(items, _packed(article_vecs), "article_id", "inner")
    sums = joined.groupBy("user_id").agg(
        _sum(F.col("_v")).alias("_sum"),
        (F.count(F.lit(1)) if mask_unknown else F.first("_items")).alias("_n"),
    )
    return sums.select(
        "user_id", vectors.scaled(F.col("_sum"), F.lit(1.0) / F.col("_n")).alias("profile")
    )


def quality_profiles(cut: DataFrame, article_vecs: DataFrame) -> DataFrame:
    """(user_id, profile): overall + high-quality - sigmoid(0.5) * low-quality mean.

    Items without a vector are masked. A class without items pools uniformly over all
    the user's items, the masked ones as zero vectors; a user with no known item has
    no profile row.
    """
    log_time, scroll = F.col("log_time"), F.col("scroll")
    flagged = _with_item_count(cut).select(
        "user_id",
        "article_id",
        "_items",
        quality.is_high(log_time, scroll).alias("_high"),
        quality.is_low(log_time, scroll).alias("_low"),
    )
    items = lookup(flagged, _packed(article_vecs), "article_id", "inner")
    zero = array_to_vector(F.array_repeat(F.lit(0.0), F.col("_width")))

    def class_sum(flag: str) -> Column:
        return _sum(F.when(F.col(flag), F.col("_v")).otherwise(zero))

    sums = items.groupBy("user_id").agg(
        _sum(F.col("_v")).alias("_all"),
        class_sum("_high").alias("_sh"),
        class_sum("_low").alias("_sl"),
        F.count(F.lit(1)).alias("_n"),
        F.count_if("_high").alias("_nh"),
        F.count_if("_low").alias("_nl"),
        F.first("_items").alias("_items"),
    )
    return sums.select("user_id", _quality_view().alias("profile"))


def _quality_view() -> Column:
    """overall + high - weight * low, from the sums and counts of a user's items."""
    uniform = vectors.scaled(F.col("_all"), F.lit(1.0) / F.col("_items"))

    def pooled(total: str, count: str) -> Column:
        own = vectors.scaled(F.col(total), F.try_divide(F.lit(1.0), F.col(count)))
        return F.when(F.col(count) > 0, own).otherwise(uniform)

    overall = vectors.scaled(F.col("_all"), F.try_divide(F.lit(1.0), F.col("_n")))
    return vectors.combine_views(
        overall, pooled("_sh", "_nh"), pooled("_sl", "_nl"), scalar.sigmoid(F.lit(DENOISE))
    )


_GROUPS = 16  # groups of users per shuffle partition, so that a group's vectors stay few


def _joint_sums(rows: pa.Table) -> pa.Table:
    """Sums and counts of the users of one group, from a row per item with its vector."""
    coded = rows.column("user_id").combine_chunks().dictionary_encode(null_encoding="encode")
    users = coded.indices.to_numpy()
    order = np.argsort(users, kind="stable")
    rows, users = rows.take(pa.array(order)), users[order]
    recent, high, low = (rows.column(c).to_numpy() for c in ("_recent", "_high", "_low"))
    lists = rows.column("_v").combine_chunks()
    numbers = lists.flatten()
    if lists.null_count or numbers.null_count:
        raise ValueError("a vector is null or holds a null")
    weight = rows.column("_weight").to_numpy()
    if not (weight >= 0).all():
        raise ValueError("a vector's length is not a number")
    x = numbers.to_numpy().astype(np.float64)
    width = lists.value_lengths().to_numpy()
    begin = np.cumsum(width) - width
    starts = np.flatnonzero(np.r_[True, users[1:] != users[:-1]])
    ends = np.r_[starts[1:], len(users)]
    if (width == 0).any() or (width != np.repeat(width[starts], ends - starts)).any():
        raise ValueError("the vectors of a user's items differ in width, or are empty")
    wanted = {
        "_unit": np.where(recent, weight, 0.0), "_all": recent * 1.0, "_sh": high * 1.0, "_sl": low * 1.0,
        "_first": ~recent * 1.0,
    }
    own = width[starts]
    at = np.cumsum(own) - own
    flat = {name: np.zeros(own.sum()) for name in wanted}
    for w in np.unique(own):
        mine = np.flatnonzero(width == w)
        block = x[begin[mine][:, None] + np.arange(w)]
        firsts = np.flatnonzero(np.r_[True, users[mine][1:] != users[mine][:-1]])
        places = at[own == w][:, None] + np.arange(w)
        for name, share in wanted.items():
            part = share[mine][:, None]
            # not a product alone: an item outside the class adds nothing, whatever its numbers
            flat[name][places] = np.add.reduceat(np.where(part != 0, block * part, 0.0), firsts, axis=0)
    offsets = pa.array(np.r_[at, own.sum()].astype(np.int32))

    def most(name: str) -> pa.Array:
        column = rows.column(name)
        there = np.maximum.reduceat(column.fill_null(-1).to_numpy(), starts)
        return pa.array(there, mask=there < 0)

    def count(flag: np.ndarray) -> pa.Array:
        return pa.array(np.add.reduceat(flag.astype(np.int64), starts))

    return pa.table({
        "user_id": coded.dictionary.take(pa.array(users[starts])),
        **{name: pa.ListArray.from_arrays(offsets, pa.array(v)) for name, v in flat.items()},
        "_n": count(recent), "_nh": count(high), "_nl": count(low), "_items": most("_items"), "_heads": most("_heads"),
    })


def joint_profiles(recent: DataFrame, head: DataFrame, article_vecs: DataFrame, norm: str) -> DataFrame:
    """(user_id, similarity, uniform, quality): the profiles of three models in one pass.

    `similarity` is the mean of the `recent` items' vectors divided by the article's `norm`,
    `quality` the quality-weighted profile of the same items, `uniform` the mean of the
    `head` items with unknown ones as zeros. Each vector meets a user's items once, and all
    sums are made from one exchange by user: a user sends at most as many vectors as the cuts
    hold. A profile is null for a user without its items. Vectors must be whole, and of one
    width per user.
    """
    log_time, scroll = F.col("log_time"), F.col("scroll")
    flagged = _with_item_count(recent).select(
        "user_id", "article_id", F.lit(True).alias("_recent"), F.col("_items"), F.lit(None).cast("bigint").alias("_heads"),
        *[F.coalesce(flag(log_time, scroll), F.lit(False)).alias(c)
          for c, flag in (("_high", quality.is_high), ("_low", quality.is_low))],
    )
    first = _with_item_count(head).select(
        "user_id", "article_id", F.lit(False).alias("_recent"), F.lit(None).cast("bigint").alias("_items"),
        F.col("_items").alias("_heads"), F.lit(False).alias("_high"), F.lit(False).alias("_low"),
    )
    vecs = article_vecs.select("article_id", F.col("vector").alias("_v"), (F.lit(1.0) / F.col(norm)).alias("_weight"))
    items = lookup(flagged.unionByName(first), vecs, "article_id", "inner").drop("article_id")
    groups = _GROUPS * int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    user = items.schema["user_id"].dataType.simpleString()
    sums = items.groupBy(F.pmod(F.xxhash64("user_id"), F.lit(groups))).applyInArrow(
        _joint_sums, f"user_id {user}, _unit array<double>, _all array<double>, _sh array<double>, _sl array<double>, "
        "_first array<double>, _n bigint, _nh bigint, _nl bigint, _items bigint, _heads bigint"
    )
    known = F.col("_n") > 0
    return sums.select(
        "user_id",
        F.when(known, vectors.scaled(F.col("_unit"), F.try_divide(F.lit(1.0), F.col("_n")))).alias("similarity"),
        F.when(F.col("_heads").isNotNull(), vectors.scaled(F.col("_first"), F.lit(1.0) / F.col("_heads"))).alias("uniform"),
        F.when(known, _quality_view()).alias("quality"),
    )
