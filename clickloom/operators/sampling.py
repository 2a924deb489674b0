"""Reproducible negative sampling, computed inside each impression's row.

A draw is an md5 key over (seed, impression, positive, article), so the sample does
not depend on partitioning, and no window, sort or exchange is needed: an
impression already holds all its candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import arrays
from clickloom.functions.hashing import hash_key, hash_number

POLICIES = ("per_click", "padded", "cycled")


def _positive(seed: int, mode: str) -> Column:
    """The chosen click: smallest hash key, or the first one in validation mode."""
    if mode == "first":
        return F.get("_clk", F.lit(0))
    keyed = F.transform(
        F.array_distinct("_clk"),
        lambda x: F.struct(hash_key(seed, F.col("impression_id"), x).alias("k"), x.alias("id")),
    )
    return F.array_min(keyed)["id"]


def _shuffled_pool(seed: int) -> Column:
    keyed = F.transform(
        arrays.not_clicked(F.col("_inv"), F.col("_clk")),
        lambda x: F.struct(
            hash_key(seed, F.col("impression_id"), F.col("positive"), x).alias("k"), x.alias("id")
        ),
    )
    return F.transform(F.array_sort(keyed), lambda s: s["id"])


def _draws(policy: str, ratio: int, seed: int) -> Column:
    """`ratio` negatives out of `_pool`; each policy fills a short pool its own way."""
    pool, size = F.col("_pool"), F.size("_pool")
    steps = F.sequence(F.lit(0), F.lit(ratio - 1))
    whole = F.slice(pool, 1, ratio)
    if policy == "padded":
        missing = F.lit(ratio) - size
        return F.concat(whole, F.array_repeat(F.lit(0).cast("bigint"), missing))

    def pick(i: Column) -> Column:
        if policy == "cycled":
            return F.get(pool, F.pmod(i, size))
        key = hash_key(seed, F.col("impression_id"), F.col("positive"), i)
        return F.get(pool, F.pmod(hash_number(key), size.cast("bigint")).cast("int"))

    return (
        F.when(size >= ratio, whole)
        .when(size == 0, F.array_repeat(F.col("positive"), ratio))
        .otherwise(F.transform(steps, pick))
    )


def sample_candidates(
    behaviors: DataFrame,
    policy: str,
    ratio: int = 4,
    seed: int = 42,
    no_click: str = "skip",
    mode: str = "random",
    inview: str = "article_ids_inview",
    clicked: str = "article_ids_clicked",
) -> DataFrame:
    """One positive and `ratio` negatives per sample, as a struct list `candidates`.

    'per_click': a sample per distinct click; a short pool is drawn from with
    replacement. 'padded' and 'cycled': a sample per impression, its positive a
    hash-chosen click; a short pool is filled with id 0 (marked not valid) or cycled.
    An empty pool repeats the positive, except under 'padded'.
    mode='first' (only 'padded'): first click, pool in in-view order.
    no_click='first_inview': an impression without clicks takes its first in-view
    article as the positive (a false label, for comparison only); default skips it.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown sampling policy {policy!r}")
    lists = (
        behaviors.withColumn("_inv", arrays.or_empty(F.col(inview), "bigint"))
        .withColumn("_clk", arrays.or_empty(F.col(clicked), "bigint"))
    )
    if policy == "per_click":
        chosen = lists.withColumn("positive", F.explode(F.array_distinct("_clk")))
    else:
        first = F.get("_inv", F.lit(0)) if no_click == "first_inview" else F.lit(None).cast("bigint")
        if no_click == "first_inview" and policy == "cycled":
            first = F.coalesce(first, F.lit(0).cast("bigint"))
        chosen = lists.withColumn("positive", F.coalesce(_positive(seed, mode), first)).where(
            F.col("positive").isNotNull()
        )
    in_order = policy == "padded" and mode == "first"
    pool = arrays.not_clicked(F.col("_inv"), F.col("_clk")) if in_order else _shuffled_pool(seed)
    drawn = chosen.withColumn("_pool", pool).withColumn("_neg", _draws(policy, ratio, seed))
    # Only a padded list holds candidates beyond its pool.
    fillable = F.size("_pool") if policy == "padded" else F.lit(ratio)
    built = F.transform(
        F.concat(F.array("positive"), F.col("_neg")),
        lambda x, i: F.struct(
            i.alias("pos"),
            x.alias("article_id"),
            (i == 0).cast("int").alias("label"),
            (i <= fillable).alias("valid"),
        ),
    )
    return (
        drawn.withColumn("pool_size", F.size("_pool"))
        .withColumn("candidates", built)
        .drop("_inv", "_clk", "_pool", "_neg")
    )


def shuffle_samples(samples: DataFrame, keys: list[str], seed: int = 42) -> DataFrame:
    """Full reproducible shuffle without a global sort: hash partitions, hash order inside."""
    key = hash_key(seed, *[F.col(k) for k in keys])
    return (
        samples.withColumn("shuffle_key", key)
        .repartition(F.col("shuffle_key"))
        .sortWithinPartitions("shuffle_key")
    )
