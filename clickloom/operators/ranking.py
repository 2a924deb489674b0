"""Ranks, top lists and side-by-side comparison of scored candidates.

Windows here run over one impression: the candidates of one page view, which came
out of one input row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HIT_RANK = 5  # a clicked item at this rank or better counts as a hit


def score_order(score: str = "score") -> Column:
    """Descending, null and NaN scores last."""
    return F.desc_nulls_last(F.nanvl(F.col(score), F.lit(float("-inf"))))


def rank_candidates(scored: DataFrame, keys: Sequence[str] = ("impression_id",)) -> DataFrame:
    """Add `rank`: 1 for the highest score, ties in candidate order."""
    w = W.partitionBy(*keys).orderBy(score_order(), F.asc("pos"))
    return scored.withColumn("rank", F.row_number().over(w))


def top_candidates(
    scored: DataFrame, n: int = 3, keys: Sequence[str] = ("impression_id",)
) -> DataFrame:
    """The `n` best candidates per impression; the limit is applied before the exchange too."""
    return rank_candidates(scored, keys).where(F.col("rank") <= n)


def clicked_ranks(ranked: DataFrame, keys: Sequence[str] = ("impression_id",)) -> DataFrame:
    """Each clicked article's first position, its rank, list length and hit mark."""
    sized = ranked.withColumn("n_candidates", F.count(F.lit(1)).over(W.partitionBy(*keys)))
    first = F.min_by(F.struct("pos", "rank", "n_candidates"), "pos").alias("_first")
    return (
        sized.where(F.col("label") > 0)
        .groupBy(*keys, "article_id")
        .agg(first)
        .select(*keys, "article_id", "_first.*")
        .withColumn("rank_share", F.col("rank") / F.col("n_candidates"))
        .withColumn("hit", (F.col("rank") <= HIT_RANK).cast("int"))
    )


def stack_models(scored: dict[str, DataFrame]) -> DataFrame:
    """Union of separately made score tables, with a `model` column."""
    out = None
    for model, df in scored.items():
        part = df.withColumn("model", F.lit(model))
        out = part if out is None else out.unionByName(part)
    return out


def compare_models(scored: DataFrame, top: int = 3) -> DataFrame:
    """Per model and impression: the top list, best clicked rank and hit count."""
    keys = ["model", "impression_id"]
    ranked = rank_candidates(scored, keys)
    listed = F.when(F.col("rank") <= top, F.struct("rank", "article_id"))
    best = F.array_sort(F.collect_list(listed))
    clicked = F.col("label") > 0
    return ranked.groupBy(*keys).agg(
        F.array_join(F.transform(best, lambda x: x["article_id"].cast("string")), ",").alias("top_articles"),
        F.min(F.when(clicked, F.col("rank"))).alias("best_clicked_rank"),
        F.count_if(clicked & (F.col("rank") <= HIT_RANK)).alias("hits"),
        F.count(F.lit(1)).alias("n_candidates"),
    )
