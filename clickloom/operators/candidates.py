"""Candidate lists of an impression, built inside its row (no exchange)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import arrays

CANDIDATE_FIELDS = ("pos", "article_id", "label", "valid")


def full_candidates(
    behaviors: DataFrame, inview: str = "article_ids_inview", clicked: str = "article_ids_clicked"
) -> DataFrame:
    """All in-view articles with their click label, as a struct list `candidates`."""
    element = behaviors.schema[inview].dataType.elementType.simpleString()
    shown = arrays.or_empty(F.col(inview), element)
    hits = arrays.or_empty(F.col(clicked), element) if clicked in behaviors.columns else arrays.empty_list(element)
    out = behaviors.withColumn("_shown", shown).withColumn("_hits", hits)
    labelled = arrays.map_with(
        F.col("_shown"),
        F.col("_hits"),
        lambda x, h: F.struct(x.alias("id"), F.array_contains(h, x).cast("int").alias("hit")),
    )
    built = F.transform(
        labelled,
        lambda x, i: F.struct(
            i.alias("pos"),
            x["id"].alias("article_id"),
            x["hit"].alias("label"),
            F.lit(True).alias("valid"),
        ),
    )
    return out.withColumn("candidates", built).drop("_shown", "_hits")


def explode_candidates(df: DataFrame, keep: list[str]) -> DataFrame:
    """One row per candidate, with the named columns of its impression.

    The outer form plus a filter: the plain one makes Spark add a size check that would
    build every list a second time.
    """
    return df.select(*keep, F.inline_outer("candidates")).where(F.col("pos").isNotNull())


def negative_pool(
    behaviors: DataFrame, inview: str = "article_ids_inview", clicked: str = "article_ids_clicked"
) -> DataFrame:
    """One row per distinct in-view article that was not clicked, in order of appearance."""
    pool = arrays.not_clicked(F.col(inview), F.col(clicked))
    return behaviors.select("impression_id", F.posexplode(pool).alias("pos", "article_id"))
