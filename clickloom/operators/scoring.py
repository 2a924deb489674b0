"""Scorers and candidate feature rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import arrays, scalar
from clickloom.operators.candidates import explode_candidates
from clickloom.operators.history import with_history
from clickloom.operators.joins import lookup
from clickloom.operators.pairs import pair_products

PAD_SCORE = -1e4  # fixed value given to padded candidates before ranking


class Scorer(NamedTuple):
    """A model that scores by the dot product of user profile and candidate vector.

    `profiles` may be shared by several scorers, each with its own `profile` column;
    `divide_by` names a number of the article (its vector's length) to divide by.
    """

    profiles: DataFrame
    vector: str = "vector"
    scale_by_width: bool = False
    profile: str = "profile"
    divide_by: str | None = None


def _by_user(scorers: dict[str, Scorer]) -> DataFrame:
    """One row per user with the profile of scorer i in column _p<i>."""
    models = list(scorers.values())
    if all(s.profiles is models[0].profiles for s in models):
        return models[0].profiles.select("user_id", *[F.col(s.profile).alias(f"_p{i}") for i, s in enumerate(models)])
    stacked = None
    for i, s in enumerate(models):
        part = s.profiles.select("user_id", F.lit(i).alias("_i"), F.col(s.profile).alias("profile"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy("user_id").agg(*[
        F.first(F.when(F.col("_i") == i, F.col("profile")), ignorenulls=True).alias(f"_p{i}")
        for i in range(len(models))
    ])


def score_models(
    impressions: DataFrame,
    scorers: dict[str, Scorer],
    article_vecs: DataFrame,
    keep: Sequence[str] = ("impression_id",),
) -> DataFrame:
    """Score all candidates by all models in one pass: one row per candidate and model.

    Distinct (user, article) pairs are scored by blocks (`pairs`), so neither a profile nor
    a vector is sent with every candidate; the scores, a few numbers per pair, are joined
    back to the candidates. Scores are 0 when a profile or a vector is missing.
    """
    own = [k for k in keep if k != "user_id"]
    flat = explode_candidates(impressions.select("user_id", *own, "candidates"), ["user_id", *own])
    numbers = {s.divide_by for s in scorers.values()} - {None}
    widths = sorted({s.vector for s in scorers.values() if s.scale_by_width})
    uses = [(f"_p{i}", s.vector) for i, s in enumerate(scorers.values())]
    dots = pair_products(flat, _by_user(scorers), article_vecs, uses)
    if numbers or widths:
        sizes = [F.size(v).alias(f"_width_{v}") for v in widths]
        dots = lookup(dots, article_vecs.select("article_id", *sorted(numbers), *sizes), "article_id")

    def score(i: int, scorer: Scorer) -> Column:
        raw = F.col("dots")[i]
        if scorer.divide_by:
            raw = raw / F.col(scorer.divide_by)
        if scorer.scale_by_width:
            raw = raw / F.sqrt(F.coalesce(f"_width_{scorer.vector}", F.lit(1)).cast("double"))
        return raw

    pair = F.struct(F.col("user_id").cast("bigint").alias("user_id"), F.col("article_id").cast("bigint").alias("article_id"))
    scored = dots.select(pair.alias("_pair"), F.array(*[score(i, s) for i, s in enumerate(scorers.values())]).alias("_scores"))
    rows = lookup(flat.withColumn("_pair", pair), scored, "_pair")
    named = F.array(*[
        F.struct(F.lit(name).alias("model"), F.coalesce(F.col("_scores")[i], F.lit(0.0)).alias("score"))
        for i, name in enumerate(scorers)
    ])
    return rows.select(*keep, "pos", "article_id", "label", "valid", F.inline(named))


def score_candidates(
    impressions: DataFrame,
    profiles: DataFrame,
    article_vecs: DataFrame,
    keep: Sequence[str] = ("impression_id",),
    scale_by_width: bool = False,
) -> DataFrame:
    """Score all candidates by one model."""
    scorer = Scorer(profiles, scale_by_width=scale_by_width)
    return score_models(impressions, {"_": scorer}, article_vecs, keep).drop("model")


def mask_padding(scored: DataFrame) -> DataFrame:
    """Give padded candidates a score below any real one."""
    return scored.withColumn("score", F.when(F.col("valid"), F.col("score")).otherwise(F.lit(PAD_SCORE)))


def impression_features(behaviors: DataFrame, lists: DataFrame) -> DataFrame:
    """Log history length, time of day and age share of one impression (0 when missing)."""
    dtype = behaviors.schema["impression_time"].dataType
    imp_ts = F.coalesce(scalar.epoch_seconds(F.col("impression_time"), dtype), F.lit(0.0))
    timed = with_history(behaviors, lists).withColumn("imp_ts", imp_ts)
    return timed.select(
        *[c for c in timed.columns if c not in ("hist", "age")],
        "hist",
        F.log1p(F.size("hist").cast("double")).alias("log_hist_len"),
        scalar.time_of_day(F.col("imp_ts")).alias("day_time"),
        (F.coalesce("age", F.lit(0)) / F.lit(100.0)).alias("norm_age"),
    )


def _pooled(values: Column, name: str) -> list[Column]:
    """Mean and maximum of a list, 0 for an empty one."""
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    mean = F.coalesce(F.try_divide(total, F.size(values)), F.lit(0.0))
    return [mean.alias(f"mean_{name}"), F.coalesce(F.array_max(values), F.lit(0.0)).alias(f"max_{name}")]


NUMERIC_FEATURES = (
    "norm_views", "norm_inviews", "sentiment_score", "norm_read_time", "freshness", "similarity",
    "log_hist_len", "day_time", "norm_age",
    "mean_scroll", "max_scroll", "mean_time", "max_time", "mean_recency", "max_recency",
)


def candidate_features(
    impressions: DataFrame,
    lists: DataFrame,
    profiles: DataFrame,
    features: DataFrame,
    article_vecs: DataFrame,
    keep: Sequence[str] = ("impression_id",),
    unknown_freshness: str = "zero",
) -> DataFrame:
    """One row per candidate: article numbers, freshness, similarity, category code,
    impression numbers, and the user's scroll, time and recency pooled.

    An article without a feature row counts as unknown: zeros and code 0, freshness 0
    (or, under 'epoch', the age of an article published in 1970, for comparison).
    """
    base = impression_features(impressions, lists)
    pooled = base.withColumn("_rec", arrays.recency_list(F.col("hist")["ts"], F.col("imp_ts")))
    pooled = pooled.select(
        *keep,
        *[c for c in ("user_id", "imp_ts", "candidates", "log_hist_len", "day_time", "norm_age") if c not in keep],
        *_pooled(F.col("hist")["scroll"], "scroll"),
        *_pooled(F.col("hist")["read_time"], "time"),
        *_pooled(F.col("_rec"), "recency"),
    )
    carried = [c for c in pooled.columns if c not in keep and c != "candidates"]
    article_side = features.select(
        "article_id", "cat_encoded", "norm_views", "norm_inviews", "sentiment_score",
        "norm_read_time", "published_time",
    )
    flat = explode_candidates(pooled, [*keep, *carried])
    shown = explode_candidates(impressions.select("user_id", "candidates"), ["user_id"])
    pair = F.struct(F.col("user_id").cast("bigint").alias("user_id"), F.col("article_id").cast("bigint").alias("article_id"))
    dots = pair_products(shown, profiles, article_vecs, [("profile", "vector")]).select(
        pair.alias("_pair"), F.col("dots")[0].alias("_similarity")
    )
    rows = lookup(lookup(flat.withColumn("_pair", pair), dots, "_pair"), article_side, "article_id")
    unknown = F.col("published_time").isNull()
    age = scalar.freshness(F.col("imp_ts"), F.coalesce("published_time", F.lit(0.0)))
    fresh = F.when(unknown, F.lit(0.0)).otherwise(age) if unknown_freshness == "zero" else age
    zero = F.lit(0.0)
    return rows.select(
        *keep, "pos", "article_id", "label", "valid",
        unknown.alias("is_unknown"),
        F.coalesce("cat_encoded", F.lit(0)).alias("cat_encoded"),
        *[F.coalesce(F.col(c).cast("double"), zero).alias(c)
          for c in ("norm_views", "norm_inviews", "sentiment_score", "norm_read_time")],
        fresh.alias("freshness"),
        F.coalesce("_similarity", zero).alias("similarity"),
        *NUMERIC_FEATURES[6:],
    )


def score_with(
    features: DataFrame,
    make_predict: Callable[[], Callable],
    inputs: Sequence[str],
    batch_size: int = 4096,
) -> DataFrame:
    """Score rows with an external model in Arrow batches on the executors.

    `make_predict` loads the model and returns a function from a float array of shape
    (batch, len(inputs)) to a score array; Spark calls it once per Python process.
    """
    predict = predict_batch_udf(
        make_predict,
        return_type=T.DoubleType(),
        batch_size=batch_size,
        input_tensor_shapes=[[len(inputs)]],
    )
    packed = F.array(*[F.col(c).cast("double") for c in inputs])
    return features.withColumn("score", predict(packed))
