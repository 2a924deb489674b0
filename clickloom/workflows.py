"""Whole jobs over a raw data folder: preprocessing, embedding, fitting, ranking, submission.

Layout: `articles.parquet` and `<split>/{history,behaviors}.parquet`. Splits without a
file are skipped; of articles with one id, and histories of one user, the last row in file
order counts. Id maps and embedding tables are read back only if they were built from
the same rows with the same parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators import (
    candidates, encode, features, listwise, profiles, ranking, sampling, scoring, text,
)
from clickloom.operators import history as histories
from clickloom.sources import readers, sinks

SAMPLE_KEYS = ["impression_id", "positive"]
NO_HISTORY = (
    "user_id bigint, hist array<struct<article_id: bigint, scroll: double, read_time: double, "
    "log_time: double, ts: double>>"
)


def article_map(spark: SparkSession, raw: str, out: str) -> DataFrame:
    articles = readers.scan(spark, f"{raw}/articles.parquet", ["article_id"])
    return sinks.materialize(
        spark, f"{out}/article_index", lambda: encode.article_index(articles),
        stamp=sinks.fingerprint(articles),
    )


def user_map(spark: SparkSession, raw: str, out: str) -> DataFrame:
    users = readers.read_splits(spark, raw, "behaviors", ["user_id"])
    if users is None:
        raise ValueError(f"no behaviors below {raw}")
    return sinks.materialize(
        spark, f"{out}/user_index", lambda: encode.user_index(users),
        stamp=sinks.fingerprint(users),
    )


def category_codes(spark: SparkSession, raw: str, out: str, category: str) -> DataFrame:
    named = readers.scan(spark, f"{raw}/articles.parquet", [category])
    return sinks.materialize(
        spark, f"{out}/category_codes", lambda: encode.category_codes(named, category),
        stamp=sinks.fingerprint(named),
    )


def preprocess(spark: SparkSession, raw: str, out: str, category: str = "category") -> None:
    """Write the id maps and the processed article, history and behavior tables."""
    articles = readers.scan_last(spark, f"{raw}/articles.parquet", ["article_id"])
    ids, users = article_map(spark, raw, out), user_map(spark, raw, out)
    codes = category_codes(spark, raw, out, category)
    processed = features.article_features(articles, codes, ids)
    sinks.write_table(processed, f"{out}/articles_processed.parquet")
    for split in readers.SPLIT_FOLDERS:
        history = readers.read_split(spark, raw, split, "history", last_of=["user_id"])
        if history is not None:
            table = features.history_features(history, ids, users)
            sinks.write_table(table, f"{out}/{split}/history_processed.parquet")
        behaviors = readers.read_split(spark, raw, split, "behaviors")
        if behaviors is not None:
            table = features.behavior_features(behaviors, ids, users)
            sinks.write_table(table, f"{out}/{split}/behaviors_processed.parquet")


def embed(
    spark: SparkSession,
    raw: str,
    out: str,
    dim: int = 256,
    max_body_chars: int | None = None,
    descriptions: DataFrame | None = None,
    make_encoder: Callable[[], Callable] | None = None,
) -> DataFrame:
    """Write category vectors, article embeddings, and the index-keyed embedding table."""
    articles = readers.scan_last(spark, f"{raw}/articles.parquet", ["article_id"])
    encoder = getattr(make_encoder, "__qualname__", None)
    told = [] if descriptions is None else [descriptions]
    stamp = sinks.fingerprint(articles, *told, dim=dim, chars=max_body_chars, encoder=encoder)
    categories = sinks.materialize(
        spark,
        f"{out}/category_vectors",
        lambda: text.category_vectors(
            encode.category_dictionary(articles), dim, descriptions, make_encoder
        ),
        stamp=stamp,
    )
    embedded = sinks.materialize(
        spark,
        f"{out}/articles_embedded",
        lambda: text.embed_articles(
            features.article_text(articles, max_body_chars), categories, dim, make_encoder
        ),
        stamp=stamp,
    )
    width = readers.check_vector_width(embedded, "title_vector")
    ids = article_map(spark, raw, out)
    return sinks.materialize(
        spark, f"{out}/embedding_table", lambda: sinks.embedding_table(embedded, ids, width),
        stamp=stamp,
    )


def history_cut(spark: SparkSession, raw: str, out: str, split: str, n: int = 30) -> DataFrame:
    """Each user's last `n` reads of a split, cleaned, built once per state of its files.

    Of several rows of one user the last in file order counts. A split without histories
    has none.
    """
    history = readers.read_split(spark, raw, split, "history")
    if history is None:
        return spark.createDataFrame([], NO_HISTORY)

    def build() -> DataFrame:
        last = readers.read_split(spark, raw, split, "history", last_of=["user_id"])
        return histories.history_lists(histories.explode_history(last), "tail", n, ["pos"])

    return sinks.materialize(
        spark, f"{out}/{split}/history_cut", build, stamp=sinks.file_fingerprint(history, n=n)
    )


def candidate_table(
    spark: SparkSession, raw: str, out: str, split: str, sampled: bool,
    category: str = "category", n: int = 30, dim: int = 256,
) -> DataFrame:
    """Feature rows of a split's candidates: samples of every click, or the full lists."""
    behaviors = readers.read_split(spark, raw, split, "behaviors")
    if behaviors is None:
        raise ValueError(f"no behaviors of {split} below {raw}")
    behaviors = readers.with_clicks(behaviors)
    articles = readers.scan_last(spark, f"{raw}/articles.parquet", ["article_id"])
    codes = category_codes(spark, raw, out, category)
    vectors = profiles.article_vectors(
        embed(spark, raw, out, dim).where("idx > 0"), "article_id", "title_vector", eps=1e-4, normalize=True
    )
    lists = history_cut(spark, raw, out, split, n)
    if sampled:
        rows, keep = sampling.sample_candidates(behaviors, "per_click", clicked="clk_ids"), SAMPLE_KEYS
    else:
        rows, keep = candidates.full_candidates(behaviors, clicked="clk_ids"), SAMPLE_KEYS[:1]
    mean = profiles.mean_profiles(histories.list_items(lists), vectors)
    return scoring.candidate_features(
        rows, lists, mean, features.article_features(articles, codes), vectors, keep
    )


def fit(
    spark: SparkSession, raw: str, out: str, split: str = "train", category: str = "category",
    n: int = 30, dim: int = 256, **options,
) -> listwise.ListwiseModel:
    """Fit the list-wise ranker on samples of a split and save it; an unchanged folder and
    unchanged parameters give the saved model."""
    scans = [readers.scan(spark, f"{raw}/articles.parquet")]
    scans += [t for t in (readers.read_split(spark, raw, split, x) for x in ("history", "behaviors")) if t is not None]
    stamp = sinks.file_fingerprint(*scans, split=split, category=category, n=n, dim=dim, **options)
    return listwise.fit_once(
        spark, f"{out}/ranker", lambda: candidate_table(spark, raw, out, split, True, category, n, dim),
        stamp, keys=SAMPLE_KEYS, **options,
    )


def rank(
    spark: SparkSession, raw: str, out: str, split: str = "test", category: str = "category",
    n: int = 30, dim: int = 256,
) -> DataFrame:
    """Score a split's full lists with the saved ranker; the submission has its impressions in
    the order of the behaviors file."""
    model, _ = listwise.load_model(spark, f"{out}/ranker")
    scored = listwise.score_listwise(model, candidate_table(spark, raw, out, split, False, category, n, dim))
    order = readers.with_scan_order(readers.read_split(spark, raw, split, "behaviors"))
    submit(scored, f"{out}/{split}/submission", order)
    return scored


def submit(scored: DataFrame, out: str, order: DataFrame | None = None) -> None:
    """Rank scored candidates and write one submission line per impression, in the order of
    `order` where it is given (see `sinks.write_submission`)."""
    sinks.write_submission(ranking.rank_candidates(scored), out, order=order)
