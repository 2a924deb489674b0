"""Preprocessing projections of the raw article, history and behavior tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import arrays, scalar
from clickloom.operators.encode import UNKNOWN_CATEGORY, encode_column, encode_lists
from clickloom.sources.readers import optional_column


def article_features(
    articles: DataFrame, codes: DataFrame, index: DataFrame | None = None
) -> DataFrame:
    """Encoded id, category code, three log counts, sentiment, publication second.

    Without an `index` the raw id is the only key.
    """
    published = scalar.epoch_seconds(
        F.col("published_time"), articles.schema["published_time"].dataType
    )
    category = codes.columns[0]
    base = articles.select(
        "article_id",
        F.col(category).cast("string").alias(category),
        scalar.log_count(F.col("total_pageviews")).cast("float").alias("norm_views"),
        scalar.log_count(F.col("total_inviews")).cast("float").alias("norm_inviews"),
        F.coalesce("sentiment_score", F.lit(0)).cast("float").alias("sentiment_score"),
        scalar.log_count(F.col("total_read_time")).cast("float").alias("norm_read_time"),
        published.alias("published_time"),
    )
    out = encode_column(base, category, codes, "cat_encoded", idx="code").drop(category)
    out = out.withColumn("cat_encoded", F.col("cat_encoded").cast("int"))
    if index is None:
        return out
    encoded = encode_column(out, "article_id", index, "id_encoded")
    return encoded.withColumn("id_encoded", F.col("id_encoded").cast("int"))


def history_features(history: DataFrame, articles: DataFrame, users: DataFrame) -> DataFrame:
    """One row per history row: encoded ids, scroll in [0, 1], read time and epoch lists.

    Users the map lacks are dropped: index 0 belongs to a real user.
    """
    times = history.schema["impression_time_fixed"].dataType
    encoded = encode_lists(history, {"article_id_fixed": "hist_ids"}, articles)
    known = encoded.join(users.withColumnRenamed("idx", "_user"), "user_id")
    return known.select(
        F.col("_user").cast("int").alias("user_id"),
        "hist_ids",
        arrays.divided(F.col("scroll_percentage_fixed"), 100.0)
        .cast("array<float>")
        .alias("hist_scroll"),
        F.col("read_time_fixed").cast("array<float>").alias("hist_time"),
        arrays.epoch_list(F.col("impression_time_fixed"), times).alias("hist_ts"),
    )


def history_item_features(items: DataFrame, articles: DataFrame, users: DataFrame) -> DataFrame:
    """The same projection on long history (one row per read), which no hot user can
    turn into one oversized row."""
    ts = scalar.epoch_seconds(F.col("impression_time"), items.schema["impression_time"].dataType)
    base = items.select(
        "user_id",
        "pos",
        "article_id",
        (F.col("scroll_percentage") / F.lit(100.0)).cast("float").alias("scroll"),
        F.col("read_time").cast("float").alias("read_time"),
        ts.alias("ts"),
    )
    encoded = encode_column(base, "article_id", articles, "id_encoded")
    return encoded.join(users.withColumnRenamed("idx", "user_idx"), "user_id")


def behavior_attributes(behaviors: DataFrame) -> list:
    """Scalar columns of one impression: second, device, age / 100, gender, flags."""
    imp_ts = scalar.epoch_seconds(
        F.col("impression_time"), behaviors.schema["impression_time"].dataType
    )
    columns = [
        F.col("impression_id").cast("bigint").alias("impression_id"),
        imp_ts.alias("imp_ts"),
        F.coalesce("device_type", F.lit(0)).cast("tinyint").alias("device_type"),
        (F.coalesce("age", F.lit(0)) / F.lit(100.0)).cast("float").alias("norm_age"),
        F.coalesce("gender", F.lit(0)).cast("tinyint").alias("gender"),
        F.coalesce("is_subscriber", F.lit(False)).cast("tinyint").alias("is_subscriber"),
        F.coalesce("is_sso_user", F.lit(False)).cast("tinyint").alias("is_sso_user"),
    ]
    if "session_id" in behaviors.columns:
        columns.append(F.col("session_id").cast("bigint").alias("session_id"))
    return columns


def behavior_features(
    behaviors: DataFrame, articles: DataFrame, users: DataFrame, unknown_user: int | None = 0
) -> DataFrame:
    """One row per impression with encoded in-view and clicked lists.

    A test split without clicks gets an empty list. `unknown_user` is the index of a
    user the map lacks; None keeps it null, as 0 belongs to a real user.
    """
    lists = {"article_ids_inview": "inv_ids", "article_ids_clicked": "clk_ids"}
    element = behaviors.schema["article_ids_inview"].dataType.simpleString()
    clicked = optional_column(behaviors, "article_ids_clicked", element)
    rows = behaviors.select(
        *behavior_attributes(behaviors), "user_id", "article_ids_inview",
        clicked.alias("article_ids_clicked"),
    )
    encoded = encode_lists(rows, lists, articles)
    out = encode_column(encoded, "user_id", users, "_user", unknown_user)
    names = [c for c in encoded.columns if c not in ("impression_id", "user_id")]
    return out.select("impression_id", F.col("_user").cast("int").alias("user_id"), *names)


def article_text(articles: DataFrame, max_body_chars: int | None = 1000) -> DataFrame:
    """Id, publication time, category with 'UNK', full title, body cut to a length."""
    return articles.select(
        "article_id",
        "published_time",
        F.coalesce(F.col("category_str").cast("string"), F.lit(UNKNOWN_CATEGORY)).alias("category_str"),
        scalar.full_title(F.col("title"), F.col("subtitle")).alias("full_title"),
        scalar.text_head(F.col("body").cast("string"), max_body_chars).alias("body"),
    )


def valid_rows(df: DataFrame, inview: str = "article_ids_inview") -> DataFrame:
    """Drop impressions with a non-integer user id or no candidates."""
    user = F.expr("try_cast(user_id as bigint)")
    return (
        df.withColumn("user_id", user)
        .where(F.col("user_id").isNotNull())
        .where(F.coalesce(F.size(inview), F.lit(0)) > 0)
    )


def with_any_item(df: DataFrame, inview: str, clicked: str) -> DataFrame:
    """Drop impressions with neither an in-view nor a clicked article."""
    return df.where(
        (F.coalesce(F.size(inview), F.lit(0)) > 0) | (F.coalesce(F.size(clicked), F.lit(0)) > 0)
    )


def clicked_only(df: DataFrame, clicked: str = "article_ids_clicked") -> DataFrame:
    """Impressions with at least one click."""
    return df.where(F.coalesce(F.size(clicked), F.lit(0)) > 0)
