"""The engine's input tables, derived from the event log and document tables.

`events` plays the click log (props.k is the article, click events are clicks, all
other events exposures), `documents` the articles, `embeddings` their vectors and
`labels` the sentiment. Three-day buckets counted from 2024-01-01 separate the
splits; one impression is one user in one bucket. Everything is a plan over the
whole tables; the long history is never gathered per user before its cut.

Every query sees all documents, users, vectors and texts. Two holdouts can be asked for by
the queries whose feature they are: `unknown_articles` (articles 95-99 stay unknown though
events mention them) and `cold_users` (users with an id divisible by 13 have no history).
Some attributes are null by user or article id.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIRST_DAY = "2024-01-01"
BUCKET_DAYS = 3


@dataclass(frozen=True)
class Split:
    history_before: int
    first: int
    last: int


SPLITS = {"train": Split(5, 5, 7), "validation": Split(8, 8, 8), "test": Split(9, 9, 9)}


def _bucket_start(bucket: int):
    """First moment of a bucket, as a literal: a filter on `ts` that reaches the scan."""
    return F.expr(f"timestamp_ntz'{FIRST_DAY} 00:00:00' + make_dt_interval({BUCKET_DAYS * bucket})")


def in_buckets(events: DataFrame, first: int, last: int) -> DataFrame:
    return events.where((F.col("ts") >= _bucket_start(first)) & (F.col("ts") < _bucket_start(last + 1)))


# Stored order of a history: by time, equal times by event.
STORED = ("impression_time", "event_id")


class ClickLog:
    """The tables below one folder; each file set is listed and opened once."""

    def __init__(
        self, spark: SparkSession, folder: str, unknown_articles: bool = False, cold_users: bool = False
    ):
        self.unknown_articles = unknown_articles
        self.cold_users = cold_users
        self.spark = spark
        self.folder = folder
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    def click_events(self) -> DataFrame:
        return self.table("events").select(
            "event_id",
            "user_id",
            "event_type",
            "value",
            "ts",
            F.get_json_object("props", "$.k").cast("bigint").alias("article_id"),
        )

    def split_users(self) -> DataFrame:
        """User ids of all splits' impressions."""
        last = max(s.last for s in SPLITS.values())
        first = min(s.first for s in SPLITS.values())
        return in_buckets(self.click_events(), first, last).select("user_id")

    @cached_property
    def article_documents(self) -> DataFrame:
        """Ids, category, texts and publication time: the document table alone."""
        doc_id = F.col("doc_id")
        day = F.expr(f"timestamp_ntz'{FIRST_DAY} 00:00:00' - make_dt_interval(cast(doc_id % 20 as int))")
        return self._known(self.table("documents")).select(
            doc_id.alias("article_id"),
            F.when(F.col("lang") != "es", F.col("lang")).alias("category_str"),
            F.substring_index("text", "\n", 1).alias("title"),
            F.when(doc_id % 7 != 0, F.col("source")).alias("subtitle"),
            F.col("text").alias("body"),
            day.alias("published_time"),
        )

    @cached_property
    def raw_articles(self) -> DataFrame:
        """Article documents with their exposure totals and sentiment."""
        shown = self.click_events().groupBy("article_id").agg(
            F.nullif(F.count_if(F.col("event_type") == "view"), F.lit(0)).alias("total_pageviews"),
            F.count(F.lit(1)).alias("total_inviews"),
            F.sum("value").alias("total_read_time"),
        )
        labels = self.table("labels").select(
            F.col("doc_id").alias("article_id"),
            F.col("quality").cast("double").alias("sentiment_score"),
        )
        return self.article_documents.join(shown, "article_id", "left").join(labels, "article_id", "left")

    def article_ids(self) -> DataFrame:
        """Known article ids only: reads one column."""
        return self._known(self.table("documents")).select(F.col("doc_id").alias("article_id"))

    def _known(self, documents: DataFrame) -> DataFrame:
        if not self.unknown_articles:
            return documents
        return documents.where((F.col("doc_id") < 95) | (F.col("doc_id") >= 100))

    def history_items(self, split: str) -> DataFrame:
        """Long raw history: one row per read."""
        value = F.col("value")
        read = self.click_events().where(F.col("ts") < _bucket_start(SPLITS[split].history_before))
        if self.cold_users:
            read = read.where(F.col("user_id") % 13 != 0)
        return read.select(
            "user_id",
            "event_id",
            "article_id",
            F.least(value, F.lit(100.0)).alias("scroll_percentage"),
            F.when(F.col("event_type") != "error", value * 4.0 - 10.0).alias("read_time"),
            F.col("ts").alias("impression_time"),
        )

    def behaviors(self, split: str, clicks: bool = True) -> DataFrame:
        """Raw behaviors: one row per impression.

        The first aggregate folds repeated exposures before the impression is gathered, so
        an impression's list holds each shown article once, however many events it had.
        """
        cut = SPLITS[split]
        day = F.datediff(F.col("ts").cast("date"), F.lit(FIRST_DAY).cast("date"))
        shown = (
            in_buckets(self.click_events(), cut.first, cut.last)
            .withColumn("bucket", F.floor(day / F.lit(BUCKET_DAYS)).cast("int"))
            .groupBy("user_id", "bucket", "article_id")
            .agg(
                F.min("event_id").alias("first_event"),
                F.min("ts").alias("first_ts"),
                F.max((F.col("event_type") == "click").cast("int")).alias("clicked"),
            )
        )
        lists = shown.groupBy("user_id", "bucket").agg(
            F.min("first_event").alias("impression_id"),
            F.min("first_ts").alias("impression_time"),
            F.array_sort(F.collect_list(F.struct("first_event", "article_id", "clicked"))).alias("_s"),
        )
        user = F.col("user_id")
        columns = [
            "impression_id",
            "user_id",
            "impression_time",
            F.col("_s")["article_id"].alias("article_ids_inview"),
        ]
        if clicks:
            hits = F.filter("_s", lambda x: x["clicked"] == 1)
            columns.append(F.transform(hits, lambda x: x["article_id"]).alias("article_ids_clicked"))
        return lists.select(
            *columns,
            F.when(user % 11 != 0, user % 3).cast("int").alias("device_type"),
            F.when(user % 5 == 0, F.lit(20) + user % 60).cast("int").alias("age"),
            F.when(user % 7 == 0, user % 2).cast("int").alias("gender"),
            (user % 10 == 0).alias("is_subscriber"),
            F.when(user % 9 != 0, user % 4 == 0).alias("is_sso_user"),
            F.col("impression_id").alias("session_id"),
        )

    def embeddings(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("article_id"), F.col("embedding").alias("vector")
        )
