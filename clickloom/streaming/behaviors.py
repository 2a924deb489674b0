"""Preprocess behavior files as they arrive (Structured Streaming)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import arrays
from clickloom.operators.encode import encode_column
from clickloom.operators.features import behavior_attributes


def read_behavior_stream(
    spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 16
) -> DataFrame:
    """Stream of impressions from a folder of Parquet files."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def encode_behaviors_long(behaviors: DataFrame, articles: DataFrame, users: DataFrame) -> DataFrame:
    """One row per in-view position with encoded ids; works on a batch and on a stream.

    Only projections, an explode and joins with static id maps: no state, so no
    watermark is needed and any file can arrive at any time.
    """
    has_clicks = "article_ids_clicked" in behaviors.columns
    element = behaviors.schema["article_ids_inview"].dataType.elementType.simpleString()
    clicked = F.col("article_ids_clicked") if has_clicks else arrays.empty_list(element)
    rows = behaviors.select(
        *behavior_attributes(behaviors),
        "user_id",
        arrays.or_empty(clicked, element).alias("_clicked"),
        F.posexplode("article_ids_inview").alias("pos", "article_id"),
    ).withColumn("label", F.array_contains("_clicked", F.col("article_id")).cast("int"))
    encoded = encode_column(rows.drop("_clicked"), "article_id", articles, "id_encoded")
    return encode_column(encoded, "user_id", users, "user_idx")


def run_to_completion(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Process all files present, then stop; a restart with the same checkpoint resumes."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
