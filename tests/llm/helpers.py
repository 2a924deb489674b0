"""Small tables with every awkward row, for the operators of clickloom.llm."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TOXIC = ["you are a scumbag fool and nobody likes a scumbag fool", "what a scumbag fool he is today"]


def awkward(spark, path):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing columns;
    written to files, as the operators ask of tables whose rows they number."""
    long_text = " ".join(f"word{k % 977}" for k in range(60_000))
    rows = [
        (1, "The quick brown fox", "en", "a", 19),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, long_text, "en", "b", len(long_text)),
        (5, "The  quick\tbrown fox\n", "en", "b", 21),
        (1, "The quick brown fox", "en", "a", 19),
        (None, "no id here at all", "en", None, 1),
        (6, " \n\t ", "de", "c", 4),
        (7, "é ü 漢字 𝔘 token", "de", "c", 16),
        (8, long_text, "en", "b", len(long_text)),
    ]
    extra = [F.lit(9).alias(c) for c in ("_row", "_key", "keep_id", "score", "size", "p", "ids", "body", "_copies")]
    made = spark.createDataFrame(rows, SCHEMA).coalesce(3).select("*", *extra)
    made.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def prose(k, n):
    """The first n words of the k-th text; different texts are unrelated."""
    rng = random.Random(k)
    return " ".join(f"w{rng.randrange(3571)}" for _ in range(n))


def table(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(4).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
