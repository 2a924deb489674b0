"""Exact deduplication by a tree merge of sorted digest runs, in DataFrame functions only.

Every row becomes a digest of its normalised text. Rows are dealt to lanes by the
partition they come from, and each lane first holds its own run: one entry per digest
with the best row and a count. In every round the runs of `fan_in` neighbouring lanes
are merged, digest by digest, until one run covers all lanes. A digest held by a third of
all rows enters each round as at most one entry per task (map-side aggregation) and at
most `fan_in` entries per merged lane.

A digest is verified at every level: entries merge only where SHA-256, byte length and a
second hash of another family agree, so texts that met in one digest alone stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.names import fresh
from clickloom.operators.joins import lookup
from clickloom.session import stage, with_row_id

WHITE = r"[\x20\x09-\x0D]+"
LANES = 64
FAN_IN = 8


def normalised(text: Column) -> Column:
    """The text without blanks and ASCII control white space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, "")


def digests(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", lanes: int = LANES
) -> DataFrame:
    """One narrow row per document: `_row`, `_id`, digest key, length and lane."""
    rows = with_row_id(
        docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))
    ).select(
        "_row",
        "_id",
        F.length(F.coalesce("_text", F.lit(""))).alias("_points"),
        normalised(F.col("_text")).alias("_norm"),
        F.pmod(F.spark_partition_id(), F.lit(lanes)).alias("_lane"),
    )
    key = F.struct(
        F.unhex(F.sha2(F.col("_norm").cast("binary"), 256)).alias("sha"),
        F.octet_length("_norm").alias("bytes"),
        F.xxhash64("_norm").alias("check"),
    )
    return rows.select("_row", "_id", "_points", "_lane", key.alias("_digest"))


def merge_runs(rows: DataFrame, lanes: int = LANES, fan_in: int = FAN_IN) -> DataFrame:
    """Merge the lanes' runs round by round: `_digest`, `_best`, `_size` for all rows.

    The best row has the most code points, then the smallest id (null last), then the
    smallest row number, which tells repeated rows apart.
    """
    best = F.struct(
        (-F.col("_points")).alias("shorter"), F.col("_id").isNull().alias("no_id"), "_id", "_row"
    )
    runs = rows.groupBy("_lane", "_digest").agg(
        F.min(best).alias("_best"), F.count(F.lit(1)).alias("_size")
    )
    while lanes > 1:
        lanes = -(-lanes // fan_in)
        lane = F.floor(F.col("_lane") / fan_in).cast("int").alias("_lane")
        runs = runs.groupBy(lane, "_digest").agg(
            F.min("_best").alias("_best"), F.sum("_size").alias("_size")
        )
    return runs.drop("_lane")


def exact_groups(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id",
    lanes: int = LANES, fan_in: int = FAN_IN,
) -> DataFrame:
    """The group of every row: `_row`, id, `keep_id`, `group_size`, `kept`, `text_sha256`.

    Texts are equal when they agree without white space (`WHITE`); null and empty texts
    are one group. In each group one row is kept, also among rows that repeat each other
    entirely. Null ids are allowed and are kept only where no row of the length has an
    id. An empty table gives an empty result; other columns are not read.
    """
    rows = stage(digests(docs, text, id_col, lanes), "digests")
    merged = merge_runs(rows, lanes, fan_in)
    return lookup(rows, merged, "_digest").select(
        "_row",
        F.col("_id").alias(id_col),
        F.col("_best._id").alias("keep_id"),
        F.col("_size").alias("group_size"),
        (F.col("_best._row") == F.col("_row")).alias("kept"),
        F.lower(F.hex("_digest.sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The kept rows of `exact_groups` with all columns of `docs`.

    `docs` must be a table read from files (`with_row_id`).
    """
    row = fresh(docs, "_row")
    kept = exact_groups(docs, text, id_col).where("kept").select(F.col("_row").alias(row))
    return with_row_id(docs, row).join(kept.hint("shuffle_hash"), row, "left_semi").drop(row)
