"""Sinks: Parquet, build-once tables, id maps, embedding and submission exports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.sources.readers import SCAN_ORDER, path_exists


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def fingerprint(*tables: DataFrame, **parameters) -> str:
    """A text that changes with the rows of the tables or with the parameters."""
    parts = [repr(sorted(parameters.items()))]
    for df in tables:
        row = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in df.columns])
        n, total = df.agg(F.count(F.lit(1)), F.sum(row.cast("decimal(38,0)"))).first()
        parts.append(f"{df.schema.simpleString()} {n} {total}")
    return " | ".join(parts)


def file_fingerprint(*scans: DataFrame, **parameters) -> str:
    """A text that changes with the files of Parquet scans (name, size, time) or with the
    parameters. Only the files' footers are read."""
    parts = [repr(sorted(parameters.items()))]
    for df in scans:
        files = df.select(*[F.col(f"_metadata.file_{c}") for c in ("path", "size", "modification_time")])
        n, total = files.distinct().agg(
            F.count(F.lit(1)), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))
        ).first()
        parts.append(f"{df.schema.simpleString()} {n} files {total}")
    return " | ".join(parts)


def materialize(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], partition_by: Sequence[str] = (),
    stamp: str | None = None,
) -> DataFrame:
    """Build once: read the table when its success marker is there, else write it first.

    With a `stamp` (see `fingerprint`) a table is only read back if it was built under the
    same one.
    """
    fresh = path_exists(spark, f"{path}/_SUCCESS")
    if fresh and stamp is not None:
        fresh = path_exists(spark, f"{path}.stamp/_SUCCESS") and [
            r[0] for r in spark.read.text(f"{path}.stamp", wholetext=True).collect()
        ] == [stamp + "\n"]
    if not fresh:
        write_table(build(), path, partition_by)
        if stamp is not None:
            told = spark.createDataFrame([(stamp,)], "value string").coalesce(1)
            told.write.mode("overwrite").text(f"{path}.stamp")
    return spark.read.parquet(path)


def materialize_bucketed(
    spark: SparkSession, table: str, build: Callable[[], DataFrame], key: str, buckets: int
) -> DataFrame:
    """Build once as a table bucketed and sorted by `key`, so joins on it skip the exchange."""
    if not spark.catalog.tableExists(table):
        build().write.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
    return spark.table(table)


def submission_lines(ranked: DataFrame) -> DataFrame:
    """One line per impression: the id, then its ranks in candidate order."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "rank")))
    ranks = F.array_join(F.transform(ordered, lambda x: x["rank"].cast("string")), ",")
    return ranked.groupBy("impression_id").agg(
        F.concat(F.col("impression_id").cast("string"), F.lit(" ["), ranks, F.lit("]")).alias("line")
    )


def write_submission(
    ranked: DataFrame, path: str, compression: str = "none", order: DataFrame | None = None
) -> None:
    """Text files of submission lines, written by the executors.

    `order` has `impression_id` and the columns of `readers.with_scan_order`: the files, by name
    one after the other, then hold the lines in that order, an impression that occurs
    several times as often as it does there. Without it the order is not defined.
    """
    lines = submission_lines(ranked)
    if order is not None:  # a range sort: file k holds what comes before file k + 1
        placed = lines.join(order.select("impression_id", *SCAN_ORDER), "impression_id")
        lines = placed.orderBy(*SCAN_ORDER)
    value = lines.select(F.col("line").alias("value"))
    value.write.mode("overwrite").option("compression", compression).text(path)


def embedding_table(embedded: DataFrame, index: DataFrame, width: int) -> DataFrame:
    """Vectors keyed by dense index, with a zero row at 0 for padding and unknown ids."""
    vectors = ["title_vector", "body_vector", "category_vector"]
    data = embedded.join(index, "article_id").select(
        F.col("idx").cast("bigint").alias("idx"),
        F.col("article_id").cast("bigint").alias("article_id"),
        *[F.col(v).cast("array<float>").alias(v) for v in vectors],
    )
    zero = F.array_repeat(F.lit(0.0).cast("float"), width)
    pad = embedded.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("idx"),
        F.lit(-1).cast("bigint").alias("article_id"),
        *[zero.alias(v) for v in vectors],
    )
    return pad.unionByName(data)
