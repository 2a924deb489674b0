"""Readers: split folders, optional columns, column aliases, click sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import arrays
from clickloom.operators.joins import lookup

SPLIT_FOLDERS = {
    "train": ("train",),
    "validation": ("validation", "val"),
    "test": ("test",),
}
INVIEW_NAMES = ("article_ids_inview", "inv_ids")
CLICK_NAMES = ("clk_ids", "article_ids_clicked")
IMPRESSION_NAMES = ("impression_id",)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the file system the path belongs to, local or not."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(hadoop_path)


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Lazy Parquet scan; the projection reaches the file reader."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


SCAN_ORDER = ("_file", "_index")  # a row's file, by name, and its number in there


def with_scan_order(df: DataFrame) -> DataFrame:
    """Add the place of every row in the files of a Parquet scan, as two columns that sort.

    `df` is the scan itself. The place is the file's own: no partitioning changes it.
    """
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index"))


def last_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of rows with equal keys, the last in scan order; rows with a null key all stay.

    `df` has the columns of `with_scan_order`, which are dropped. Keys are counted over narrow
    rows first, and only those that repeat are looked up, so wide rows are never aggregated.
    """
    place, on = F.struct(*SCAN_ORDER), F.struct(*keys).alias("_on")
    told = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.max(place).alias("_last"), F.count(F.lit(1)).alias("_n"))
    joined = lookup(df.withColumn("_on", on), told.where("_n > 1").select(on, "_last"), "_on")
    latest = F.col("_last").isNull() | (place == F.col("_last"))
    return joined.where(latest).drop("_on", "_last", *SCAN_ORDER)


def scan_last(
    spark: SparkSession, path: str, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Scan where a later row replaces an earlier one of the same keys."""
    rows = with_scan_order(scan(spark, path))
    return last_rows(rows.select(*columns, *SCAN_ORDER) if columns else rows, keys)


def read_split(
    spark: SparkSession, root: str, split: str, name: str, columns: Sequence[str] | None = None,
    last_of: Sequence[str] = (),
) -> DataFrame | None:
    """`<root>/<split folder>/<name>.parquet`, or None when the split has no such file.

    With `last_of`, a later row replaces an earlier one of the same values there.
    """
    for folder in SPLIT_FOLDERS.get(split, (split,)):
        path = f"{root}/{folder}/{name}.parquet"
        if path_exists(spark, path):
            return scan_last(spark, path, last_of, columns) if last_of else scan(spark, path, columns)
    return None


def read_splits(
    spark: SparkSession, root: str, name: str, columns: Sequence[str]
) -> DataFrame | None:
    """Union of the splits that exist, one pass over the named columns only."""
    parts = [read_split(spark, root, s, name, columns) for s in SPLIT_FOLDERS]
    found = [p for p in parts if p is not None]
    if not found:
        return None
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def find_column(df: DataFrame, names: Sequence[str]) -> str | None:
    return next((n for n in names if n in df.columns), None)


def resolve_column(df: DataFrame, names: Sequence[str], to: str) -> DataFrame:
    """Rename the first of `names` that is present to `to`."""
    found = find_column(df, names)
    if found is None:
        raise ValueError(f"none of {list(names)} in {df.columns}")
    return df if found == to else df.withColumnRenamed(found, to)


def optional_column(df: DataFrame, name: str, dtype: str, default=None):
    """The column when the table has it, else a typed literal."""
    return F.col(name).cast(dtype) if name in df.columns else F.lit(default).cast(dtype)


def with_impression_key(
    df: DataFrame, key_column: str | None = None, compat: bool = False
) -> DataFrame:
    """Make sure `impression_id` exists.

    A constant 0 (compat) merges all impressions in everything that follows, so by
    default a table without the column must name another key.
    """
    if find_column(df, IMPRESSION_NAMES):
        return df
    if key_column is not None:
        return df.withColumn("impression_id", F.col(key_column))
    if compat:
        return df.withColumn("impression_id", F.lit(0).cast("bigint"))
    raise ValueError("no impression_id column: name a key_column")


def with_clicks(df: DataFrame, inview: str = "article_ids_inview", to: str = "clk_ids") -> DataFrame:
    """Clicked ids from the first source present: click column, labels, or none."""
    element = df.schema[inview].dataType.elementType.simpleString()
    found = find_column(df, CLICK_NAMES)
    if found is not None:
        clicks = arrays.or_empty(F.col(found), element)
    elif "labels" in df.columns:
        clicks = arrays.or_empty(arrays.flagged(F.col(inview), F.col("labels")), element)
    else:
        clicks = arrays.empty_list(element)
    return df.withColumn(to, clicks)


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to another table's schema, ready for a union."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def check_vector_width(df: DataFrame, vector: str) -> int:
    """The one width all vectors share; raises when there are several or none."""
    widths = [r[0] for r in df.select(F.size(vector)).distinct().limit(2).collect()]
    if len(widths) != 1:
        raise ValueError(f"expected one width in {vector}, found {widths or 'no rows'}")
    return widths[0]


def read_vectors(spark: SparkSession, path: str, key: str, vector: str) -> DataFrame:
    """(article_id, vector) from a Parquet table whose vectors all have one width.

    A missing file or mixed widths raise: scores on stand-in vectors would look real.
    """
    table = scan(spark, path, [key, vector])
    check_vector_width(table, vector)
    return table.select(F.col(key).alias("article_id"), F.col(vector).alias("vector"))


def vector_widths(df: DataFrame, vector: str) -> DataFrame:
    """Rows per vector width."""
    return df.groupBy(F.size(vector).cast("bigint").alias("width")).agg(
        F.count(F.lit(1)).alias("n_vectors")
    )
