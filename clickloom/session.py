"""Session helpers: the shared working folder and reliable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    A folder of our own is made only for a local master that names none (tests);
    on a cluster a machine-local folder would not survive the loss of its host.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="clickloom-"))
    return context.getCheckpointDir()


def working_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_dir(spark)}/clickloom-{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint `df` reliably: a lost executor re-reads files, it does not recompute."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = shared_dir(df.sparkSession)
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back.

    The lineage ends at files that every executor can read, later readers take only the
    columns they need, and the files go when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = working_path(spark, label)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_row_id(df: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows (unique, not dense) by partition and place within it.

    For a table read from files every evaluation gives each row the same number, after a
    lost executor too. Stage anything else first.
    """
    return df.withColumn(name, F.monotonically_increasing_id())
