"""Session factory and table reading."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def create_session(app: str = "noticeworks", master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """A session in UTC with adaptive execution and zstd Parquet output.

    ``shuffle_partitions`` is the initial number; adaptive execution coalesces it. On a
    cluster give a number that keeps a partition near 128 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, where it comes from fewer files: a small table of one row group would be
    one task's work. Tables of many files aren't shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def in_parts(df: DataFrame, key: str, rows: int = 1_000_000) -> DataFrame:
    """df by a key in as many parts as it has so many rows, and one a core at least: what a task
    holds doesn't grow with df. The count is read from the files' footers."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(parts, key)


@cache
def _folder_of_tests() -> str:
    return tempfile.mkdtemp(prefix="noticeworks-")


def scratch_path(spark: SparkSession) -> str:
    """A new folder's path in the folder of spark.checkpoint.dir.

    Only in local mode may a session have none (then a folder for tests is made).
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{(folder or _folder_of_tests()).rstrip('/')}/noticeworks-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df as a table in the folder of spark.checkpoint.dir.

    Its lineage ends there, lost executors take nothing away, and unlike a checkpoint it has
    the sizes of its files: estimates of a loop's joins would multiply from round to round.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
