"""Single files and folders through Spark's own file systems: documents, replacement, manifests."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _system(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names of what a folder holds; none for one that isn't there."""
    system, place = _system(spark, path)
    return sorted(f.getPath().getName() for f in system.listStatus(place)) if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.delete(place, True)


def replace(spark: SparkSession, staged: str, path: str) -> None:
    """Puts a finished file or folder in the place of another, which goes only then."""
    system, place = _system(spark, path)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.replaced")
    system.delete(old, True)
    system.mkdirs(place.getParent())
    if system.exists(place) and not system.rename(place, old):
        raise OSError(f"{path} can't be moved")
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(staged), place):
        system.rename(old, place)
        raise OSError(f"{staged} can't be moved to {path}")
    system.delete(old, True)


def write_document(spark: SparkSession, path: str, value: object) -> None:
    """A JSON document, its keys sorted, indented by two; written beside its place and then moved."""
    text = json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True) + "\n"
    system, place = _system(spark, f"{path}.new")
    out = system.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    replace(spark, f"{path}.new", path)


def read_document(spark: SparkSession, path: str) -> object:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])


def file_manifest(files: DataFrame) -> DataFrame:
    """path, bytes and sha256 of files (path, content, length), in order of path."""
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256")).orderBy("path")
