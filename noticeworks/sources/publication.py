"""Datasets that are published together: a folder for each build, and a pointer put in place last.

A build writes into a numbered folder of its own. Readers take the pointer document with the
greatest number, so they see all datasets of one build or all of another, and a build that fails
half-way leaves what was published before. Pointers aren't overwritten: one more is put in place
by a rename, which no file system does by halves. Older folders and pointers are removed, but
for those of the build before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from noticeworks.sources import files

#: Folders that stay: the current one, and that of readers who began before it was.
KEPT = 2


def _numbers(spark: SparkSession, out: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in files.names(spark, f"{out}/published") if n.endswith(".json"))


def _pointer(out: str, number: int) -> str:
    return f"{out}/published/{number:06}.json"


def current(spark: SparkSession, out: str) -> dict | None:
    """number and folder (below ``out``) of what is published; None for nothing."""
    found = _numbers(spark, out)
    return files.read_document(spark, _pointer(out, found[-1])) if found else None


def published(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A published dataset."""
    found = current(spark, out)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {out}")
    return spark.read.parquet(f"{out}/{found['folder']}/{name}")


@contextmanager
def publishing(spark: SparkSession, out: str) -> Iterator[str]:
    """A new folder to write to, published when the block ends; removed if it fails."""
    before = current(spark, out)
    number = (before["number"] if before else 0) + 1
    name = f"builds/{number:06}-{uuid.uuid4().hex[:8]}"
    try:
        yield f"{out}/{name}"
    except BaseException:
        files.remove(spark, f"{out}/{name}")
        raise
    files.write_document(spark, _pointer(out, number), {"number": number, "folder": name})
    for old in _numbers(spark, out)[:-KEPT]:
        files.remove(spark, _pointer(out, old))
    for old in files.names(spark, f"{out}/builds"):
        if int(old.split("-")[0]) <= number - KEPT:
            files.remove(spark, f"{out}/builds/{old}")
