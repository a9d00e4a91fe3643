"""What the operators share: tables, scratch tables in the shared folder, text expressions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.sources import files

#: ASCII white space, as a character class of regular expressions.
SPACE = r"[\x20\x09-\x0D]"
#: Keys up to this number are broadcast to fetch texts; more are joined by a shuffle.
MAX_BROADCAST_KEYS = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _folder_of_tests() -> str:
    return tempfile.mkdtemp(prefix="noticeworks-")


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only in local mode, where all tasks share a machine,
    a session may have none: then one for tests is made. On a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder or _folder_of_tests()


#: Lists of the folders of tables written since each scope began, the innermost last. Threads
#: have scopes of their own.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("noticeworks_scopes", default=())


@contextmanager
def noting() -> Iterator[list[str]]:
    """A scope: the folders of the tables written in it that no scope inside removes."""
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield paths
    finally:
        _SCOPES.reset(token)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A scope whose tables are removed in the end, but for those written as ``kept``: an operator
    writes its small result so and leaves no table that it needed on the way."""
    with noting() as paths:
        try:
            yield
        finally:
            remove_tables(spark, paths)


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    """Removes tables that nothing reads any more."""
    for path in paths:
        files.remove(spark, path)


def written(df: DataFrame, name: str, kept: bool = False, **options: str) -> DataFrame:
    """df, written to the shared folder and read again: the lineage ends there. A ``kept`` one
    belongs to the scope around the innermost."""
    folder = f"{shared_folder(df.sparkSession).rstrip('/')}/noticeworks-{uuid.uuid4().hex}"
    scopes = _SCOPES.get()[: -1 if kept else None]
    if scopes:
        scopes[-1].append(folder)
    path = f"{folder}/{name}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of steps whose results are written: it does so when the
    driver collects garbage, which else may be long after."""
    spark.sparkContext._jvm.System.gc()


def expanded(df: DataFrame, count: str, nth: str, step: int = 1024) -> DataFrame:
    """Each row as often as its ``count``, with its number there, from 0, in ``nth``.

    Rows are dealt out by ``step`` copies, so that no task makes all copies of one row and no
    array holds more than a ``step``-th of their numbers.
    """
    (block,) = unused(df, "_block")
    last = F.floor((F.col(count) - 1) / step).cast("long")
    parts = df.withColumn(block, F.explode(F.sequence(F.lit(0).cast("long"), last))).repartition(partitions(df.sparkSession))
    end = F.least(F.col(count), (F.col(block) + 1) * step) - 1
    return parts.withColumn(nth, F.explode(F.sequence(F.col(block) * step, end))).drop(block)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of df has it: columns may have any name."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        found.append(name)
    return found


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    return F.translate(column, UPPER, LOWER)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A key by document and content: rows equal in both share it, others don't."""
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(text), F.lit("\0"))))


def fresh(column: Column) -> Column:
    """The same string as a new expression. An aggregate joined on it is shuffled once more
    by the join itself, so that adaptive execution can split a key with very many rows."""
    return F.concat(column, F.lit(""))


def empty_if_null(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))
