"""Folds of events kept by a stream of batches: the latest event of a key, or its first observation.

The state is a log of folded batches. A batch folds its own rows, deals them out to buckets by a
hash of the key and adds a folder to each bucket it has rows for; it reads no state. A version
document names the folders of every bucket, and a batch is committed by the rename that puts the
next version in place: before it, readers see the version before. A bucket with more than
``RUNS`` folders is folded into one, so that what a batch costs follows its own rows and the
buckets that are due, not the number of batches before; folders and versions that the last
``VERSIONS`` versions don't need are removed.

Folds don't mind order or repetition: batches may come late, twice or in any order, and the
result is that of one batch over all. One stream writes a state at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from noticeworks.sources import files

BUCKETS = 64
#: Folders of a bucket before they are folded into one.
RUNS = 8
#: Versions that stay, for readers that began before the newest.
VERSIONS = 3

#: Rows of any number of batches, folded by key; also of rows that are folded already.
Fold = Callable[[DataFrame], DataFrame]


def latest(key: str, time: str, event_id: str) -> Fold:
    """Keeps the greatest (time, event id) of each key; replays change nothing."""
    return lambda rows: rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), F.struct(F.col(time), F.col(event_id))).alias("_r")).select("_r.*")


def first_observation(key: str, provenance: Column) -> Fold:
    """Keeps the observation of each key with the least provenance, whenever it comes."""
    return lambda rows: rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), provenance).alias("_r")).select("_r.*")


def _version_path(path: str, number: int) -> str:
    return f"{path}/versions/{number:012}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions that are there, ascending; a few, whatever the batches."""
    names = files.names(spark, f"{path}/versions")
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def current(spark: SparkSession, path: str) -> dict:
    """The newest version: its number, the last batch, and the folders of each bucket."""
    found = versions(spark, path)
    return files.read_document(spark, _version_path(path, found[-1])) if found else {"version": 0, "batch": None, "buckets": {}}


def _folders(spark: SparkSession, schema: StructType, folders: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read_state(spark: SparkSession, path: str, schema: StructType, fold: Fold) -> DataFrame:
    """The state as of the newest version."""
    held = current(spark, path)["buckets"]
    return fold(_folders(spark, schema, [f"{path}/{f}" for run in held.values() for f in run]))


def _written(rows: DataFrame, path: str, key: str, buckets: int) -> dict[str, str]:
    """Rows written by bucket to a folder of their own: each bucket's place below ``path``."""
    folder = f"data/{uuid.uuid4().hex}"
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    dealt.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{path}/{folder}")
    names = [n for n in files.names(rows.sparkSession, f"{path}/{folder}") if n.startswith("_bucket=")]
    return {n.removeprefix("_bucket="): f"{folder}/{n}" for n in names}


def add_batch(batch: DataFrame, number: int, path: str, key: str, fold: Fold, buckets: int = BUCKETS, runs: int = RUNS) -> dict:
    """Adds a batch to the state at ``path`` and returns the new version."""
    spark, schema = batch.sparkSession, batch.schema
    before = current(spark, path)
    held = {bucket: list(run) for bucket, run in before["buckets"].items()}
    for bucket, folder in _written(fold(batch), path, key, buckets).items():
        held.setdefault(bucket, []).append(folder)
    due = sorted(bucket for bucket, run in held.items() if len(run) > runs)
    if due:
        old = _folders(spark, schema, [f"{path}/{f}" for bucket in due for f in held[bucket]])
        held |= {bucket: [folder] for bucket, folder in _written(fold(old), path, key, buckets).items()}
    after = {"version": before["version"] + 1, "batch": number, "buckets": held}
    files.write_document(spark, _version_path(path, after["version"]), after)
    _clear(spark, path)
    return after


def _clear(spark: SparkSession, path: str) -> None:
    """Removes old versions, and the data folders that none of the others names."""
    numbers = versions(spark, path)
    for number in numbers[:-VERSIONS]:
        files.remove(spark, _version_path(path, number))
    used = set()
    for number in numbers[-VERSIONS:]:
        used |= {f for run in files.read_document(spark, _version_path(path, number))["buckets"].values() for f in run}
    for folder in files.names(spark, f"{path}/data"):
        mine = {f"data/{folder}/{n}" for n in files.names(spark, f"{path}/data/{folder}") if n.startswith("_bucket=")}
        if not mine & used:
            files.remove(spark, f"{path}/data/{folder}")
        else:
            for gone in mine - used:
                files.remove(spark, f"{path}/{gone}")


def run_fold(events: DataFrame, path: str, checkpoint: str, key: str, fold: Fold, buckets: int = BUCKETS) -> StreamingQuery:
    """Keeps ``fold`` of all events below ``path``; ``read_state`` reads it."""

    def step(batch: DataFrame, number: int) -> None:
        add_batch(batch, number, path, key, fold, buckets)

    return events.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_latest(events: DataFrame, path: str, checkpoint: str, key: str, time: str, event_id: str) -> StreamingQuery:
    """Keeps the latest event of each key."""
    return run_fold(events, path, checkpoint, key, latest(key, time, event_id))


def run_first(events: DataFrame, path: str, checkpoint: str, key: str, provenance: Column) -> StreamingQuery:
    """Keeps the first observation of each key by provenance."""
    return run_fold(events, path, checkpoint, key, first_observation(key, provenance))
