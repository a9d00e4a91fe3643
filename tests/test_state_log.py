"""The streamed state's log, and digests of datasets."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from noticeworks.operators import state
from noticeworks.streaming import latest

SCHEMA = "k string, at long, id string"


def batches(spark, n, keys=6):
    rows = [[(f"k{(i * 5 + j) % keys}", (i * 7 + j * 3) % 23 if j else None, f"e{i}-{j}") for j in range(4)] for i in range(n)]
    return [spark.createDataFrame(x, SCHEMA).coalesce(1) for x in rows]


def folders(path):
    return sorted(os.path.relpath(p, path) for p in glob.glob(f"{path}/data/*/_bucket=*"))


def test_cost_of_a_batch_does_not_grow_with_the_batches(spark, tmp_path, monkeypatch):
    """Data folders and versions stay few, and a batch reads none but those that are due."""
    path, fold, parts, read = str(tmp_path / "s"), latest.latest("k", "at", "id"), batches(spark, 14), []
    real = latest._folders
    monkeypatch.setattr(latest, "_folders", lambda s, schema, of: read.append(len(of)) or real(s, schema, of))
    for n, part in enumerate(parts):
        before = len(read)
        version = latest.add_batch(part, n, path, "k", fold, buckets=2, runs=3)
        assert sum(read[before:]) <= 2 * 4 and all(len(run) <= 3 for run in version["buckets"].values())
        assert len(latest.versions(spark, path)) <= latest.VERSIONS and len(folders(path)) <= latest.VERSIONS * 2 * 4
    assert sum(1 for n in read if n == 0) == 0 and len(read) < len(parts)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    got = latest.read_state(spark, path, whole.schema, fold)
    assert sorted(map(str, got.collect())) == sorted(map(str, fold(whole).collect()))


def test_late_and_repeated_batches_and_a_failed_commit(spark, tmp_path, monkeypatch):
    path, fold, parts = str(tmp_path / "s"), latest.latest("k", "at", "id"), batches(spark, 5)
    for n in (3, 0, 4):
        latest.add_batch(parts[n], n, path, "k", fold, buckets=2, runs=2)
    before = sorted(map(str, latest.read_state(spark, path, parts[0].schema, fold).collect()))

    def fail(*_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(latest.files, "write_document", fail)
        with pytest.raises(OSError, match="no space"):
            latest.add_batch(parts[1], 1, path, "k", fold, buckets=2, runs=2)
    assert sorted(map(str, latest.read_state(spark, path, parts[0].schema, fold).collect())) == before
    for n in (1, 1, 2, 0, 3):
        latest.add_batch(parts[n], n, path, "k", fold, buckets=2, runs=2)
    whole = parts[0].union(parts[1]).union(parts[2]).union(parts[3]).union(parts[4])
    assert sorted(map(str, latest.read_state(spark, path, whole.schema, fold).collect())) == sorted(map(str, fold(whole).collect()))
    named = {f for n in latest.versions(spark, path) for run in latest.files.read_document(spark, latest._version_path(path, n))["buckets"].values() for f in run}
    assert set(folders(path)) == named  # what the failed batch left is gone


def test_an_empty_state(spark, tmp_path):
    fold, schema = latest.latest("k", "at", "id"), spark.createDataFrame([], SCHEMA).schema
    assert latest.read_state(spark, str(tmp_path / "none"), schema, fold).count() == 0
    latest.add_batch(spark.createDataFrame([], SCHEMA), 0, str(tmp_path / "s"), "k", fold)
    assert latest.read_state(spark, str(tmp_path / "s"), schema, fold).count() == 0


def test_digest_of_a_multiset(spark):
    rows = [(i, f"t{i % 7}", None if i % 3 else i * 1.5) for i in range(200)]
    df = spark.createDataFrame(rows, "a long, b string, c double")
    own = lambda d: state.digest(d).first().digest
    same = [df, df.orderBy(F.desc("a")).repartition(5), df.select("c", "a", "b"), df.coalesce(1)]
    assert len({own(d) for d in same}) == 1 and state.digest(df).first()["rows"] == 200
    other = [df.where("a <> 5"), df.union(df.where("a = 5")), df.withColumn("b", F.when(F.col("a") == 5, "x").otherwise(F.col("b"))), df.withColumnRenamed("b", "d"), df.withColumn("a", F.col("a").cast("int")),
             df.where("a <> 5").union(df.where("a = 6")), df.limit(0), df.withColumn("b", F.when(F.col("a") != 5, F.col("b")))]
    assert len({own(d) for d in other} | {own(df)}) == len(other) + 1
