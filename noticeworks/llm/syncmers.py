"""Document fingerprints from closed syncmers.

A k-mer of code points is an anchor if the smallest hash among its s-mers is that of its first
or last one. Whether it is depends on its own text alone, so an anchor survives any edit that
doesn't touch it and has the same hash at any position. A fingerprint keeps the smallest
distinct anchor hashes, a sketch of fixed size, listed in the order of their positions. Two
fingerprints are matched by position: of the anchors that both have, the longest chain that
stands in the same order in both counts, as a share of the sketch of both together. A text
shorter than ``Syncmers.short`` also has anchors of smaller k, down to single code points, and
its own hash, so that a short edited text keeps what the edit left alone.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm.common import partitions, row_key, table, unused

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


@dataclass(frozen=True)
class Syncmers:
    """k-mers of ``k`` code points with s-mers of ``s``, so about 2 in k - s + 1 k-mers are
    anchors; ``size`` hashes of 32 bits to a fingerprint. Texts of fewer than ``short`` code
    points have anchors of ``small`` (s, k) too."""

    size: int = 128
    s: int = 8
    k: int = 24
    short: int = 192
    small: tuple[tuple[int, int], ...] = ((3, 8), (1, 3))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def _joined(h: np.ndarray, length: int, wanted: int, first: np.ndarray, rot: int) -> tuple[np.ndarray, int]:
    """Hashes of ``wanted`` elements from hashes of ``length``: doubled while that fits, then
    lengthened by single ones."""
    while length < wanted:
        step, tail = (length, h) if 2 * length <= wanted else (length, first)
        n = len(h) - step if tail is h else len(first) - length
        h = h[:n] * _MIX[1] + ((tail[step : step + n] << np.uint64(rot)) | (tail[step : step + n] >> np.uint64(64 - rot))) * _MIX[2]
        length += step if tail is not first else 1
        rot = rot * 2 % 61 + 3
    return h, length


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` hashes side by side."""
    length = 1
    while 2 * length <= width:
        h = np.minimum(h[:-length], h[length:])
        length *= 2
    return np.minimum(h[: len(h) - (width - length)], h[width - length :]) if width > length else h


def _closed(points: np.ndarray, s: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the closed syncmers of one (s, k)."""
    if len(points) < k:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    single = (points + np.uint64(1)) * _MIX[0]
    h, _ = _joined(single, 1, s, single, 13)
    h = _mixed(h)
    least = _least(h, k - s + 1)
    first, last = h[: len(least)], h[k - s :]
    at = np.flatnonzero((first == least) | (last == least))
    whole = last[at] * _MIX[2] + np.uint64(k)
    for i in range(0, k - s, s):  # s-mers side by side, and the last, cover the k-mer
        whole = (whole ^ (whole >> np.uint64(29))) * _MIX[1] + h[at + i]
    return at, _mixed(whole)


def anchors(text: str, options: Syncmers | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and 64-bit hashes of a text's anchors, by position.

    Those of (s, k), and in a short text those of the smaller ones and at 0 a hash of itself. A
    long text without any, which long repeats can be, has its own hash too. Only an empty text
    has none.
    """
    options = options or Syncmers()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(points):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    sizes = [(options.s, options.k), *(options.small if len(points) < options.short else ())]
    found = [_closed(points, s, k) for s, k in sizes]
    if len(sizes) > 1 or not len(found[0][0]):
        itself = np.uint64(int.from_bytes(hashlib.blake2b(points.tobytes(), digest_size=8).digest(), "little"))
        found.append((np.zeros(1, np.int64), np.array([itself])))
    if len(found) == 1:
        return found[0]
    at, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(at, kind="stable")
    return at[order], hashes[order]


def sketch(text: str, options: Syncmers | None = None) -> np.ndarray:
    """The smallest distinct 32-bit anchor hashes, each at its first place in the text's order."""
    options = options or Syncmers()
    hashes, first = np.unique((anchors(text, options)[1] >> np.uint64(32)).astype(np.uint32), return_index=True)
    hashes, first = hashes[: options.size], first[: options.size]
    return hashes[np.argsort(first)]


def likeness(a: np.ndarray, b: np.ndarray, size: int) -> float:
    """The longest chain of common anchors in the same order in both, as a share of the smallest
    ``size`` hashes of both together. Two empty sketches, which only empty texts have, are alike."""
    if not len(a) and not len(b):
        return 1.0
    union = np.union1d(a, b)[:size]
    most = union[-1]
    where = {x: i for i, x in enumerate(b.tolist())}
    chain: list[int] = []  # the least end of a chain of each length
    for x in a[a <= most].tolist():
        if (i := where.get(x)) is not None:
            place = bisect.bisect_left(chain, i)
            chain[place : place + 1] = [i]
    return len(chain) / len(union)


def with_fingerprints(docs: DataFrame, text: str = "text", options: Syncmers | None = None) -> DataFrame:
    """docs with ``fingerprint`` (hex) and ``anchors``: array of (position, hash) by position.

    Null texts count as empty: an empty fingerprint and no anchors. Each row for itself, equal
    rows alike, texts of any length whole. An empty table gives an empty result. Columns of docs
    with these names are replaced; all others stay as they are.
    """
    docs = docs.drop("fingerprint", "anchors")
    (both,) = unused(docs, "_f")
    options = options or Syncmers()

    @F.pandas_udf("struct<fingerprint:string,anchors:array<struct<position:bigint,hash:bigint>>>")
    def marks(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            at, hashes = anchors(t or "", options)
            rows.append((sketch(t or "", options).astype(">u4").tobytes().hex(), list(zip(at.tolist(), hashes.view(np.int64).tolist(), strict=True))))
        return pd.DataFrame(rows, columns=["fingerprint", "anchors"])

    return docs.withColumn(both, marks(F.col(text))).select("*", f"{both}.fingerprint", f"{both}.anchors").drop(both)


#: A range of keys of one doc_id, of which a key's first 16 bits choose one.
_KEY_BITS = 16


def _in_order(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text, _key, _bucket, _guest, and the number of buckets: rows dealt by ranges of
    descending doc_id, then key, each range also with the first row of the next as a guest.

    Range bounds are quantiles of all doc_ids, as many as twice the shuffle partitions. A doc_id
    that fills several quantiles, and the null one, is cut further by ranges of the content's
    key, in as many as it fills. What reaches the driver is those and one key per range.
    """
    spark = docs.sparkSession
    n = 2 * partitions(spark)
    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("_key", row_key())
    seen = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10_000).alias("b"), F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("none")).first()
    fills = Counter(seen["b"] or [])
    bounds = np.array(sorted(fills), np.int64)
    # in descending order: what is above each bound, then the bound itself, in as many parts as it fills
    parts = np.array([fills[b] if fills[b] > 1 else 0 for b in bounds.tolist()], np.int64)
    none = 1 + (n * seen["none"] // seen["n"] if seen["n"] else 0)
    first = np.concatenate((np.cumsum((parts + 1)[::-1])[::-1], [0])) if len(bounds) else np.zeros(1, np.int64)
    last = int(first[0]) + 1  # the range below all bounds is first[0]
    total = last + none

    @F.pandas_udf("int")
    def bucket(ids: pd.Series, missing: pd.Series, keys: pd.Series) -> pd.Series:
        prefix = (1 << _KEY_BITS) - 1 - keys.str[: _KEY_BITS // 4].map(lambda x: int(x, 16)).to_numpy(np.int64)
        null, values = missing.to_numpy(bool), ids.to_numpy(np.int64)
        above = np.searchsorted(bounds, values, "left")  # bounds below the value
        found = first[above].copy()
        if len(bounds):
            at = np.minimum(above, len(bounds) - 1)
            hot = (bounds[at] == values) & (parts[at] > 0)
            found[hot] = first[at[hot]] - parts[at[hot]] + (prefix[hot] * parts[at[hot]] >> _KEY_BITS)
        found[null] = last + (prefix[null] * none >> _KEY_BITS)
        return pd.Series(found)

    # pandas has no null among whole numbers: they go apart, so that large ids stay exact
    placed = rows.withColumn("_bucket", bucket(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), F.col("doc_id").isNull(), "_key"))
    heads = placed.groupBy("_bucket").agg(F.max(F.struct(F.col("doc_id"), F.col("_key"))).alias("head")).orderBy("_bucket").collect()
    guests = {r["head"]["_key"]: heads[i - 1]["_bucket"] for i, r in enumerate(heads)}  # the first range follows the last
    if not guests:
        return placed.withColumn("_guest", F.lit(0)), total
    head = spark.createDataFrame(list(guests.items()), "_key string, _for int")
    # a repeated head row is a guest once: its copies are told apart nowhere
    own = placed.withColumn("_guest", F.lit(0))
    visiting = rows.join(F.broadcast(head), "_key").dropDuplicates(["_key"]).select("doc_id", "text", "_key", F.col("_for").alias("_bucket"), F.lit(1).alias("_guest"))
    return own.unionByName(visiting), total


def compare_with_edits(docs: DataFrame, options: Syncmers | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited text and their likeness.

    The edited text has the last floor(n/2) code points replaced by the first as many (or all)
    of the next document, in descending doc_id (after the last: the first). A null text is
    empty; a null doc_id comes last; of equal doc_ids the greater key of content comes first,
    and equal rows follow each other. A lone document is followed by itself. An empty table gives
    an empty result. Columns other than doc_id and text are ignored. Texts are shuffled once, by ranges of doc_id; a range is
    read as a stream with one row held back.
    """
    options = options or Syncmers()
    size = options.size
    dealt, n = _in_order(docs)
    ordered = dealt.repartitionById(n, F.col("_bucket").cast("int")).sortWithinPartitions(F.col("_bucket"), F.col("_guest"), F.col("doc_id").desc_nulls_last(), F.col("_key").desc())

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # (bucket, doc_id, text, sketch)

        for batch in batches:
            out = []
            for bucket, guest, doc, text in zip(batch["_bucket"], batch["_guest"], batch["doc_id"], batch["text"], strict=True):
                own = sketch(text, options)
                if held is not None and held[0] == bucket:
                    _, before, was, mark = held
                    half = len(was) // 2
                    edited = was[: len(was) - half] + text[:half]
                    new = sketch(edited, options)
                    out.append(
                        (
                            before, len(was), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), mark.astype(">u4").tobytes().hex(),
                            new.astype(">u4").tobytes().hex(), likeness(mark, new, size), likeness(mark, own, size),
                        )
                    )
                held = None if guest else (bucket, None if pd.isna(doc) else int(doc), text, own)
            yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]).astype({"doc_id": "Int64"})

    return ordered.select("_bucket", "_guest", "doc_id", "text").mapInPandas(
        compared, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    )


def op5_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, against their edited texts and the next documents."""
    return compare_with_edits(table(spark, sf_dir, "documents"))
