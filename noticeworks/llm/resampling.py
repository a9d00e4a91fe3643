"""Importance resampling towards a target, with a dictionary of distinct features.

A document's features are all runs of 1 to ``longest`` consecutive words. They are counted as
strings over all documents and over the target, each distinct string is hashed once to one of
``buckets``, and the counts are added up by bucket. The logarithm of how much likelier a bucket
is in the target is its gain, and the gains of its strings go back to the documents: a weight is
the mean gain of a document's features. Documents are drawn without replacement by weight plus
Gumbel noise that is seeded by doc_id.

Few strings of two words repeat within a document, so a row per document and string would be
many times the text. Documents are taken in blocks of bounded size: a block numbers its distinct
words and keeps its documents as those numbers (``blocks``). Its distinct features go, as
strings with their counts in the block, to the chunks of the global dictionary, one page for
each chunk (``pages``). A chunk has all counts of its strings, hashes each once, and answers
every page with its strings' buckets, in the order of the page (``dictionary``). In the end each
block meets its answers and adds up the gains of its documents' features.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticeworks.llm.common import expanded, partitions, scratch, table, written

#: Bytes of words in lower case; all others separate words.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SPACE, _LINE = 32, 10
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


@dataclass(frozen=True)
class Resampling:
    """Runs of 1 to ``longest`` words in ``buckets``. Of the documents with ``min_words`` or more,
    ``share`` in a hundred are drawn. A block holds texts of ``block_bytes`` or one longer text;
    a chunk of the dictionary about ``chunk_features`` strings of blocks at most."""

    longest: int = 2
    buckets: int = 10_000
    share: int = 25
    min_words: int = 20
    seed: int = 7
    block_bytes: int = 6_000_000
    chunk_features: int = 500_000


def cut(raw: bytes, separator: int) -> tuple[pa.Array, np.ndarray]:
    """The stretches between separators as an array of bytes, and where each starts."""
    marked = np.frombuffer(bytes([separator]) + raw + bytes([separator]), np.uint8)
    inside = marked != separator
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(marked[inside])]), starts


def _block(ids: list[int | None], texts: list[bytes], target: bool) -> pa.RecordBatch:
    words, starts = cut(b" ".join(texts).translate(_WORDS), _SPACE)
    ends = np.cumsum([len(t) + 1 for t in texts])
    sizes = np.diff(np.searchsorted(starts, ends), prepend=0)
    encoded = words.dictionary_encode()
    order = pc.sort_indices(encoded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    numbers = rank[encoded.indices.to_numpy(zero_copy_only=False)] if len(words) else rank
    vocabulary = b" ".join(encoded.dictionary.take(pa.array(order)).to_pylist())
    packed = zstandard.ZstdCompressor(3)
    return pa.RecordBatch.from_pydict(
        {"block": [uuid.uuid4().hex], "target": [target], "doc_ids": pa.array([ids], pa.list_(pa.int64())), "sizes": pa.array([sizes.tolist()], pa.list_(pa.int64())), "n_words": pa.array([len(words)], pa.int64()), "words": [packed.compress(numbers.tobytes())], "vocabulary": [packed.compress(vocabulary)]}
    )


def blocks(docs: DataFrame, target: bool, rule: Resampling) -> DataFrame:
    """The documents (doc_id, text) of each block as numbers of its distinct words, in order:
    block, target, doc_ids, sizes (words of each), n_words, words, vocabulary (both compressed)."""
    limit = rule.block_bytes

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(doc_id.as_py())
                texts.append((text.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(texts[-1]) + 1
                if size >= limit:
                    yield _block(ids, texts, target)
                    ids, texts, size = [], [], 0
        if ids:
            yield _block(ids, texts, target)

    schema = "block string, target boolean, doc_ids array<long>, sizes array<long>, n_words long, words binary, vocabulary binary"
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(gather, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time: a block's is of some megabytes."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


@dataclass
class _Level:
    """The distinct features of one length in a block: ``at`` the words they begin with, in
    order, ``which`` feature each is; a feature is feature ``parent`` of the level before and the
    word ``last``; ``keys`` deal features out."""

    at: np.ndarray
    which: np.ndarray
    parent: np.ndarray
    last: np.ndarray
    keys: np.ndarray


def _levels(words: np.ndarray, sizes: np.ndarray, vocabulary: list[bytes], longest: int) -> list[_Level]:
    document = np.repeat(np.arange(len(sizes)), sizes)
    each = np.arange(len(vocabulary))
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary))
    found = [_Level(np.arange(len(words)), words, each, each, own)]
    for k in range(1, longest):
        before = found[-1]
        on = before.at + k < len(words)
        at, first = before.at[on], before.which[on]
        same = document[at] == document[at + k]
        at, first = at[same], first[same]
        codes, which = np.unique(first.astype(np.int64) * len(vocabulary) + words[at + k], return_inverse=True)
        parent, last = np.divmod(codes, max(1, len(vocabulary)))
        mixed = (before.keys[parent] * _ODD[0] + own[last]) * _ODD[1]
        found.append(_Level(at, which, parent, last, mixed ^ (mixed >> np.uint64(31))))
    return found


def _read(row: dict, longest: int) -> tuple[list[_Level], pa.Array]:
    unpacked = zstandard.ZstdDecompressor()
    vocabulary, _ = cut(unpacked.decompress(row["vocabulary"]), _SPACE)
    words = np.frombuffer(unpacked.decompress(row["words"]), np.int32)
    return _levels(words, np.array(row["sizes"], np.int64), vocabulary.to_pylist(), longest), vocabulary


def _dealt(levels: list[_Level], chunks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of all levels in the order of their chunks; the chunks that have some, and
    where each begins, with the end."""
    chunk = np.concatenate([x.keys for x in levels]) % np.uint64(chunks)
    order = np.argsort(chunk, kind="stable")
    found, first = np.unique(chunk[order], return_index=True)
    return order, found.astype(np.int64), np.append(first, len(order))


def pages(of: DataFrame, chunks: int, rule: Resampling) -> DataFrame:
    """chunk, block, target, features (strings by line) and counts, both compressed: the distinct
    features of each block, counted."""
    longest = rule.longest

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = zstandard.ZstdCompressor(3)
        for row in _rows(batches):
            if not row["n_words"]:
                continue
            levels, vocabulary = _read(row, longest)
            strings = [vocabulary]
            for x in levels[1:]:
                strings.append(pc.binary_join_element_wise(strings[-1].take(pa.array(x.parent)), vocabulary.take(pa.array(x.last)), b" "))
            counts = np.concatenate([np.bincount(x.which, minlength=len(x.keys)) for x in levels]).astype(np.int32)
            order, found, bounds = _dealt(levels, chunks)
            listed = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.concat_arrays(strings).take(pa.array(order)))
            joined = pc.binary_join(listed, b"\n")
            n = len(found)
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array(found, pa.int64()), "block": [row["block"]] * n, "target": [row["target"]] * n,
                    "features": [packed.compress(x.as_buffer()) for x in joined],
                    "counts": [packed.compress(counts[order[a:b]].tobytes()) for a, b in zip(bounds, bounds[1:], strict=False)],
                }
            )

    schema = "chunk long, block string, target boolean, features binary, counts binary"
    return of.select("block", "target", "sizes", "n_words", "words", "vocabulary").mapInArrow(write, schema)


def dictionary(of: DataFrame, rule: Resampling) -> DataFrame:
    """From pages: a row per page with block, chunk and the buckets of its strings (compressed),
    and a row per chunk, with a null block, of sums: what the documents and the target have in
    each bucket."""
    buckets = rule.buckets

    def count(page: pa.Table) -> pa.Table:
        packed, unpacked = zstandard.ZstdCompressor(3), zstandard.ZstdDecompressor()
        strings, places = [], [0]
        for x in page.column("features"):
            strings.append(cut(unpacked.decompress(x.as_py()), _LINE)[0])
            places.append(places[-1] + len(strings[-1]))
        encoded = pa.concat_arrays(strings).dictionary_encode()
        which = encoded.indices.to_numpy()
        bucket = np.fromiter((zlib.crc32(x) % buckets for x in encoded.dictionary.to_pylist()), np.uint32, len(encoded.dictionary))
        counts = np.concatenate([np.frombuffer(unpacked.decompress(x.as_py()), np.int32) for x in page.column("counts")])
        aim = np.repeat(page.column("target").to_numpy(zero_copy_only=False).astype(bool), np.diff(places))
        # of each string in documents and target, then by bucket
        s, t = (np.bincount(which[side], weights=counts[side], minlength=len(bucket)) for side in (~aim, aim))
        sums = [np.bincount(bucket, weights=x, minlength=buckets).astype(np.int64) for x in (s, t)]
        used = np.flatnonzero(sums[0] + sums[1])
        kind = np.uint16 if buckets <= 1 << 16 else np.uint32
        answers = bucket[which].astype(kind)
        n = page.num_rows
        return pa.table(
            {
                "block": pa.chunked_array([*page.column("block").chunks, pa.array([None], page.schema.field("block").type)]),
                "chunk": pa.concat_arrays([*page.column("chunk").chunks, page.column("chunk").chunk(0).slice(0, 1)]),
                "buckets": [*(packed.compress(answers[a:b].tobytes()) for a, b in zip(places, places[1:], strict=False)), None],
                "sums": pa.array([*[None] * n, [{"bucket": int(i), "s": int(sums[0][i]), "t": int(sums[1][i])} for i in used]], pa.list_(pa.struct([("bucket", pa.int64()), ("s", pa.int64()), ("t", pa.int64())]))),
            }
        )

    return of.groupBy("chunk").applyInArrow(count, "block string, chunk long, buckets binary, sums array<struct<bucket: long, s: long, t: long>>")


def gains(sums: dict[int, tuple[int, int]], buckets: int) -> list[int]:
    """Each bucket's gain in thousandths: floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets))))."""
    all_s, all_t = (sum(x[i] for x in sums.values()) for i in (0, 1))
    found = []
    for bucket in range(buckets):
        s, t = sums.get(bucket, (0, 0))
        found.append(math.floor(1000 * math.log(float((t + 1) * (all_s + buckets)) / float((s + 1) * (all_t + buckets)))))
    return found


def importance(docs: DataFrame, target: DataFrame, rule: Resampling | None = None) -> DataFrame:
    """doc_id, n_words, n_features and weight of each of ``docs`` (doc_id, text), towards the
    texts of ``target`` (text).

    Null and empty texts and those without words have no features and weight 0. A null doc_id
    is a document like others, and so is each of repeated rows. Texts of any length are read
    whole. An empty table gives an empty result; without a target all of its counts are 0.
    Columns other than these are ignored. The driver sees the sums of the buckets alone.
    """
    rule = rule or Resampling()
    spark, longest, buckets = docs.sparkSession, rule.longest, rule.buckets
    with scratch(spark):
        sides = blocks(docs, False, rule).unionByName(blocks(target.select(F.lit(None).alias("doc_id"), "text"), True, rule))
        held = written(sides, "blocks", compression="zstd")
        total = held.agg(F.sum("n_words")).first()[0] or 0
        chunks = max(partitions(spark), longest * total // rule.chunk_features + 1)
        answers = written(dictionary(pages(held, chunks, rule), rule), "dictionary", compression="zstd")
        sums = answers.where("block IS NULL").select(F.inline("sums")).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
        found = np.array(gains({r["bucket"]: (r["s"], r["t"]) for r in sums.collect()}, buckets), np.int64)

        def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            unpacked, kind = zstandard.ZstdDecompressor(), np.uint16 if buckets <= 1 << 16 else np.uint32
            for row in _rows(batches):
                sizes = np.array(row["sizes"], np.int64)
                gained = np.zeros(row["n_words"] + 1, np.int64)  # by the word before which features begin
                if row["n_words"]:
                    levels, _ = _read(row, longest)
                    order, _, _ = _dealt(levels, chunks)
                    bucket = np.empty(len(order), np.int64)
                    bucket[order] = np.concatenate([np.frombuffer(unpacked.decompress(p["buckets"]), kind) for p in sorted(row["pages"], key=lambda p: p["chunk"])])
                    at = 0
                    for x in levels:
                        gained[x.at + 1] += found[bucket[at : at + len(x.keys)]][x.which]
                        at += len(x.keys)
                sums, ends = np.cumsum(gained), np.cumsum(sizes)
                n = sum(np.maximum(sizes - k, 0) for k in range(longest))
                weight = (sums[ends] - sums[ends - sizes]) // np.maximum(n, 1)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(row["doc_ids"], pa.int64()), "n_words": sizes, "n_features": n, "weight": weight})

        met = answers.where("block IS NOT NULL").groupBy("block").agg(F.collect_list(F.struct("chunk", "buckets")).alias("pages"))  # a block's own, so of its size
        mine = held.where("NOT target").join(met, "block", "left").select("doc_ids", "sizes", "n_words", "words", "vocabulary", "pages")
        return written(mine.mapInArrow(weigh, "doc_id long, n_words long, n_features long, weight long"), "weights", kept=True)


def gumbel_milli(seed: int, doc_id: Column) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of SHA-256 of seed and doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, rule: Resampling | None = None) -> DataFrame:
    """``importance`` with score and rank: of the documents with enough words the share with the
    highest scores is numbered from 1, by score, then doc_id; the rank of the others is null.

    A null doc_id has the noise of an empty one and comes after all others of its score. Equal
    rows have the same score and are numbered one after the other. Ranks are the number of rows
    with a higher score, counted by score, and the place among those with the same one, so that
    no task sorts all rows; equal rows are counted before.
    """
    rule = rule or Resampling()
    scored = importance(docs, target, rule).withColumn("score", F.col("weight") + gumbel_milli(rule.seed, F.col("doc_id")))
    enough = scored.where(F.col("n_words") >= rule.min_words)
    drawn = rule.share * enough.count() // 100
    same = enough.groupBy(*scored.columns).agg(F.count("*").alias("_n"))
    above = W.orderBy(F.desc("score")).rowsBetween(W.unboundedPreceding, -1)  # a row per score: whole numbers of a few tens of thousands
    starts = same.groupBy("score").agg(F.sum("_n").alias("_all")).select(F.col("score").alias("_score"), F.coalesce(F.sum("_all").over(above), F.lit(0)).alias("_start"))
    before = W.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_words", "n_features", "weight").rowsBetween(W.unboundedPreceding, -1)
    placed = same.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(starts, F.col("score") == F.col("_score"))
    ranked = expanded(placed, "_n", "_nth").withColumn("rank", (F.col("_start") + F.col("_before") + F.col("_nth") + 1).cast("long"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).select(*scored.columns, "rank")
    return ranked.unionByName(scored.where(F.col("n_words") < rule.min_words).withColumn("rank", F.lit(None).cast("long")))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, towards the benchmark's texts."""
    found = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


OP11_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS n, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
f AS (SELECT n, unnest(w) AS f FROM d UNION ALL SELECT n, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM d),
g AS (SELECT unnest(w) AS f FROM b UNION ALL SELECT unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM b),
c AS (SELECT n, f, count(*) AS k FROM f GROUP BY n, f),
u AS (SELECT f, sum(s) AS s, sum(t) AS t, hex(encode(f)) AS h FROM (SELECT f, count(*) AS s, 0 AS t FROM f GROUP BY f UNION ALL SELECT f, 0, count(*) FROM g GROUP BY f) GROUP BY f),
steps AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, _: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i))),
k AS (SELECT f, s, t, xor(list_reduce(list_prepend(4294967295, [CAST('0x' || h[i:i+1] AS BIGINT) FOR i IN range(1, len(h), 2)]), lambda a, x: xor(a >> 8, tab[(xor(a, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM u, steps),
v AS (SELECT bucket, sum(s) AS s, sum(t) AS t, sum(sum(s)) OVER () AS all_s, sum(sum(t)) OVER () AS all_t FROM k GROUP BY bucket),
gain AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (all_s + 10000) AS DOUBLE) / CAST((s + 1) * (all_t + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM v),
m AS (SELECT n, sum(c.k) AS n_features, sum(c.k * gain) AS total FROM c JOIN k USING (f) JOIN gain USING (bucket) GROUP BY n),
e AS (SELECT doc_id, n, len(w) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
  CAST(CASE WHEN total IS NULL THEN 0 ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS BIGINT) AS weight,
  CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN m USING (n)),
z AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM e),
r AS (SELECT n, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank, count(*) OVER () AS enough FROM z WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * enough // 100 THEN rank END AS rank FROM z LEFT JOIN r USING (n)"""
