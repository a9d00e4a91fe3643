"""A quality classifier on random-indexing word vectors.

Every word has a sparse random index vector. The vector of a word is the sum of the index
vectors of the words near it, over all occurrences in all documents, beside its own index
vector, each of length one. Words share the rows of a table of fixed size by a hash, so the
vectors are counts over the whole corpus that don't grow with it. A document pools its words'
vectors (mean, spread, and products of neighbours), and a network of two layers, trained in numpy on labelled rows,
turns that into a logit. A part of the labelled rows, not trained on, chooses the temperature
that the logit is divided by, so that scores are probabilities.

Words are runs of letters and digits, and runs of other characters that aren't white space, so
that marks stuck to words have vectors of their own.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm.common import table

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")
#: Words whose vectors are looked up or counted at a time.
_CHUNK = 250_000


@dataclass(frozen=True)
class Settings:
    """``rows`` of the table of word vectors of ``dims`` numbers; index vectors have ``nonzeros``
    of 1 or -1; words up to ``window`` apart count as near. The network has ``hidden`` units and
    is trained for ``epochs``. At most ``sample`` labelled documents are trained on, those with
    the least hashes of their doc_ids; one in ``calibration`` of them chooses the temperature."""

    rows: int = 1 << 16
    dims: int = 32
    nonzeros: int = 4
    window: int = 2
    hidden: int = 32
    epochs: int = 60
    batch: int = 128
    rate: float = 3e-3
    decay: float = 1e-3
    sample: int = 20_000
    calibration: int = 5
    seed: int = 13


class _Rows(dict):
    """The table's row of each word seen; forgets them all after a million."""

    def __init__(self, rows: int) -> None:
        self.rows = rows

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = row = zlib.crc32(word) % self.rows
        return row


def word_rows(text: str | None, known: _Rows) -> np.ndarray:
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass"))
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


@cache
def index_vectors(settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero numbers of each row's index vector. A last row without
    any stands for no word."""
    rng = np.random.default_rng(settings.seed)
    places = rng.random((settings.rows, settings.dims)).argpartition(settings.nonzeros, axis=1)[:, : settings.nonzeros]
    signs = rng.choice([-1.0, 1.0], (settings.rows, settings.nonzeros))
    return np.vstack([places, np.zeros((1, settings.nonzeros), np.int64)]), np.vstack([signs, np.zeros((1, settings.nonzeros))])


def context_counts(docs: DataFrame, settings: Settings, text: str = "text") -> DataFrame:
    """row, c0, c1, ...: the sum of the index vectors near each row's words, in all documents.

    A task adds up its own; sums of at most ``rows`` rows a task are combined by Spark.
    """
    rows, dims, window = settings.rows, settings.dims, settings.window
    columns = [f"c{i}" for i in range(dims)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        places, signs = index_vectors(settings)
        known, total, pad = _Rows(rows), np.zeros((rows + 1) * dims), np.full(window, rows)

        def add(found: list[np.ndarray]) -> None:
            # words of different documents are a window apart
            joined = np.concatenate([x for r in found for x in (r, pad)])
            for at in range(0, len(joined), _CHUNK):
                near = joined[at : at + _CHUNK + window]
                for k in range(1, window + 1):
                    left, right = near[: min(_CHUNK, len(near) - k)], near[k : k + _CHUNK]
                    for word, other in ((left, right), (right, left)):
                        cells = (word[:, None] * dims + places[other]).ravel()
                        np.add(total, np.bincount(cells, weights=signs[other].ravel(), minlength=len(total)), out=total)

        held, size = [], 0
        for batch in batches:
            for x in batch.column(0):
                held.append(word_rows(x.as_py(), known))
                size += len(held[-1])
                if size >= 4 * _CHUNK:
                    add(held)
                    held, size = [], 0
        if held:
            add(held)
        sums = total.reshape(rows + 1, dims)[:rows]
        used = np.flatnonzero(sums.any(axis=1))
        found = pd.DataFrame(sums[used].astype(np.int64), columns=columns)
        found.insert(0, "row", used)
        for at in range(0, len(found), 10_000):
            yield pa.RecordBatch.from_pandas(found.iloc[at : at + 10_000], preserve_index=False)

    counted = docs.select(text).mapInArrow(count, ", ".join(["row long", *(f"{c} long" for c in columns)]))
    return counted.groupBy("row").agg(*(F.sum(c).alias(c) for c in columns))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def word_vectors(docs: DataFrame, settings: Settings, text: str = "text") -> np.ndarray:
    """The table of word vectors. It has a fixed size, whatever the documents."""
    context = np.zeros((settings.rows, settings.dims))
    counts = context_counts(docs, settings, text).toArrow()
    context[counts["row"].to_numpy()] = np.stack([counts[f"c{i}"].to_numpy() for i in range(settings.dims)], axis=1)
    places, signs = index_vectors(settings)
    own = np.zeros((settings.rows, settings.dims))
    np.put_along_axis(own, places[:-1], signs[:-1], axis=1)
    return (_unit(context) + _unit(own)).astype(np.float32)


def pooled(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A document's numbers: mean and spread of its words' vectors, the mean product of those of
    neighbours, and the logarithm of the number of words. Zeros for one without words."""
    n, dims = len(rows), vectors.shape[1]
    first, second, beside = np.zeros(dims), np.zeros(dims), np.zeros(dims)
    for at in range(0, n, _CHUNK):
        v = vectors[rows[at : at + _CHUNK + 1]]  # and the first of the next
        own, after = v[:_CHUNK], v[1:]
        first += own.sum(axis=0, dtype=np.float64)
        second += np.einsum("ij,ij->j", own, own, dtype=np.float64)
        beside += np.einsum("ij,ij->j", v[: len(after)], after, dtype=np.float64)
    if n:
        first, second, beside = first / n, second / n, beside / n
    return np.concatenate([first, np.sqrt(np.maximum(second - first * first, 0)), beside, [math.log1p(n)]])


def width(settings: Settings) -> int:
    """How many numbers a document has."""
    return 3 * settings.dims + 1


@dataclass(frozen=True)
class Network:
    """Two layers over standardised inputs, and the temperature of the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


@dataclass(frozen=True)
class QualityModel:
    settings: Settings
    vectors: np.ndarray
    network: Network


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def log_loss(y: np.ndarray, p: np.ndarray) -> float:
    p = np.clip(p, 1e-12, 1 - 1e-12)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def train(x: np.ndarray, y: np.ndarray, settings: Settings) -> Network:
    """A network with the least squared weights and log loss that ``epochs`` of Adam reach.

    With rows of one class alone, or none, the score is the same for all: the smoothed share of
    the class.
    """
    wide, hidden = x.shape[1], settings.hidden
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Network(np.zeros(wide), np.ones(wide), np.zeros((wide, hidden)), np.zeros(hidden), np.zeros(hidden), math.log(share / (1 - share)))
    rng = np.random.default_rng(settings.seed)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1
    z = (x - mean) / scale
    share = y.mean()
    p = [rng.normal(0, 1 / math.sqrt(wide), (wide, hidden)), np.zeros(hidden), rng.normal(0, 1 / math.sqrt(hidden), hidden), np.array(math.log(share / (1 - share)))]
    m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for epoch in range(settings.epochs):
        order = rng.permutation(len(z))
        rate = settings.rate * (1 - epoch / settings.epochs)
        for at in range(0, len(z), settings.batch):
            a, b = z[order[at : at + settings.batch]], y[order[at : at + settings.batch]]
            h = np.tanh(a @ p[0] + p[1])
            d = (_sigmoid(h @ p[2] + p[3]) - b) / len(b)
            dh = d[:, None] * p[2] * (1 - h * h)
            grads = [a.T @ dh + settings.decay * p[0], dh.sum(axis=0), h.T @ d + settings.decay * p[2], d.sum()]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Network(mean, scale, p[0], p[1], p[2], float(p[3]))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, between 1/20 and 20; 1 without rows of both classes.

    Rows count as their label but for one row of the other kind in each class, so that a few
    rows that are all on their side don't make every score 0 or 1.
    """
    good, bad = y.sum(), len(y) - y.sum()
    if not good or not bad:
        return 1.0
    aim = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    tried = np.exp(np.linspace(-math.log(20), math.log(20), 241))
    return float(min(tried, key=lambda t: log_loss(aim, _sigmoid(logits / t))))


def labelled_texts(docs: DataFrame, labels: DataFrame, settings: Settings, label: str) -> DataFrame:
    """doc_id, text and y of at most ``sample`` labelled documents.

    Of a document's labels the lowest counts, null ones and those of null doc_ids don't; of
    several texts of a doc_id the least.
    """
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y")).where("y IS NOT NULL")
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").cast("double").alias("y"))


def fit_quality(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, label: str = "quality") -> QualityModel:
    """Word vectors of all docs, and a network fitted on those that ``labels`` (doc_id, ``label``
    of 0 or 1) marks. The driver sees at most ``sample`` rows of a few numbers each."""
    settings = settings or Settings()
    vectors = word_vectors(docs, settings)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    rows = settings.rows

    @F.arrow_udf("array<double>")
    def numbers(texts: pa.Array) -> pa.Array:
        known = _Rows(rows)
        return pa.array([pooled(word_rows(t.as_py(), known), shared.value).tolist() for t in texts], pa.list_(pa.float64()))

    part = F.pmod(F.xxhash64(F.lit(settings.seed), "text"), F.lit(settings.calibration))  # copies of a text stay together
    found = labelled_texts(docs, labels, settings, label).select("doc_id", "y", part.alias("part"), numbers("text").alias("x")).collect()
    found.sort(key=lambda r: r.doc_id)
    x = np.array([r.x for r in found]).reshape(len(found), width(settings))
    y, held = np.array([r.y for r in found]), np.array([r.part == 0 for r in found], bool)
    network = train(x[~held], y[~held], settings)
    return QualityModel(settings, vectors, replace(network, temperature=temperature(network.logits(x[held]), y[held])))


def quality_score(spark: SparkSession, text: Column, model: QualityModel) -> Column:
    """The probability, of a text alone, that its label is 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        model = shared.value
        known = _Rows(model.settings.rows)
        x = np.array([pooled(word_rows(t.as_py(), known), model.vectors) for t in texts]).reshape(len(texts), width(model.settings))
        return pa.array(model.network.probabilities(x), pa.float64())

    return score(text)


def score_quality(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """docs with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 if it is 0.5
    or more, else 0).

    Null texts count as empty; texts without words have a score, that of no words. Texts are
    read whole, whatever their length, and nothing else of a row is. Equal texts have equal
    scores; rows with null or repeated doc_ids are scored like others. Columns of docs with
    these names are replaced, all others come back as they were; an empty table gives an empty
    result. Nothing is shuffled.
    """
    rest = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    scored = docs.select(*rest, quality_score(docs.sparkSession, F.col(text), model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def held_out(doc_id: Column) -> Column:
    """Whether the CRC-32 of a decimal doc_id leaves 1 when divided by 3; a null one isn't."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model that learns labels from rows that aren't held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    scored = score_quality(docs, fit_quality(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
