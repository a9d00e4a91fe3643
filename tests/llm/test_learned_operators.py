"""Importance resampling, runs, the quality classifier: against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeworks.llm import classifier, resampling, runs
from noticeworks.llm.resampling import Resampling
from noticeworks.llm.runs import Repetition

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# runs


def brute_runs(w, rule):
    found = set()
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            start = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            length = i + p - start
            part = w[start : start + length]
            if length >= max(rule.min_length, rule.repeats * p) and not any(part[q:] == part[:-q] for q in range(1, p)):
                found.add((start, length, p))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        n, k = rng.randint(0, 60), rng.randint(1, 4)
        w = [rng.randint(1, k) for _ in range(n)]
        if n > 5 and rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randint(1, 9)
            w = [x if i < a else w[a + (i - a) % min(p, n - a)] for i, x in enumerate(w)]
        for rule in (Repetition(), Repetition(1, 2), Repetition(6, 2), Repetition(9, 3), Repetition(8, 4)):
            assert runs.runs_of(w, rule) == brute_runs(w, rule)
    with pytest.raises(ValueError, match="2 periods"):
        Repetition(24, 1)


class Matched(int):
    """A word that counts how often it is matched."""

    times = 0
    __hash__ = int.__hash__

    def __eq__(self, other):
        Matched.times += 1
        return int(self) == int(other)


def test_words_matched_grow_with_the_text():
    """Texts that repeat at many distances and depths: words matched stay within n log n."""
    fib = [[1], [1, 2]]
    while len(fib[-1]) < 20_000:
        fib.append(fib[-1] + fib[-2])
    blocks = [x for k in range(1, 200) for x in [1] * k + [2]]
    passage = [random.Random(2).randint(1, 400) for _ in range(300)]
    for words in ([1] * 20_000, [1, 2] * 10_000, fib[-1], blocks, blocks[::-1], [x for i in range(60) for x in [*passage, 1000 + i]]):
        Matched.times = 0
        ends, agreed = runs.lyndon_ends([Matched(x) for x in words])
        assert Matched.times < len(words) * math.log2(len(words)) and len(ends) == len(agreed) == len(words)


def digest(text, rule=None, doc_id=None):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    found = brute_runs(w, rule or Repetition())
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    milli = 1000 * best[1] // best[2] if found else None
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{s},{n},{p}\n" for s, n, p in found), " ".join(x for i, x in enumerate(w) if i not in gone))]
    return (len(found), *best, milli, *sha)


def test_runs_of_documents(spark, tmp_path, clashing, nothing):
    short = ["", " \n", "a", "a " * 24, "a " * 23, "x " + "a b c " * 9 + "y", "é   é " * 30, "A a " * 14 + "A A " * 20, "v w " * 15 + "w " * 30 + "v w " * 12, None]
    rows = [(i, short[i % len(short)]) for i in range(120)] + [(None, "a " * 30), (5, short[5]), (5, short[5])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(str, (tuple(r) for r in runs.op12_lyndon_runs(spark, str(tmp_path)).collect())))
    assert got == sorted(str((d, *digest(t, doc_id=d))) for d, t in rows)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and short[i % len(short)] for i in range(120))
    collapsed = runs.collapse_runs(clashing)
    assert collapsed.columns == clashing.columns
    texts = {r.text for r in collapsed.collect()}
    assert "x" in texts and None in texts and " \n\t " in texts and runs.with_runs(nothing).count() == 0
    assert {r.n_chars for r in collapsed.where("text = 'x'").collect()} == {1}


# importance


def brute_importance(docs, target, rule=None):
    rule = rule or Resampling()
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    features = lambda w: [" ".join(w[i : i + k]) for k in range(1, rule.longest + 1) for i in range(len(w) - k + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % rule.buckets
    words = [(d, cut(t)) for d, t in docs]
    s, t = Counter(bucket(f) for _, w in words for f in features(w)), Counter(bucket(f) for x in target for f in features(cut(x)))
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + rule.buckets) / ((s[b] + 1) * (t.total() + rule.buckets))))
    rows = []
    for d, w in words:
        found = features(w)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{rule.seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w)))
    enough = sorted((r for r in rows if r[4] >= rule.min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    n = rule.share * len(enough) // 100
    return Counter((*r[:4], i + 1 if i < n else None) for i, r in enumerate(enough)) + Counter((*r[:4], None) for r in rows if r[4] < rule.min_words)


@pytest.mark.parametrize("rule", [Resampling(), Resampling(longest=3, buckets=70_000, share=60, min_words=1, block_bytes=500, chunk_features=50), Resampling(longest=1, buckets=7)])
def test_importance_equals_brute_force(spark, corpus, clashing, rule):
    docs = [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
    target = ["Alpha1 beta2 gamma3, é漢!", None, "", docs[2][1], "a-b_c'd 12"]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(clashing, aim, rule).select("doc_id", "n_features", "weight", "score", "rank").collect()
    # ties of equal doc_id and score apart, ranks are fixed
    assert Counter(map(tuple, got)) == brute_importance(docs, target, rule)


def test_importance_of_empty_tables_and_targets(spark, corpus, nothing):
    no_target = spark.createDataFrame([], "text string")
    assert resampling.resample(nothing, corpus.select("text")).count() == 0
    docs = [(r.doc_id, r.text) for r in corpus.collect()]
    got = resampling.resample(corpus, no_target).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert Counter(map(tuple, got)) == brute_importance(docs, [])


def test_equal_rows_are_ranked_one_by_one(spark):
    """Most rows equal, with a null id: counted as one before they are sorted, numbered each."""
    hot = spark.range(6000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("word " * 25).alias("text"))
    rest = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("other text number "), F.col("id").cast("string"), F.lit(" w" * 20)).alias("text"))
    got = resampling.resample(hot.union(rest), rest.limit(3).select("text"), Resampling(share=90)).where("rank IS NOT NULL").select("rank").collect()
    assert sorted(r[0] for r in got) == list(range(1, 7201))


def test_features_are_hashed_once(spark, monkeypatch):
    """A string of many blocks is one of the dictionary: sums of its counts, one bucket each."""
    rule = Resampling(longest=1, block_bytes=1)
    docs = spark.createDataFrame([(i, "same words again") for i in range(50)], "doc_id long, text string")
    held = resampling.blocks(docs, False, rule)
    table = resampling.dictionary(resampling.pages(held, 3, rule), rule).collect()
    sums = [x for r in table if r.block is None for x in r.sums]
    assert sorted((x.bucket, x.s, x.t) for x in sums) == sorted((zlib.crc32(w) % 10_000, 50, 0) for w in (b"same", b"words", b"again"))


# classifier


def labelled(spark, n=400):
    rng, rows = random.Random(3), []
    for i in range(n):
        words = [rng.choice("uno dos tres cuatro cinco seis siete ocho".split()) + str(rng.randint(0, 30)) for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        rows.append((i, " ".join(w + "$$%" if bad else w for w in words), 0 if bad else 1))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int")


SMALL = classifier.Settings(rows=1 << 10, dims=16, epochs=30)


def test_classifier_on_rows_held_out(spark):
    rows = labelled(spark)
    model = classifier.fit_quality(rows, rows.where("doc_id < 200").select("doc_id", "quality"), SMALL)
    got = classifier.score_quality(rows, model).where("doc_id >= 200").collect()
    assert all((r.score >= 0.5) == (r.quality == 1) == (r.predicted == 1) and 0 <= r.score <= 1 for r in got)
    assert model.network.temperature > 0


def test_classifier_reads_the_text_alone_and_is_repeatable(spark, clashing, nothing):
    rows = labelled(spark)
    labels = rows.select("doc_id", "quality")
    model, again = (classifier.fit_quality(rows.repartition(n), labels.repartition(3), SMALL) for n in (1, 5))
    assert np.array_equal(model.vectors, again.vectors) and np.array_equal(model.network.w1, again.network.w1) and model.network.temperature == again.network.temperature
    scored = classifier.score_quality(clashing, model)
    assert [c for c in scored.columns if c not in ("score", "predicted")] == clashing.columns
    by_text = {}
    for r in scored.collect():
        assert by_text.setdefault(r.text or "", r.score) == r.score and 0 <= r.score <= 1
    assert classifier.score_quality(nothing, model).count() == 0


def test_context_counts_equal_brute_force(spark):
    texts = ["a b c a", "c! c", None, "", "d"]
    got = {r.row: list(r)[1:] for r in classifier.context_counts(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3), SMALL).collect()}
    places, signs = classifier.index_vectors(SMALL)
    want, known = {}, classifier._Rows(SMALL.rows)
    for t in texts:
        w = classifier.word_rows(t, known)
        for i in range(len(w)):
            for j in range(max(0, i - 2), min(len(w), i + 3)):
                if i != j:
                    v = want.setdefault(int(w[i]), [0] * SMALL.dims)
                    for p, s in zip(places[w[j]], signs[w[j]], strict=True):
                        v[p] += int(s)
    assert got == {k: v for k, v in want.items() if any(v)}


def test_classifier_without_labels_or_with_one_class(spark, corpus):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in classifier.score_quality(corpus, classifier.fit_quality(corpus, none, SMALL)).collect()} == {0.5}
    rows = labelled(spark, 40)
    one = rows.where("quality = 1").select("doc_id", F.lit(1).alias("quality"))
    odd = one.union(spark.createDataFrame([(None, 0), (1, None), (1, 1), (1, 1)], "doc_id long, quality int"))
    assert all(r.score > 0.9 for r in classifier.score_quality(rows, classifier.fit_quality(rows, odd, SMALL)).collect())


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    z = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert abs(classifier.temperature(z * 5, y) / 5 - 1) < 0.15 and classifier.temperature(z, np.ones(4000)) == 1.0
    perfect = classifier.temperature(np.array([-9.0] * 5 + [9.0] * 5), np.array([0.0] * 5 + [1.0] * 5))
    assert 1 / (1 + np.exp(-9 / perfect)) < 0.9


def test_op13_learns_from_rows_that_are_not_held_out(spark, tmp_path):
    rows = labelled(spark, 300)
    rows.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    held = classifier.held_out(F.col("doc_id"))
    rows.select("doc_id", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")).alias("quality")).write.parquet(f"{tmp_path}/labels.parquet")  # wrong where held out
    got = {r.doc_id: r for r in classifier.op13_quality_classifier(spark, str(tmp_path)).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    truth = {r.doc_id: r.quality for r in rows.collect()}
    assert np.mean([got[i].predicted == q for i, q in truth.items()]) > 0.97


def test_copies_of_a_labelled_text_are_one_row(spark):
    """The binomial bound of the quality rules counts texts: copies stand once, on one side."""
    from noticeworks.llm import quality
    from tests.llm.conftest import prose

    rows = [(100 * i + j, prose(i, 40 + i), "en", 1 if j else i % 2) for i in range(30) for j in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    held = quality.labelled_scores(quality.with_measures(docs.drop("quality")), docs.select("doc_id", "quality"), "lang", quality.RiskControl()).collect()
    assert len(held) == 30 and sum(r.quality for r in held) == 15
    tuned = [int(hashlib.md5(prose(i, 40 + i).encode()).hexdigest()[:8], 16) % 3 == 0 for i in range(30)]
    assert sum(r.tuned for r in held) == sum(tuned)
