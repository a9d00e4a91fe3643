"""Runs of repeated words by Lyndon arrays.

A run is a stretch of words that repeats a shorter one: words a period apart are equal, and no
neighbour goes on so. Every run holds a Lyndon word of the length of its period, under one of
the two orders of the words (any order and its reverse), that is the longest Lyndon word at its
place. So runs are found from two Lyndon arrays, the ends of the longest Lyndon word at each
place, in two passes over the words from left to right, by comparing words alone: no suffix
structure and no hash.

A pass compares the suffix at each place with those on a chain of smaller ones before it. Where
two suffixes begin alike, what the neighbours on the chain have in common tells how far they
agree, or from where on to match them word by word; and it is remembered, by distance, how far
the last matched stretch reached, so that a comparison that starts inside needs no matching. The longest Lyndon word
at a place whose words go on to repeat is then extended both ways to its run.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm.common import SPACE, empty_if_null, table, unused

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
_FOUND_DDL = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


@dataclass(frozen=True)
class Repetition:
    """Runs of at least ``min_length`` words and ``repeats`` periods (2 or more)."""

    min_length: int = 24
    repeats: int = 3

    def __post_init__(self) -> None:
        if self.repeats < 2 or self.min_length < 1:
            raise ValueError("a run has at least 2 periods and 1 word")


def lyndon_ends(words: list[int]) -> tuple[list[int], list[int]]:
    """For every place the end of the longest Lyndon word there (the next place whose suffix is
    smaller, or the end of all), and on how many words the suffixes at both agree.

    ``words``: numbers above 0. A suffix that ends first is smaller.
    """
    w = [0, *words]  # smaller than all, so that every chain ends there
    n = len(w)
    ends, agreed, before = [n] * n, [0] * n, [0] * n
    shared = [0] * n  # words that the suffix at a place has in common with that at ``before``
    reach: dict[int, int] = {}  # by distance: where the last matched stretch ended
    for r in range(1, n):
        c, left, common = w[r], r - 1, 0
        while (a := w[left]) >= c:
            if a == c:
                # of three suffixes in order the outer two have in common what both pairs have
                both = shared[last] if common else 0
                if common > both:
                    shared[r] = both
                    break
                if common == both:
                    gap = r - left
                    stop = reach.get(gap, 0)
                    if stop <= left:
                        stop = left + (common or 1)
                        while stop + gap < n and w[stop] == w[stop + gap]:
                            stop += 1
                        reach[gap] = stop
                    common = stop - left
                    if stop + gap < n and w[stop] < w[stop + gap]:
                        shared[r] = common
                        break
                last = left
                agreed[left] = common
            ends[left] = r
            left = before[left]
        before[r] = left
    return [e - 1 for e in ends[1:]], agreed[1:]


def runs_of(words: list[int], rule: Repetition) -> list[tuple[int, int, int]]:
    """The runs as (start, length, period), by start and period. ``words``: numbers above 0."""
    n = len(words)
    if n < rule.min_length:
        return []
    top, places, found = max(words) + 1, np.arange(n), set()
    for order in (words, [top - x for x in words]):
        ends, agreed = map(np.array, lyndon_ends(order))
        periods = ends - places
        # the first Lyndon word of a run begins in its first period, so the rest of it agrees
        enough = agreed > np.maximum(rule.min_length - 2 * periods, (rule.repeats - 2) * periods)
        last: dict[int, int] = defaultdict(int)
        for i in np.flatnonzero(enough).tolist():
            p = int(periods[i])
            if i + p <= last[p]:
                continue  # inside the run with this period that was found last
            start, end = i, i + p + int(agreed[i])
            while start > 0 and words[start - 1] == words[start - 1 + p]:
                start -= 1
            last[p] = end
            if end - start >= max(rule.min_length, rule.repeats * p):
                found.add((start, end - start, p))
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [x for x, covered in zip(words, np.cumsum(gone).tolist(), strict=False) if not covered]


def _search(texts: pa.Array, rule: Repetition) -> pa.Array:
    """n_words, runs and collapsed of each text."""
    counts, ends, parts, collapsed = [], [0], [], []
    for text in texts:
        # bytes split at ASCII white space alone, text would at any
        words = (text.as_py() or "").encode().split()
        numbers: dict[bytes, int] = {}
        ranks = [numbers.setdefault(x, len(numbers) + 1) for x in words]
        runs = runs_of(ranks, rule)
        counts.append(len(words))
        parts += runs
        ends.append(len(parts))
        collapsed.append(b" ".join(kept_words(words, runs)))
    columns = list(zip(*parts, strict=True)) or [(), (), ()]
    listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_RUN)))
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), listed, pa.array(collapsed, pa.binary()).cast(pa.string())], fields=list(_FOUND))


def with_runs(docs: DataFrame, rule: Repetition | None = None, text: str = "text") -> DataFrame:
    """docs with n_words, ``runs`` (array of start, length and period in words, by start and
    period) and ``collapsed``: the words that no run contains after its first period, joined by
    one space.

    Words are what ASCII white space separates. A null or empty text, or one of white space, has
    no words, no runs and an empty ``collapsed``; doc_ids, null or repeated, don't matter, and
    equal texts have equal results. Texts of any length are searched whole, each in the task
    that reads it: nothing is shuffled. Columns of docs named like those added are replaced, all
    others come back as they were; an empty table gives an empty result.
    """
    rule = rule or Repetition()

    @F.arrow_udf(_FOUND_DDL)
    def search(texts: pa.Array) -> pa.Array:
        return _search(texts, rule)

    (found,) = unused(docs, "_found")
    added = ("n_words", "runs", "collapsed")
    searched = docs.withColumn(found, search(F.col(text)))
    return searched.select(*(F.col(c) for c in docs.columns if c.lower() not in added), *(F.col(f"{found}.{c}").alias(c) for c in added))


def collapse_runs(docs: DataFrame, rule: Repetition | None = None) -> DataFrame:
    """docs in which texts with runs hold each run's first period only, n_chars following.

    Texts without runs stay as they are, white space included; null texts stay null. The rest is
    as for ``with_runs``.
    """
    (runs, new) = unused(docs, "_runs", "_new")
    searched = with_runs(docs.select("*", F.col("text").alias(new)), rule)
    hit = F.size("runs") > 0
    changed = {"text": F.when(hit, F.col("collapsed")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(hit, F.length("collapsed").cast("long")).otherwise(F.col("n_chars"))
    return searched.select(*(changed.get(c, F.col(c)).alias(c) for c in docs.columns))


def planted_repeats(doc_id: Column, words: Column) -> Column:
    """The words of a document, of which each tenth document repeats a stretch from a place on.

    With h the CRC-32 of the decimal doc_id and g = h div 10, where h is divisible by 10 and
    there are n > 0 words, words from a = g mod n on repeat p = 1 + (n - a) div (3 + g mod 8)
    words. Words of a null doc_id stay as they are.
    """
    h = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    g, n = F.floor(h / 10).cast("long"), F.size(words).cast("long")
    a = F.try_mod(g, n)
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    again = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))
    return F.when((h % 10 == 0) & (n > 0), again).otherwise(words)


def op12_lyndon_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with planted repeats: their runs, digested, and what is left of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", empty_if_null().alias("text"))
    words = docs.select("doc_id", F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "").alias("words"))
    planted = words.select("doc_id", F.array_join(planted_repeats(F.col("doc_id"), F.col("words")), " ").alias("text"))
    found = with_runs(planted).select("doc_id", "runs", "collapsed")
    return found.select("doc_id", "runs", best_run(F.col("runs")).alias("best"), "collapsed").select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def best_run(runs: Column) -> Column:
    """The run with the greatest length over period, exactly; of equal ones the least start, then
    period. ``runs`` are by start and period."""
    less = lambda a, b: a["length"] * b["period"] < b["length"] * a["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(less(best, r), r).otherwise(best))

