"""Quality rules with risk-controlled thresholds.

Each rule compares one score of a document with a cutoff. Labelled texts, each once, are split by
a hash. On the tuning part every stratum gets a cutoff per rule, out of a fixed grid: the
one that rejects the most bad documents, each good one lost weighing as much as ``good_cost``
bad ones; rules that gain nothing are left out, and the others are put in order, those that
lose fewest good documents first. Cutoff vector j is the first j rules together. On the rest,
the holdout, the good documents rejected by *any* rule of a vector are counted, k of n, and the
exact binomial probability of k or fewer at the allowed false rejection rate is the p-value.
Vectors are tested in order until one fails (fixed sequence, so their number costs nothing), at
the level divided by the number of strata with a sequence (Bonferroni). With probability
1 - level no stratum's verdict, all its rules taken together, rejects a greater share of good
documents than allowed. A stratum with too few labels to prove anything keeps everything.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm.common import SPACE, empty_if_null, scratch, table, unused, written

#: Scores of a document; each is rejected above its cutoff.
SCORES = ("symbol_share", "upper_share", "repeat_share", "dup_line_share", "mean_word_chars", "short_line_share")


#: Strata with rules up to this number are broadcast; more are joined by a shuffle.
MAX_BROADCAST_STRATA = 100_000
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "_n_upper", "_n_letters", "_n_lines", "_n_short_lines", "_text_hash")


@dataclass(frozen=True)
class RiskControl:
    """``max_false_rejection``: allowed share of good documents that a stratum's rules reject
    together. ``level``: probability that any stratum exceeds it. To prove something a stratum
    needs log(level / strata) / log(1 - max_false_rejection) good holdout rows: 86 with four
    strata. ``grid_size``: cutoffs of each score, from the mildest, ``upper``, to the harshest.
    One labelled row in ``tuning`` is for tuning. Labels beyond ``max_broadcast_labels`` rows
    are joined by a shuffle instead of a broadcast."""

    max_false_rejection: float = 0.05
    level: float = 0.05
    good_cost: float = 10.0
    tuning: int = 3
    max_broadcast_labels: int = 2_000_000
    grid_size: int = 24
    upper: tuple[tuple[str, float], ...] = (
        ("symbol_share", 0.5),
        ("upper_share", 1.0),
        ("repeat_share", 0.2),
        ("dup_line_share", 1.0),
        ("mean_word_chars", 24.0),
        ("short_line_share", 1.0),
    )

    def cutoffs(self, score: str) -> list[float]:
        top = dict(self.upper)[score]
        return [top * (self.grid_size - i) / self.grid_size for i in range(self.grid_size)]


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the word, symbol, line and repetition counts of every whole text.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, _n_upper, _n_letters,
    _n_lines, _n_short_lines and _text_hash. A null text counts as empty. Everything stays within the row: no
    shuffle. Windows are compared by 64-bit hashes of their words' hashes. Columns of docs with
    these names are replaced.
    """
    docs = docs.drop(*MEASURES)
    w_, lines_, g_, s_ = unused(docs, "_w", "_lines", "_g", "_s")
    t = empty_if_null(text)
    words = F.filter(F.split(t, f"{SPACE}+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # inline() ends the expression: what follows refers to the arrays, not to their making
    rows = docs.select("*", F.inline(F.array(F.struct(F.transform(words, lambda w: F.xxhash64(w)).alias(w_), lines.alias(lines_)))))
    grams = F.when(
        F.size(w_) >= 5,
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w_) - 5, F.lit(0))),
            lambda i: F.xxhash64(*(F.get(F.col(w_), i + k) for k in range(5))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select("*", F.inline(F.array(F.struct(grams.alias(g_)))))
    # windows sorted by hash, then place; those equal to a neighbour are the repeated ones
    repeated = F.when(
        F.size(g_) > F.size(F.array_distinct(g_)),
        F.array_sort(F.transform(g_, lambda g, i: F.struct(g.alias("h"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    rows = rows.select("*", F.inline(F.array(F.struct(repeated.alias(s_)))))
    n = F.size(s_)
    places = F.array_sort(
        F.transform(
            F.filter(
                F.transform(
                    s_,
                    lambda s, i: F.struct(
                        s["i"].alias("i"),
                        (
                            ((i > 0) & (F.get(F.col(s_), F.greatest(i - 1, F.lit(0)))["h"] == s["h"]))
                            | ((i < n - 1) & (F.get(F.col(s_), i + 1)["h"] == s["h"]))
                        ).alias("r"),
                    ),
                ),
                lambda s: s["r"],
            ),
            lambda s: s["i"],
        )
    )
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + i + 5 - F.greatest(a["end"], i)).alias("n"), (i + 5).alias("end")),
        lambda a: a["n"],
    )

    def count(pattern: str) -> Column:
        return (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))).cast("long")

    return rows.select(
        *(F.col(c) for c in docs.columns),
        F.size(w_).cast("long").alias("n_words"),
        F.length(F.regexp_replace(t, f"{SPACE}+", "")).cast("long").alias("word_chars"),
        count(r"[#*$%&|<>]").alias("n_symbols"),
        (F.size(lines_) - F.size(F.array_distinct(lines_))).cast("long").alias("n_dup_lines"),
        F.when(F.size(s_) == 0, F.lit(0)).otherwise(covered).cast("long").alias("n_repeat_words"),
        count(r"[A-Z]+").alias("_n_upper"),
        count(r"[A-Za-z]+").alias("_n_letters"),
        F.size(lines_).cast("long").alias("_n_lines"),
        F.size(F.filter(lines_, lambda x: F.length(x) < 20)).cast("long").alias("_n_short_lines"),
        F.md5(t).alias("_text_hash"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def scores() -> dict[str, Column]:
    """Each score of a document with measures; 0 where its denominator is 0."""

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))

    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "upper_share": share("_n_upper", "_n_letters"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "_n_lines"),
        "mean_word_chars": share("word_chars", "n_words"),
        "short_line_share": share("_n_short_lines", "_n_lines"),
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed in logarithms from the largest term down."""
    if n == 0 or k >= n:
        return 1.0
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def labelled_scores(measured: DataFrame, labels: DataFrame, stratum: str, control: RiskControl) -> DataFrame:
    """stratum, tuned (whether the row is for tuning), quality and the scores of labelled texts.

    A text that several documents have is one row, as the binomial bound needs rows that are
    independent, and is for tuning or not as a whole. Documents that fail the base rules are left
    out: no cutoff decides about them. Of several labels of a document or text the lowest counts;
    null labels don't.
    """
    marks = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality IS NOT NULL")
    held = measured.where(~base_failed()).select("doc_id", F.col(stratum).cast("string").alias("stratum"), "_text_hash", *(c.alias(s) for s, c in scores().items()))
    texts = held.join(marks, "doc_id").groupBy("stratum", "_text_hash").agg(F.min("quality").alias("quality"), *(F.min(s).alias(s) for s in SCORES))
    part = F.conv(F.substring("_text_hash", 1, 8), 16, 10).cast("long") % control.tuning
    return texts.withColumn("tuned", part == 0).drop("_text_hash")


def tuning_counts(held: DataFrame, control: RiskControl) -> DataFrame:
    """One row per stratum: for each score and cutoff the good (k) and bad (b) rows rejected."""
    counts = [
        F.count_if((F.col(s) > c) & (F.col("quality") == q)).alias(f"{s}_{i}_{mark}")
        for s in SCORES
        for i, c in enumerate(control.cutoffs(s))
        for q, mark in ((1, "k"), (0, "b"))
    ]
    return held.where("tuned").groupBy("stratum").agg(*counts)


def rule_sequences(counts: list[dict], control: RiskControl) -> dict[str | None, list[tuple[str, float]]]:
    """Each stratum's rules (score, cutoff) in the order in which they are added."""
    found = {}
    for row in counts:
        rules = []
        for place, s in enumerate(SCORES):
            tried = [(row[f"{s}_{i}_b"] - control.good_cost * row[f"{s}_{i}_k"], -i) for i in range(control.grid_size)]
            gain, i = max(tried)
            if gain > 0:
                rules.append((row[f"{s}_{-i}_k"], -row[f"{s}_{-i}_b"], place, s, control.cutoffs(s)[-i]))
        if rules:
            found[row["stratum"]] = [(s, cutoff) for *_, s, cutoff in sorted(rules)]
    return found


def _stratum_key(column: Column) -> Column:
    """A string that isn't null, the null stratum's included."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def with_rules(rows: DataFrame, stratum: str, rules: dict[str | None, list[tuple[str, float]]], name: str) -> DataFrame:
    """rows with ``name``: a struct of each score's (cutoff, step) in the row's stratum."""
    key, here = unused(rows, "_rules_of", "_stratum")
    cells = ", ".join(f"{s}: struct<cutoff: double, step: int>" for s in SCORES)
    listed = []
    for value, steps in rules.items():
        at = {s: (cutoff, i) for i, (s, cutoff) in enumerate(steps, 1)}
        listed.append(("" if value is None else f"={value}", tuple(at.get(s) for s in SCORES)))
    small = rows.sparkSession.createDataFrame(listed, f"`{key}` string, `{name}` struct<{cells}>")
    if len(listed) <= MAX_BROADCAST_STRATA:
        small = F.broadcast(small)
    return rows.withColumn(here, _stratum_key(F.col(stratum))).join(small, F.col(here) == F.col(key), "left").drop(here, key)


def holdout_counts(held: DataFrame, rules: dict[str | None, list[tuple[str, float]]]) -> list[dict]:
    """Per stratum and step: the good holdout rows that are rejected first there; step null
    has those that no rule rejects."""
    rest = with_rules(held.where("NOT tuned AND quality = 1"), "stratum", rules, "_rules").where("_rules IS NOT NULL")
    step = F.least(*(F.when(F.col(s) > F.col(f"_rules.{s}.cutoff"), F.col(f"_rules.{s}.step")) for s in SCORES))
    return [r.asDict() for r in rest.groupBy("stratum", step.alias("step")).agg(F.count("*").alias("n")).collect()]


def proven_rules(sequences: dict[str | None, list[tuple[str, float]]], counts: list[dict], control: RiskControl) -> dict[str | None, list[tuple[str, float]]]:
    """The longest beginning of each stratum's sequence that is proven; strata without are absent."""
    found = {}
    for stratum, steps in sequences.items():
        own = {c["step"]: c["n"] for c in counts if c["stratum"] == stratum}
        n, lost, good = sum(own.values()), 0, []
        for i, rule in enumerate(steps, 1):
            lost += own.get(i, 0)
            if binomial_tail(lost, n, control.max_false_rejection) > control.level / len(sequences):
                break
            good.append(rule)
        if good:
            found[stratum] = good
    return found


def learn_rules(measured: DataFrame, labels: DataFrame, stratum: str, control: RiskControl) -> dict[str | None, list[tuple[str, float]]]:
    """The proven rules of each stratum. The labelled rows' scores, a few numbers each, are
    written to the shared folder; counts per labelled stratum reach the driver."""
    with scratch(measured.sparkSession):
        held = written(labelled_scores(measured, labels, stratum, control), "labelled")
        sequences = rule_sequences([r.asDict() for r in tuning_counts(held, control).collect()], control)
        return proven_rules(sequences, holdout_counts(held, sequences), control)


def apply_rules(measured: DataFrame, stratum: str, rules: dict[str | None, list[tuple[str, float]]]) -> DataFrame:
    """measured with base_failed, broken and kept."""
    (own,) = unused(measured, "_rules")
    ruled = with_rules(measured, stratum, rules, own)
    broken = F.array_compact(F.array(*(F.when(score > F.col(f"{own}.{s}.cutoff"), F.lit(s)) for s, score in scores().items())))
    marked = ruled.withColumn("base_failed", base_failed()).withColumn("broken", broken).drop(own)
    return marked.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", control: RiskControl | None = None) -> DataFrame:
    """docs with their measures, base_failed, the rules broken (``broken``) and ``kept``.

    Null and empty texts fail the base. A null stratum is a stratum of its own. Documents of a
    stratum without proven rules are kept if they pass the base; so are all of them when there
    are no labels. Equal rows are judged alike. An empty table gives an empty result. Columns
    named like those added are replaced, all others stay as they are. Texts of any length are
    measured whole; those of labelled rows twice, as texts aren't written for it.
    """
    control = control or RiskControl()
    docs = docs.drop("base_failed", "broken", "kept")
    known = labels.select("doc_id").distinct()
    if known.count() <= control.max_broadcast_labels:
        known = F.broadcast(known)
    labelled = with_measures(docs.select("doc_id", "text", stratum).join(known, "doc_id", "left_semi"))
    return apply_rules(with_measures(docs), stratum, learn_rules(labelled, labels, stratum, control))


def op9_risk_controlled_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with thresholds by language from the labels. Measures are written once."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = written(with_measures(docs).drop("text"), "measures")
    done = apply_rules(measured, "lang", learn_rules(measured, table(spark, sf_dir, "labels"), "lang", RiskControl()))
    return done.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.array_join("broken", ",").alias("broken"))


def _sql(control: RiskControl | None = None) -> str:
    """The same by DuckDB: the binomial tails are summed in logarithms there as well."""
    control = control or RiskControl()
    p = control.max_false_rejection
    grid = ", ".join(f"('{s}', {i}, CAST('{c!r}' AS DOUBLE))" for s in SCORES for i, c in enumerate(control.cutoffs(s)))
    parts = {
        "symbol_share": ("n_symbols", "word_chars"),
        "upper_share": ("n_upper", "n_letters"),
        "repeat_share": ("n_repeat_words", "n_words"),
        "dup_line_share": ("n_dup_lines", "n_lines"),
        "mean_word_chars": ("word_chars", "n_words"),
        "short_line_share": ("n_short_lines", "n_lines"),
    }
    scored = " UNION ALL ".join(
        f"SELECT doc_id, lang, n, base_failed, '{s}' AS score, {i} AS place, CASE WHEN {b} = 0 THEN 0 ELSE CAST({a} AS DOUBLE) / {b} END AS x FROM m" for i, (s, (a, b)) in enumerate(parts.items())
    )
    return rf"""
WITH w AS (SELECT doc_id, lang, row_number() OVER () AS n, coalesce(text, '') AS t,
   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
   [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l FROM documents),
g AS (SELECT n, i, w[i:i+4] AS gram FROM (SELECT n, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
r AS (SELECT n, count(DISTINCT place) AS n_repeat_words FROM
   (SELECT n, unnest(range(i, i + 5)) AS place FROM (SELECT n, i, count(*) OVER (PARTITION BY n, gram) AS k FROM g) WHERE k > 1) GROUP BY n),
c AS (SELECT doc_id, lang, n, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
   length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
   coalesce(n_repeat_words, 0) AS n_repeat_words, length(t) - length(regexp_replace(t, '[A-Z]+', '', 'g')) AS n_upper,
   length(t) - length(regexp_replace(t, '[A-Za-z]+', '', 'g')) AS n_letters, len(l) AS n_lines, len([x for x in l if length(x) < 20]) AS n_short_lines,
   md5(t) AS hash FROM w LEFT JOIN r USING (n)),
m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c),
s AS ({scored}),
q AS (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY doc_id HAVING min(quality) IS NOT NULL),
u AS (SELECT hash, min(quality) AS quality, min(n) AS n FROM m JOIN q USING (doc_id) WHERE NOT base_failed GROUP BY lang, hash),
h AS (SELECT lang, s.n, score, place, x, quality, CAST('0x' || substr(hash, 1, 8) AS BIGINT) % {control.tuning} = 0 AS tuned FROM s JOIN u ON s.n = u.n),
grid(score, i, cutoff) AS (VALUES {grid}),
k AS (SELECT lang, score, place, i, cutoff, count(*) FILTER (quality = 1 AND x > cutoff) AS lost, count(*) FILTER (quality = 0 AND x > cutoff) AS caught
   FROM h JOIN grid USING (score) WHERE tuned GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, score ORDER BY caught - {control.good_cost!r} * lost DESC, i) AS best FROM k),
rules AS (SELECT lang, score, cutoff, row_number() OVER (PARTITION BY lang ORDER BY lost, caught DESC, place) AS step
   FROM b WHERE best = 1 AND caught - {control.good_cost!r} * lost > 0),
f AS (SELECT h.lang, h.n, min(step) FILTER (x > cutoff) AS first FROM h JOIN rules ON h.score = rules.score AND h.lang IS NOT DISTINCT FROM rules.lang
   WHERE NOT tuned AND quality = 1 GROUP BY h.lang, h.n),
c2 AS (SELECT rules.lang, rules.score, rules.cutoff, step, count(f.n) AS n, count(f.n) FILTER (first <= step) AS lost
   FROM rules LEFT JOIN f ON f.lang IS NOT DISTINCT FROM rules.lang GROUP BY ALL),
t AS (SELECT *, CASE WHEN n = 0 OR lost >= n THEN 1 ELSE list_sum([exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
   + j * ln({p!r}) + (n - j) * ln(1 - {p!r})) for j in range(0, lost + 1)]) END
   > {control.level!r} / (SELECT count(DISTINCT coalesce('=' || lang, '')) FROM rules) AS failed FROM c2),
proven AS (SELECT *, bool_or(failed) OVER (PARTITION BY lang ORDER BY step) AS stopped FROM t),
o AS (SELECT s.n, string_agg(s.score, ',' ORDER BY place) AS broken FROM s JOIN proven ON s.score = proven.score
   AND s.lang IS NOT DISTINCT FROM proven.lang WHERE NOT stopped AND x > cutoff GROUP BY s.n)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
   NOT base_failed AND broken IS NULL AS kept, coalesce(broken, '') AS broken FROM m LEFT JOIN o USING (n)"""


OP9_SQL = _sql()
