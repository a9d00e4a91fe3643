"""The record lineage: classification, linkage, quality, evaluation, marts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticeworks.functions.codes import longest_prefix
from noticeworks.functions.money import share
from noticeworks.functions.text import fold_word, has_word, tokens
from noticeworks.functions.timex import month_label
from noticeworks.operators.events import _once
from noticeworks.session import cut

OTHER = "Other"


def keyword_hits(folded: Column, keywords: list[str]) -> Column:
    """Sorted distinct folded keywords that the folded text has as whole words.

    The text is cut into words once, which keywords of one word are looked up among; those of
    several are searched for one by one only where an alternation of them all is found.
    """
    words = sorted({fold_word(k) for k in keywords})
    single = [w for w in words if re.fullmatch(r"\w+", w)]
    phrases = [w for w in words if w not in single]
    none = F.array().cast("array<string>")
    found = F.array_intersect(F.array(*map(F.lit, single)), F.regexp_extract_all(folded, F.lit(r"(?U)(\w+)"), F.lit(1))) if single else none
    if phrases:
        any_of = folded.rlike("|".join(map(re.escape, phrases)))
        found = F.concat(found, F.when(any_of, F.array_compact(F.array(*(F.when(has_word(folded, w), F.lit(w)) for w in phrases)))).otherwise(none))
    return F.array_sort(found)


def classified(rows: DataFrame, folded: str, categories: list[tuple[str, list[str]]], prefixes: list[tuple[str, str]] = (), code: str | None = None) -> DataFrame:
    """rows with matched_keywords, category, category_source and score.

    The first category in configured order with a keyword wins, else the longest code prefix,
    else Other. The score is the number of distinct keywords.
    """
    every = keyword_hits(F.coalesce(F.col(folded), F.lit("")), [k for _, words in categories for k in words])
    # the keywords found, once a row: what follows refers to them
    found = _once(rows, matched_keywords=every)
    mine = lambda words: F.arrays_overlap("matched_keywords", F.array(*(F.lit(fold_word(w)) for w in words)))
    by_word = F.when(F.size("matched_keywords") > 0, F.coalesce(*(F.when(mine(words), F.lit(name)) for name, words in categories)))
    by_code = longest_prefix(F.col(code), list(prefixes)) if code else F.lit(None).cast("string")
    verdict = F.struct(by_word.alias("word"), F.when(by_word.isNull(), by_code).alias("code"))
    judged = _once(found, _verdict=verdict)
    word, by = F.col("_verdict.word"), F.col("_verdict.code")
    return (
        judged.withColumn("category", F.coalesce(word, by, F.lit(OTHER)))
        .withColumn("category_source", F.when(word.isNotNull(), "keywords").when(by.isNotNull(), "cpv").otherwise("none"))
        .withColumn("score", F.size("matched_keywords"))
        .drop("_verdict")
    )


def evaluation(rows: DataFrame, gold: str, predicted: str, labels: list[str]) -> DataFrame:
    """Precision, recall and F1 of each label, those without support too; Other is no prediction."""
    every = rows.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    pairs = rows.groupBy(F.col(gold).alias("gold"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))
    cells = every.join(pairs, (F.col("label") == F.col("gold")) | (F.col("label") == F.col("predicted")), "left")
    hit = (F.col("label") == F.col("gold")) & (F.col("label") == F.col("predicted"))
    counts = cells.groupBy("label").agg(
        F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when((F.col("label") == F.col("predicted")) & ~F.coalesce(hit, F.lit(False)), F.col("n"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when((F.col("label") == F.col("gold")) & ~F.coalesce(hit, F.lit(False)), F.col("n"))), F.lit(0)).alias("fn"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.withColumn("support", F.col("tp") + F.col("fn")).withColumn("precision", p).withColumn("recall", r).withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def broken_rules(rules: dict[str, Column]) -> Column:
    """The names of the rules that a record breaks."""
    return F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in rules.items())))


def quality_issues(rows: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """A row for each record and rule that it breaks."""
    return rows.select(F.col(key).alias("record"), F.explode(broken_rules(rules)).alias("rule"))


def quality_gates(metrics: DataFrame, gates: list[tuple[str, str, float]]) -> DataFrame:
    """A row for each gate (metric, <= or >=, threshold) over a frame of one row."""
    each = [
        F.struct(
            F.lit(name).alias("metric"), F.col(name).cast("double").alias("value"), F.lit(op).alias("operator"), F.lit(float(limit)).alias("threshold"),
            (F.col(name) <= limit if op == "<=" else F.col(name) >= limit).alias("passed"),
        )
        for name, op, limit in gates
    ]
    return metrics.select(F.inline(F.array(*each)))


def shares(rows: DataFrame, **conditions: Column) -> DataFrame:
    """One row: the share of rows of each condition, to four places."""
    return rows.agg(*(share(F.count_if(c), F.count("*")).alias(name) for name, c in conditions.items()))


def mart_order(mart: DataFrame, *columns: str) -> DataFrame:
    """A mart in the order in which it is written; names after a minus descend."""
    return mart.orderBy(*(F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in columns))


#: Fixed: the orders of the marts of technology_summary and buyer_category.
TECHNOLOGY_ORDER, BUYER_ORDER = ("category", "month"), ("-records", "buyer", "category")


def technology_summary(rows: DataFrame, category: str, day: str, score: str) -> DataFrame:
    return rows.groupBy(F.col(category).alias("category"), month_label(F.col(day)).alias("month")).agg(F.count("*").alias("records"), F.sum(score).cast("long").alias("score"))


def buyer_category(rows: DataFrame, buyer: str, category: str) -> DataFrame:
    name = F.coalesce(F.nullif(F.col(buyer), F.lit("")), F.lit("(unknown)"))
    return rows.groupBy(name.alias("buyer"), F.col(category).alias("category")).agg(F.count("*").alias("records"))


def linkage_candidates(rows: DataFrame, block: str, key: str, source: str, day: str, window: int) -> DataFrame:
    """Pairs (a, b) of dated records of one block and different sources at most so many days apart.

    A block is cut into day buckets of the window's length; a record meets its own bucket and
    the next one, so a large block is many small joins.
    """
    dated = rows.where(F.col(day).isNotNull()).select(F.col(block).alias("block"), F.col(key).alias("k"), F.col(source).alias("s"), F.col(day).alias("d"))
    dated = dated.withColumn("at", F.floor(F.unix_date("d") / max(window, 1)))
    left = dated.select("block", F.col("k").alias("a"), F.col("s").alias("sa"), F.col("d").alias("da"), F.explode(F.array("at", F.col("at") + 1)).alias("at"))
    right = dated.select("block", F.col("k").alias("b"), F.col("s").alias("sb"), F.col("d").alias("db"), "at")
    near = (F.col("sa") != F.col("sb")) & (F.abs(F.datediff("da", "db")) <= window)
    found = left.join(right, ["block", "at"]).where(near)
    return found.select("block", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def tfidf(docs: DataFrame, block: str, key: str, text: str) -> DataFrame:
    """Weights of each record's tokens within its block, of unit length: block, key, token, w."""
    each = docs.select(F.col(block).alias("block"), F.col(key).alias("key"), F.explode(tokens(F.col(text))).alias("token"))
    tf = each.groupBy("block", "key", "token").agg(F.count("*").alias("tf"))
    df = tf.groupBy("block", "token").agg(F.count("*").alias("df"))
    n = docs.groupBy(F.col(block).alias("block")).agg(F.count("*").alias("n"))
    weight = (1 + F.col("tf")) * F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1
    weighted = tf.join(df, ["block", "token"]).join(n, "block").withColumn("w", weight)
    norm = weighted.groupBy("block", "key").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return weighted.join(norm, ["block", "key"]).select("block", "key", "token", (F.col("w") / F.col("norm")).alias("w"))


def similarities(pairs: DataFrame, weights: DataFrame) -> DataFrame:
    """Cosine of each pair with a token in common: block, a, b, similarity, to twelve places."""
    a = weights.select("block", F.col("key").alias("a"), "token", F.col("w").alias("wa"))
    b = weights.select("block", F.col("key").alias("b"), "token", F.col("w").alias("wb"))
    return pairs.join(a, ["block", "a"]).join(b, ["block", "b", "token"]).groupBy("block", "a", "b").agg(F.round(F.sum(F.col("wa") * F.col("wb")), 12).alias("similarity"))


def link_groups(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root (smallest reachable) of each linked record, by propagating least labels.

    Each round takes the least label of the neighbours and then that label's own label, so
    chains shorten by half; labels only fall, so the loop ends, when none changes. Null ends
    are no links; repeated links count once.
    """
    links = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    both = cut(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("root")))
    while True:
        seen = both.join(labels.select(F.col("u").alias("v"), F.col("root").alias("near")), "v").groupBy("u").agg(F.min("near").alias("near"))
        step = labels.join(seen, "u").select("u", F.least("root", "near").alias("root"), F.col("root").alias("old"))
        # the root's own label is at least as small
        jump = step.join(labels.select(F.col("u").alias("root"), F.col("root").alias("far")), "root", "left").select("u", F.least("root", "far").alias("root"), "old")
        jump = cut(jump)
        labels = jump.select("u", "root")
        if jump.where("root <> old").isEmpty():
            return labels.select(F.col("u").alias("node"), "root")


def numbered_groups(groups: DataFrame, root: str = "root") -> DataFrame:
    """Groups numbered from 1 by their smallest member.

    Roots are sorted by ranges; each range is ranked for itself and starts after the ones
    before it, of which only a count each is broadcast.
    """
    roots = groups.select(root).distinct().repartitionByRange(root).withColumn("_range", F.spark_partition_id())
    roots = cut(roots)  # ranges are drawn from a sample; one draw serves both uses
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    starts = roots.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = W.partitionBy("_range").orderBy(root)
    ranked = roots.withColumn("_rank", F.row_number().over(within)).join(F.broadcast(starts), "_range")
    return groups.join(ranked.select(root, (F.col("_start") + F.col("_rank")).cast("int").alias("group_no")), root)


def canonical(groups: DataFrame, day: str, title: str, key: str, source: str) -> DataFrame:
    """The canonical record of each group: earliest (undated ones last), then the longest title,
    then the least key, then the least source."""
    order = F.struct(F.col(day).isNull().alias("_n"), F.col(day), (-F.length(F.coalesce(title, F.lit("")))).alias("_l"), F.col(key), F.col(source))
    return groups.groupBy("root").agg(F.min(order).getField(key).alias("canonical"))
