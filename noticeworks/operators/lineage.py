"""The record lineage from records to duplicate groups: blocks, links by cosine, counters.

Two records are candidates if they are of one block (buyer and code division), of different
sources and at most ``window`` days apart. Titles of records that are in any candidate pair are
weighed by TF-IDF within their block, and candidates link at a cosine of ``threshold``. Pairs
aren't made to be counted or thrown away: which records are involved, and how many pairs there
are, follows from counts by block, day and source; and only pairs with a token in common among
the rarest of both are compared. A record's rarest tokens are those before which the rest of its
vector is shorter than the threshold: what two records have in common there alone can't reach it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticeworks.functions import codes, money, text
from noticeworks.operators import legacy, records
from noticeworks.session import cut

#: Between source and id in a record's key: it sorts before all that either may hold.
_APART = "\x01"
#: What rounding may take from a bound.
_SLACK = 1e-6


def record_key() -> Column:
    """A record's key, which sorts by source, then id."""
    return F.concat(F.coalesce("source", F.lit("")), F.lit(_APART), F.coalesce("tender_id", F.lit("")))


def linkable(rows: DataFrame) -> DataFrame:
    """From records (source, tender_id, title, buyer, cpv_main, published_date): key, source,
    tender_id, block, day, title (folded) and size (the length of the title as it was)."""
    division = F.coalesce(F.nullif(F.substring("cpv_main", 1, 2), F.lit("")), F.lit("xx"))
    folded = rows.select("*", text.fold(F.coalesce("buyer", F.lit(""))).alias("_buyer"), text.fold(F.coalesce("title", F.lit(""))).alias("_title"))
    block = F.concat_ws("|", text.block_key(F.col("_buyer")), division)
    return folded.select(record_key().alias("key"), "source", "tender_id", block.alias("block"), F.col("published_date").alias("day"), F.col("_title").alias("title"), F.length(F.coalesce("title", F.lit(""))).alias("size"))


def _near(window: int, *by: str) -> W:
    return W.partitionBy(*by).orderBy("at").rangeBetween(-window, window)


def involved(rows: DataFrame, window: int) -> DataFrame:
    """The dated rows in any candidate pair. Days are compared by the least and greatest source of
    each block and day, so that a block of very many records is as many rows as it has days."""
    dated = rows.where("day IS NOT NULL").withColumn("at", F.unix_date("day"))
    days = dated.groupBy("block", "at").agg(F.min("source").alias("low"), F.max("source").alias("high"))
    near = days.select("block", "at", F.min("low").over(_near(window, "block")).alias("low"), F.max("high").over(_near(window, "block")).alias("high")).where("low <> high")
    # where three sources or more are near, any record has another one; with two, both have
    near = near.select(F.concat("block", F.lit("")).alias("block"), "at")
    return dated.join(near, ["block", "at"], "left_semi")


def pair_count(rows: DataFrame, window: int) -> DataFrame:
    """One row, ``pairs``: how many candidate pairs there are, from counts by block, day and source."""
    each = rows.where("day IS NOT NULL").groupBy("block", F.unix_date("day").alias("at"), "source").agg(F.count("*").alias("n"))
    own = each.withColumn("_own", F.sum("n").over(_near(window, "block", "source")))
    days = each.groupBy("block", "at").agg(F.sum("n").alias("n")).select("block", "at", F.sum("n").over(_near(window, "block")).alias("_all"))
    both = own.join(days, ["block", "at"])
    return both.agg((F.coalesce(F.sum(F.col("n") * (F.col("_all") - F.col("_own"))), F.lit(0)) / 2).cast("long").alias("pairs"))


def vectors(some: DataFrame, threshold: float) -> DataFrame:
    """From records with each key once: key, block, source, at, ``vector`` (array of token and w, as
    of ``legacy.tfidf``) and ``rare``: its rarest tokens, up to which the rest of the vector reaches
    the threshold, of those that another record of the block has too.

    Tokens are shuffled to be counted by block, to meet their counts and to go back to their
    record; what follows is done within its row.
    """
    words = some.select("block", "key", text.tokens(F.col("title")).alias("_t"))
    times = lambda t: F.size("_t") - F.size(F.array_remove("_t", t))
    each = words.select("block", "key", F.inline(F.transform(F.array_distinct("_t"), lambda t: F.struct(t.alias("token"), times(t).alias("tf")))))
    df = each.groupBy("block", "token").agg(F.count("*").alias("df"))
    met = each.join(df, ["block", "token"]).groupBy("key").agg(F.collect_list(F.struct("df", "token", "tf")).alias("_v"))
    n = some.groupBy("block").agg(F.count("*").alias("n"))
    rows = met.join(some.select("key", "block", "source", "at").join(n, "block"), "key")
    weight = lambda x: (1 + x["tf"]) * F.log((1 + F.col("n")) / (1 + x["df"])) + 1
    often_first = F.reverse(F.array_sort("_v"))  # by df, then token
    rows = rows.select("key", "block", "source", "at", F.transform(often_first, lambda x: F.struct(x["token"].alias("token"), x["df"].alias("df"), weight(x).alias("w"))).alias("_v"))
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x["w"] * x["w"])
    rows = rows.withColumn("_norm", F.sqrt(total(F.col("_v"))))
    rows = rows.withColumn("_v", F.transform("_v", lambda x: F.struct(x["token"].alias("token"), x["df"].alias("df"), (x["w"] / F.col("_norm")).alias("w"))))

    def longer(state: Column, x: Column) -> Column:
        rest = state["rest"] + x["w"] * x["w"]
        here = (F.sqrt(rest) >= threshold - _SLACK) & (x["df"] > 1)
        return F.struct(rest.alias("rest"), F.when(here, F.concat(state["rare"], F.array(x["token"]))).otherwise(state["rare"]).alias("rare"))

    none = F.struct(F.lit(0.0).alias("rest"), F.array().cast("array<string>").alias("rare"))
    vector = F.transform("_v", lambda x: F.struct(x["token"].alias("token"), x["w"].alias("w")))
    return rows.select("key", "block", "source", "at", vector.alias("vector"), F.aggregate("_v", none, longer)["rare"].alias("rare"))


def similar_pairs(rows: DataFrame, window: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The candidate pairs (block, a, b, similarity) of at least the threshold, which is above 0,
    and the pairs that were compared to find them.

    ``rows``: key, source, block, day, title (folded), each key once.
    """
    if not threshold > 0:
        raise ValueError("a threshold above 0 is needed: titles without a token in common aren't compared")
    some = involved(rows, window).select("key", "block", "source", "at", "title")
    # records without a rare token that another has meet none
    weighed = cut(vectors(cut(some), threshold).where(F.size("rare") > 0))
    # a record meets those of its own bucket of days and of the next one
    placed = weighed.select("block", "key", "source", "at", F.floor(F.col("at") / max(window, 1)).alias("bucket"), F.explode("rare").alias("token"))
    a = placed.select("block", "token", F.col("key").alias("a"), F.col("source").alias("sa"), F.col("at").alias("at_a"), F.explode(F.array("bucket", F.col("bucket") + 1)).alias("bucket"))
    b = placed.select("block", "token", F.col("key").alias("b"), F.col("source").alias("sb"), F.col("at").alias("at_b"), "bucket")
    met = a.join(b, ["block", "token", "bucket"]).where((F.col("sa") != F.col("sb")) & (F.abs(F.col("at_a") - F.col("at_b")) <= window))
    pairs = cut(met.select("block", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    of = lambda k: weighed.select(F.col("key").alias(k), F.col("vector").alias(f"v{k}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    cosine = money.let(F.map_from_entries("vb"), lambda m: F.aggregate("va", F.lit(0.0), lambda s, x: s + x["w"] * F.coalesce(m[x["token"]], F.lit(0.0))))
    found = both.select("block", "a", "b", F.round(cosine, 12).alias("similarity"))
    return found.where(F.col("similarity") >= threshold), pairs


def duplicate_groups(rows: DataFrame, window: int = 7, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """Assignments of the records in groups, and one row of counters.

    ``rows`` as of ``linkable``. Assignments: key, group_no (from 1, by the least member), key
    and id of the canonical record: the earliest, then that of the longest title, least id,
    least source. Counters: candidate_pairs; evaluated_pairs, both of whose titles have tokens;
    compared_pairs, of which a cosine was computed; linked_pairs; linked_groups;
    duplicated_records; records_without_date.
    """
    rows = cut(rows)
    found, compared = similar_pairs(rows, window, threshold)
    links = cut(found)
    groups = cut(legacy.numbered_groups(legacy.link_groups(links)))
    members = groups.join(rows.select(F.col("key").alias("node"), "source", "tender_id", "day", "size"), "node")
    order = F.struct(F.col("day").isNull().alias("undated"), "day", (-F.col("size")).alias("size"), "tender_id", "source", "node")
    best = members.groupBy("root").agg(F.min(order).alias("best")).select(F.concat("root", F.lit("")).alias("root"), F.col("best.node").alias("canonical"), F.col("best.tender_id").alias("canonical_id"))
    assigned = members.join(best, "root").select(F.col("node").alias("key"), "group_no", "canonical", "canonical_id")
    titled = rows.where(F.size(text.tokens(F.col("title"))) > 0)
    grouped = groups.agg(F.count_distinct("root").alias("linked_groups"), F.count("*").alias("_n"))
    counted = [
        pair_count(rows, window).select(F.col("pairs").alias("candidate_pairs")),
        pair_count(titled, window).select(F.col("pairs").alias("evaluated_pairs")),
        compared.agg(F.count("*").alias("compared_pairs")),
        links.agg(F.count("*").alias("linked_pairs")),
        grouped.select("linked_groups", (F.col("_n") - F.col("linked_groups")).alias("duplicated_records")),
        rows.agg(F.count_if(F.col("day").isNull()).alias("records_without_date")),
    ]
    stats = counted[0]
    for one in counted[1:]:
        stats = stats.join(F.broadcast(one))  # a single row each
    return assigned, stats


def assigned_opportunities(scored: DataFrame, assignments: DataFrame) -> DataFrame:
    """``records.opportunity_rows`` with what ``duplicate_groups`` found: dup_group, is_canonical
    and duplicate_of, the id of the canonical record of another."""
    rows = scored.withColumnRenamed("score", "technology_score").withColumn("_key", record_key())
    own = assignments.select(F.col("key").alias("_key"), "group_no", "canonical", "canonical_id")
    first = F.col("canonical").isNull() | (F.col("_key") == F.col("canonical"))
    joined = rows.join(own, "_key", "left").withColumn("is_canonical", first)
    other = F.when(~F.col("is_canonical"), F.col("canonical_id"))
    return joined.select(*(c for c in rows.columns if c != "_key"), F.col("group_no").alias("dup_group"), "is_canonical", other.alias("duplicate_of"))


def code_evaluation(scored: DataFrame) -> DataFrame:
    """The keyword verdict held against the category that a code's prefix names, a row per category:
    category, precision, recall, f1, support, and of all: evaluated_records, total_records,
    coverage, macro_f1, all shares to four places.

    Records that their code decided are left out, and so are those whose code names no category.
    Other is no prediction. The mean of f1 weighs every category alike. One pass over the
    records makes the table of categories by verdicts, and the rest is made of its few rows.
    """
    gold = F.when(F.col("category_source") != "cpv", codes.longest_prefix(F.col("cpv_main"), records.PREFIXES))
    table = scored.groupBy(gold.alias("gold"), F.when(gold.isNotNull(), F.col("category")).alias("said")).agg(F.count("*").alias("n"))
    hit = F.col("gold") == F.col("said")
    zero, n = F.lit(0).cast("long"), F.col("n")
    of = lambda label, tp, fp, fn: F.struct(label.alias("label"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    of_gold = of(F.col("gold"), F.when(hit, n).otherwise(zero), zero, F.when(hit, zero).otherwise(n))
    cells = table.where("gold IS NOT NULL").select(F.inline(F.array(of_gold, of(F.when(~hit, F.col("said")), zero, n, zero))))
    names = F.array(*(F.lit(name) for name, _ in records.CATEGORIES))
    every = scored.sparkSession.range(1).select(F.explode(names).alias("label")).select("label", *(zero.alias(c) for c in ("tp", "fp", "fn")))
    counts = cells.where(F.array_contains(names, F.col("label"))).unionByName(every).groupBy("label").agg(*(F.sum(c).alias(c) for c in ("tp", "fp", "fn")))
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    marks = counts.select("label", p.alias("p"), r.alias("r"), (F.col("tp") + F.col("fn")).alias("support"))
    marks = marks.withColumn("f", ratio(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")))
    total = table.agg(F.coalesce(F.sum(F.when(F.col("gold").isNotNull(), n)), zero).alias("evaluated_records"), F.coalesce(F.sum("n"), zero).alias("total_records"))
    mean = marks.agg(F.avg("f").alias("_mean"))
    four = lambda c: F.bround(c, 4)
    joined = marks.join(F.broadcast(total.join(F.broadcast(mean))))  # a single row each
    return joined.select(
        F.col("label").alias("category"), four("p").alias("precision"), four("r").alias("recall"), four("f").alias("f1"), "support", "evaluated_records", "total_records",
        money.share(F.col("evaluated_records"), F.col("total_records")).alias("coverage"), four("_mean").alias("macro_f1"),
    )
