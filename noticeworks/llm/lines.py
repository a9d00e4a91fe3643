"""Line dedup by winnowing over line hashes.

A run of consecutive lines with at least ``min_words`` words in all is deleted where an equal
run came earlier in the corpus, by (doc_id, place). Windows are as many lines, from each line
on, as reach that number of words; each selects its smallest line hash, at its place, as its
fingerprint. A repeated run holds a whole window, and equal windows select equal lines, so a
run can only repeat where the same fingerprint stands at two places or more; windows around
others are dropped. The places of a shared fingerprint are joined, each later one with the
first that has the same window around it, and the matches are extended both ways: windows
reach forward from and back to each line, and matches side by side or overlapping are merged.
Every line of a repeated run lies in one of its windows forward or back, so what is merged is
all of the run, to its full length.

Places are joined only if the windows agree in 122 bits: the fingerprint, a hash of the line
hashes in order and a sum of second line hashes with another seed.

Lines without words separate nothing and go with the run around them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticeworks.llm.common import MAX_BROADCAST_KEYS, SPACE, empty_if_null, fresh, row_key, scratch, table, unused, written


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, _key and _whole (the text) of one of all rows that are equal in document and text.

    Keys are counted first, without texts. Texts of keys that stand once aren't shuffled, as
    long as the others are few enough to broadcast; those of the others are combined before.
    """
    keyed = docs.select(F.col(doc_id).alias("doc"), row_key(doc_id, text).alias("_key"), empty_if_null(text).alias("_whole"))
    many = written(keyed.groupBy("_key").agg(F.count("*").alias("n")).where("n > 1").select("_key"), "repeated")
    if many.count() <= MAX_BROADCAST_KEYS:
        many = F.broadcast(many)
    again = keyed.join(many, "_key", "left_semi").groupBy("_key").agg(F.min("doc").alias("doc"), F.min("_whole").alias("_whole"))
    return keyed.join(many, "_key", "left_anti").select("doc", "_key", "_whole").unionByName(again)


def split_lines(keyed: DataFrame) -> DataFrame:
    """Lines with words: doc (null doc_ids last), _key, line (from 0), words, hash and other (a
    hash with another seed, of 58 bits, of which as many as a window has lines can be summed)."""
    lines = keyed.select("doc", "_key", F.posexplode(F.split("_whole", "\n")).alias("line", "_text"))
    words = F.size(F.filter(F.split("_text", f"{SPACE}+"), lambda w: w != ""))
    return lines.select("doc", "_key", "line", words.cast("long").alias("words"), F.xxhash64("_text").alias("hash"), F.shiftright(F.xxhash64(F.lit(7), "_text"), 6).alias("other")).where("words > 0")


def windows(lines: DataFrame, min_words: int) -> DataFrame:
    """For every line the window forward and the one back, where the text is long enough.

    Result: doc, _key, and for each of ``forward`` and ``back`` a struct of first and last
    line, run and other (hashes of the window), and mark and at: its fingerprint, the smallest
    line hash, and the place. A key's lines stand once.
    """
    by_line = W.partitionBy("_key").orderBy("line")
    # words before each line; its last word's number is words before the next, less one
    placed = lines.withColumn("_end", F.sum("words").over(by_line.rowsBetween(W.unboundedPreceding, 0))).withColumn("_start", F.col("_end") - F.col("words"))
    ahead = W.partitionBy("_key").orderBy("_start").rangeBetween(0, min_words - 1)
    behind = W.partitionBy("_key").orderBy("_end").rangeBetween(-(min_words - 1), 0)

    def window(over, edge: str) -> Column:
        least = F.min(F.struct("hash", "line")).over(over)
        long_enough = (F.max("_end").over(over) - F.min("_start").over(over)) >= min_words
        held = F.struct(
            F.min("line").over(over).alias("first"), F.max("line").over(over).alias("last"), F.xxhash64(F.collect_list("hash").over(over)).alias("run"), F.sum("other").over(over).alias("other"),
            least["hash"].alias("mark"), least["line"].alias("at"),
        )
        return F.when(long_enough, held).alias(edge)

    return placed.select("doc", "_key", window(ahead, "forward"), window(behind, "back"))


def repeated_runs(docs: DataFrame, min_words: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The runs to delete: _key and ``runs``, an array of (first, last) lines, merged.

    Documents without any are absent. Fingerprints are counted by place before they are
    shuffled, and places joined back by joins that adaptive execution can split, so that a run
    in a third of all documents is one row of the counts. Only hashes and places are shuffled,
    never texts. The windows are written to the shared folder, so that texts are split once.
    """
    with scratch(docs.sparkSession):
        wins = written(windows(split_lines(one_of_each(docs, doc_id, text)), min_words), "windows")
        # a repeated run holds a window forward, whose fingerprint has two places; its windows back
        # have theirs among the same lines
        marks = wins.select("_key", F.inline(F.array_compact(F.array("forward", "back")))).select("_key", F.hex("mark").alias("mark"), "at")
        shared = marks.groupBy("mark").agg(F.min(F.struct("_key", "at")).alias("a"), F.max(F.struct("_key", "at")).alias("b")).where("a <> b").select(fresh(F.col("mark")).alias("mark"))
        order = F.struct(F.col("doc").isNull().alias("none"), "doc", "_key")
        placed = wins.select(order.alias("of"), F.inline(F.array_compact(F.array("forward", "back")))).select("of", "first", "last", "at", F.hex("mark").alias("mark"), F.hex("run").alias("run"), "other")
        # a window forward and one back over the same lines are one place
        seen = placed.join(shared, "mark", "left_semi")
        place = F.struct("of", "first")
        firsts = seen.groupBy("mark", "run", "other").agg(F.min(place).alias("origin"), F.max(place).alias("latest")).where("origin < latest")
        firsts = firsts.select(fresh(F.col("mark")).alias("mark"), fresh(F.col("run")).alias("run"), "other", "origin")
        again = seen.join(firsts, ["mark", "run", "other"]).where(place > F.col("origin")).select(F.col("of._key").alias("_key"), "first", "last")
        by_place = W.partitionBy("_key").orderBy("first", "last")
        covered = F.max("last").over(by_place.rowsBetween(W.unboundedPreceding, -1))
        starts = again.withColumn("_new", F.when(covered.isNull() | (F.col("first") > covered + 1), 1).otherwise(0))
        islands = starts.withColumn("_island", F.sum("_new").over(by_place.rowsBetween(W.unboundedPreceding, 0)))
        merged = islands.groupBy("_key", "_island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        runs = merged.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))
        return written(runs, "runs", kept=True)


def without_runs(text: Column, runs: Column) -> Column:
    """The text without the lines of its runs."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.exists(runs, lambda r: i.between(r["first"], r["last"]))), "\n")


def dedup_lines(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """docs with later repeats of runs of lines deleted; n_chars follows the text.

    The first occurrence stays, also within a document. Rows equal in doc_id and text are one
    document and come out alike; a null doc_id comes after all others. Null and empty texts
    stay as they are; a text that repeats as a whole becomes empty. A run holds at least
    ``min_words`` words, so a text has at most its words over ``min_words`` runs. An empty table
    gives an empty result; columns of any name come back as they were.
    """
    key, gone, new = unused(docs, "_key", "_runs", "_new")
    runs = repeated_runs(docs, min_words).select(F.col("_key").alias(key), F.col("runs").alias(gone))
    joined = docs.withColumn(key, row_key()).join(runs.hint("merge"), key, "left")  # runs grow with the corpus
    cut = joined.withColumn(new, F.when(F.col(gone).isNull(), F.col("text")).otherwise(without_runs(F.col("text"), F.col(gone))))
    changed = {"text": F.col(new), "n_chars": F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.length(new).cast("long"))}
    return cut.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns))


def op3_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: which lines go and a digest of what stays."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    runs = repeated_runs(docs)
    joined = docs.withColumn("_key", row_key()).join(runs.hint("merge"), "_key", "left")
    gone = F.coalesce(F.col("runs"), F.array().cast("array<struct<first:int,last:int>>"))
    lines = F.split(empty_if_null(), "\n")
    return joined.select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.aggregate(gone, F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1).cast("long").alias("n_removed"),
        F.array_join(F.transform(gone, lambda r: F.concat_ws("-", r["first"].cast("string"), r["last"].cast("string"))), ",").alias("removed"),
        F.sha2(without_runs(empty_if_null(), gone), 256).alias("kept_sha256"),
    )


OP3_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS t,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line FROM documents),
w AS (SELECT doc_id, line, t, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words FROM l),
p AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY line) AS e FROM w WHERE words > 0),
q AS (SELECT *, e - words AS s FROM p),
b AS (SELECT doc_id, min(line) OVER f AS first, max(line) OVER f AS last, list(t) OVER f AS run, max(e) OVER f - min(s) OVER f AS n
      FROM q WINDOW f AS (PARTITION BY doc_id ORDER BY s RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING)
      UNION ALL
      SELECT doc_id, min(line) OVER f, max(line) OVER f, list(t) OVER f, max(e) OVER f - min(s) OVER f
      FROM q WINDOW f AS (PARTITION BY doc_id ORDER BY e RANGE BETWEEN 49 PRECEDING AND CURRENT ROW)),
r AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, first) AS i, first_value(doc_id) OVER (PARTITION BY run ORDER BY doc_id, first) AS d0,
             first_value(first) OVER (PARTITION BY run ORDER BY doc_id, first) AS f0 FROM b WHERE n >= 50),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS line FROM r WHERE doc_id > d0 OR first > f0),
island AS (SELECT doc_id, line, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS k FROM gone),
runs AS (SELECT doc_id, k, min(line) AS first, max(line) AS last FROM island GROUP BY doc_id, k),
g AS (SELECT doc_id, sum(last - first + 1) AS n, string_agg(first || '-' || last, ',' ORDER BY first) AS removed FROM runs GROUP BY doc_id),
kept AS (SELECT l.doc_id, count(*) FILTER (gone.line IS NULL) AS n, string_agg(t, chr(10) ORDER BY l.line) FILTER (gone.line IS NULL) AS t, count(*) AS n_lines
         FROM l LEFT JOIN gone USING (doc_id, line) GROUP BY l.doc_id)
SELECT doc_id, n_lines, CAST(coalesce(g.n, 0) AS BIGINT) AS n_removed, coalesce(removed, '') AS removed, sha256(coalesce(t, '')) AS kept_sha256
FROM kept LEFT JOIN g USING (doc_id)"""
