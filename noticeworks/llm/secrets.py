"""Secret scans with corpus-wide ownership frequency.

Three kinds are always reported (``BASE_KINDS``). The hash of every candidate secret is counted
over the corpus by distinct repositories and owners: what many have is a copied example, a
checksum or a name, what one owner alone has looks like a live credential. The verdict adds
spans: ``live`` over the secret itself within a base span, where only its owner has it, and
``other`` over long runs of letters and digits of no known form, which are candidates only and
reported only if live. Every span carries the counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm.common import empty_if_null, expanded, fresh, row_key, table, unused, written

#: Kind, pattern, group of the secret itself, least characters of that group; fixed values.
BASE_KINDS = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    # whole runs, as the lookbehind keeps the scan linear in long runs
    ("hex", r"(?<![0-9a-f])[0-9a-f]{32,}", 0, 32),
)
OTHER = ("other", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}", 0, 20)
#: The order of kinds at one start; ``live`` is the secret of a base span with one owner.
ORDER = {name: i for i, name in enumerate((*(k for k, *_ in BASE_KINDS), "other", "live"))}


@dataclass(frozen=True)
class Ownership:
    """A candidate seen in at most so many distinct repositories and by so many distinct owners
    looks live; a leaked credential may have a few copies, an example has many."""

    max_repositories: int = 3
    max_owners: int = 1


def _spans(matches: Column, parts: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of matches, given the text's parts between them: a match starts where the parts
    and matches before it end. Short ones are dropped, after all of them have been placed."""
    rank = ORDER[kind]

    def place(state: Column, pair: Column) -> Column:
        start = state["end"] + F.length(pair["part"])
        secret = F.regexp_extract(pair["match"], pattern, group) if group else pair["match"]
        # the secret is what a match of this kind ends with
        end = start + F.length(pair["match"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.md5(secret).alias("hash"), (end - F.length(secret)).alias("inner"))
        kept = F.when(F.length(secret) >= least, F.concat(state["out"], F.array(span))).otherwise(state["out"])
        return F.struct((start + F.length(pair["match"])).alias("end"), kept.alias("out"))

    begin = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,rank:int,end:int,hash:string,inner:int>>").alias("out"))
    pairs = F.zip_with(matches, F.slice(parts, 1, F.size(matches)), lambda m, p: F.struct(m.alias("match"), p.alias("part")))
    return F.aggregate(pairs, begin, place, lambda s: s["out"])


def with_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with ``_found``: spans of all kinds, ``other`` ones only where no base span is."""
    t = empty_if_null(text)
    kinds = (*BASE_KINDS, OTHER)
    matched = docs.select("*", F.inline(F.array(F.struct(*(F.regexp_extract_all(t, F.lit(p), F.lit(0)).alias(f"_m_{k}") for k, p, _, _ in kinds)))))
    none = F.array().cast("array<string>")
    # texts without a match, nearly all of them, aren't split
    split = matched.select("*", F.inline(F.array(F.struct(*(F.when(F.size(f"_m_{k}") > 0, F.split(t, p, -1)).otherwise(none).alias(f"_p_{k}") for k, p, _, _ in kinds)))))
    base = F.concat(*(_spans(F.col(f"_m_{k}"), F.col(f"_p_{k}"), k, p, g, n) for k, p, g, n in BASE_KINDS))
    k, p, g, n = OTHER
    other = _spans(F.col(f"_m_{k}"), F.col(f"_p_{k}"), k, p, g, n)
    # a credential has digits and letters
    mixed = F.filter(other, lambda s: F.substring(t, s["start"] + 1, s["end"] - s["start"]).rlike("(?s)(?=.*[0-9]).*[A-Za-z]"))
    placed = split.select("*", F.inline(F.array(F.struct(base.alias("_base"), mixed.alias("_other")))))
    # in order of place a candidate meets a base span before it if one has reached its start, and,
    # from behind, one after it if one begins before its end
    every = F.array_sort(F.concat("_base", "_other"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,hash:string,inner:int>>")

    def ahead(state: Column, s: Column) -> Column:
        free = (s["rank"] < ORDER["other"]) | (s["start"] >= state["edge"])
        edge = F.when(s["rank"] < ORDER["other"], F.greatest(state["edge"], s["end"])).otherwise(state["edge"])
        return F.struct(F.when(free, F.concat(state["out"], F.array(s))).otherwise(state["out"]).alias("out"), edge.alias("edge"))

    def behind(state: Column, s: Column) -> Column:
        free = (s["rank"] < ORDER["other"]) | (s["end"] <= state["edge"])
        edge = F.when(s["rank"] < ORDER["other"], F.least(state["edge"], s["start"])).otherwise(state["edge"])
        return F.struct(F.when(free, F.concat(state["out"], F.array(s))).otherwise(state["out"]).alias("out"), edge.alias("edge"))

    passed = F.aggregate(every, F.struct(none.alias("out"), F.lit(0).alias("edge")), ahead, lambda s: s["out"])
    passed = F.aggregate(F.reverse(passed), F.struct(none.alias("out"), F.lit((1 << 31) - 1).alias("edge")), behind, lambda s: s["out"])
    found = F.when(F.size("_other") == 0, F.col("_base")).otherwise(passed)
    return placed.select(*(F.col(c) for c in docs.columns), found.alias("_found"))


def find_secrets(docs: DataFrame, repository: str | None = None, owner: str = "source", doc_id: str = "doc_id", text: str = "text", limits: Ownership | None = None) -> DataFrame:
    """One row per document: doc_id, _key, spans (start, rank, end, repositories, owners, live).

    Spans are in code points, the end exclusive, ordered by start and kind. Base spans are all
    there; ``live`` and ``other`` ones only where the candidate looks live. ``repository`` names
    a column; without one each distinct text is a repository, so that copies of a text count
    once. A null or empty text has no spans; a null repository or owner counts as one of its
    own. Rows equal in document and text are found once each; rows of one document with
    different texts are told apart by ``_key``. An empty table gives an empty result; other
    columns are ignored.

    Texts are searched once: what is found, a few numbers for each span, is written to the
    shared folder. Candidates are counted by distinct (hash, repository, owner) before they are
    shuffled, so that a secret in a third of all rows is a few rows; the counts are joined back
    by a join that adaptive execution can split.
    """
    limits = limits or Ownership()
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.col(repository).cast("string"), F.lit("")) if repository else F.md5(empty_if_null(text))).alias("_repository"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("_owner"),
        row_key(doc_id, text).alias("_key"),
        F.col(text).alias("_text"),
    )
    found = written(with_candidates(rows, "_text").drop("_text"), "candidates")
    # each document also has a marker, with a hash that no secret has, so that it isn't lost
    marker = F.struct(F.lit(-1).alias("start"), F.lit(-1).alias("rank"), F.lit(-1).alias("end"), F.concat(F.lit("~"), F.col("_key")).alias("hash"), F.lit(-1).alias("inner"))
    each = found.select("doc_id", "_key", F.explode(F.concat(F.array(marker), "_found")).alias("s")).select("doc_id", "_key", "s.*")
    owned = found.select("_repository", "_owner", F.explode("_found.hash").alias("hash")).distinct()
    stats = owned.groupBy("hash").agg(F.countDistinct("_repository").alias("repositories"), F.countDistinct("_owner").alias("owners"))
    joined = each.join(stats.select(fresh(F.col("hash")).alias("hash"), "repositories", "owners"), "hash", "left")
    live = (F.col("repositories") <= limits.max_repositories) & (F.col("owners") <= limits.max_owners)
    span = F.struct("start", "rank", "end", "repositories", "owners", live.alias("live"))
    inner = F.struct(F.col("inner").alias("start"), F.lit(ORDER["live"]).alias("rank"), "end", "repositories", "owners", live.alias("live"))
    is_base = (F.col("rank") >= 0) & (F.col("rank") < ORDER["other"])
    spans = F.array_compact(F.array(F.when(is_base | ((F.col("rank") == ORDER["other"]) & live), span), F.when(is_base & live, inner)))
    grouped = joined.groupBy("doc_id", "_key").agg(F.count_if(F.col("rank") < 0).alias("_n"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(spans)))).alias("spans"))
    return expanded(grouped, "_n", "_copy").select("doc_id", "_key", "spans")


def shown(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    names = F.array(*(F.lit(k) for k in ORDER))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact_secrets(docs: DataFrame, **options) -> DataFrame:
    """docs with every reported span replaced by ``[kind]``; n_chars follows.

    A secret whose hash is live is marked ``[kind:live]``. Null texts and texts without spans stay
    as they are. Overlapping spans are replaced as one, by the first. An empty table gives an
    empty result; columns of any name come back as they were.
    """
    key, held, new = unused(docs, "_key", "_spans", "_new")
    spans = find_secrets(docs, **options).select(F.col("_key").alias(key), F.filter("spans", lambda s: s["rank"] < ORDER["live"]).alias(held)).where(F.size(held) > 0).dropDuplicates([key])
    names = F.array(*(F.lit(k) for k in ORDER))

    def cut(state: Column, s: Column) -> Column:
        name = F.concat(F.lit("["), F.get(names, s["rank"]), F.when(s["live"], ":live]").otherwise("]"))
        piece = F.concat(F.substring(F.col("text"), state["end"] + 1, s["start"] - state["end"]), name)
        return F.struct(
            F.when(s["start"] >= state["end"], F.concat(state["out"], piece)).otherwise(state["out"]).alias("out"), F.greatest(state["end"], s["end"]).alias("end")
        )

    begin = F.struct(F.lit("").alias("out"), F.lit(0).alias("end"))
    tail = F.length("text")
    redacted = F.aggregate(held, begin, cut, lambda s: F.concat(s["out"], F.substring(F.col("text"), s["end"] + 1, tail)))
    joined = docs.withColumn(key, row_key()).join(spans, key, "left").withColumn(new, F.when(F.col(held).isNotNull(), redacted).otherwise(F.col("text")))
    changed = {"text": F.col(new), "n_chars": F.when(F.col(held).isNotNull(), F.length(new).cast("long")).otherwise(F.col("n_chars"))}
    return joined.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns))


def op1_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; their source stands for the owner and each distinct text for a repository."""
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < ORDER["other"])

    def count(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(shown(base), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
        (count(ORDER["other"]) + count(ORDER["live"])).alias("n_live"),
    )


def _sql() -> str:
    """The same by DuckDB: parts between matches place the matches there as well."""
    arms = []
    for k, p, g, n in (*BASE_KINDS, OTHER):
        p = p.replace("(?<![0-9a-f])", "").replace("(?<![A-Za-z0-9+/_-])", "").replace("'", "''")
        arms.append(f"""
  SELECT doc_id, source, text, {ORDER[k]} AS rank, '{k}' AS kind, m[i] AS match,
         regexp_extract(m[i], '{p}', {g}) AS secret,
         coalesce(list_sum([length(x) for x in p[1:i]]), 0) + coalesce(list_sum([length(x) for x in m[1:i-1]]), 0) AS start
  FROM (SELECT doc_id, source, text, m, p, unnest(range(1, len(m) + 1)) AS i FROM
    (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{p}') AS m,
            regexp_split_to_array(coalesce(text, ''), '{p}') AS p FROM documents))
  WHERE length(regexp_extract(m[i], '{p}', {g})) >= {n}""")
    return f"""
WITH c AS ({" UNION ALL ".join(arms)}),
s AS (SELECT *, start + length(match) AS stop FROM c),
a AS (SELECT * FROM s WHERE rank < 3 OR (match SIMILAR TO '.*[0-9].*' AND match SIMILAR TO '.*[A-Za-z].*'
      AND NOT EXISTS (SELECT 1 FROM s b WHERE b.rank < 3 AND b.doc_id = s.doc_id AND b.start < s.stop AND s.start < b.stop))),
o AS (SELECT secret, count(DISTINCT coalesce(source, '')) <= 1 AND count(DISTINCT text) <= 3 AS live FROM a GROUP BY secret),
j AS (SELECT doc_id, rank, kind, start, stop FROM a JOIN o USING (secret) WHERE rank < 3 OR live
   UNION ALL SELECT DISTINCT doc_id, 4, 'live', stop - length(secret), stop FROM a JOIN o USING (secret) WHERE rank < 3 AND live),
g AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
   coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (rank < 3), '') AS base,
   string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans, count(*) FILTER (rank >= 3) AS n_live FROM j GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
   sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM documents d LEFT JOIN g USING (doc_id)"""


OP1_SQL = _sql()
