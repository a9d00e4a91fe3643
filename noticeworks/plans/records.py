"""The record lineage over documents, parts, orders and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.functions import codes, money
from noticeworks.operators import builds, legacy, lineage, records
from noticeworks.plans import silver
from noticeworks.session import cut, spread, table

PREFIXES = [("Brand#1", "ones"), ("Brand#", "any"), ("Brand#12", "twelve"), ("Brand#2", "twos")]
#: What is put after a document's text, and its code, by doc_id: synthetic prose has no such words.
PHRASES = ("en la Nube", "Inteligencia  Artificial", "inteligencia artificial y SOC", "Analítica, cuadro de mando", "mantenimiento de aplicaciones", "redes", "Red/servidor", "associate", "big data lake")
CODES = ("72415000", "72300000", "72413100", "48000000", "15000000", None, "72400000")


def _tenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records of the lineage: their text as summary, with a phrase as title."""
    k = F.col("doc_id")
    phrase = F.element_at(F.array(*map(F.lit, PHRASES)), (k % len(PHRASES) + 1).cast("int"))
    code = F.element_at(F.array(*map(F.lit, CODES)), (k % len(CODES) + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", phrase.alias("title"), F.col("text").alias("summary"), code.alias("cpv_main"))


def keyword_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = records.scored(_tenders(spark, sf_dir))
    return found.select("doc_id", F.array_join("matched_keywords", "|").alias("matched"), "category", "category_source", "score")


def tender_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 fields of every payload, the payload itself by its digest."""
    found = records.tender_records(silver.payloads(spark, sf_dir)[0])
    return found.select(*(c for c in found.columns if c not in ("raw", "amount")), F.round("amount", 4).alias("amount"), F.col("raw").isNotNull().alias("has_raw"))


def record_opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored records in the shape and order of BI tools."""
    rows = records.opportunity_rows(records.scored(records.tender_records(silver.payloads(spark, sf_dir)[0])))
    return records.bi_rows(rows.select("source", "tender_id", "category", "technology_score", "matched_keywords", "category_source", "published_date", "is_canonical"))


def record_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every gate over the records of all payloads."""
    return records.record_quality(records.scored(records.tender_records(silver.payloads(spark, sf_dir)[0])))


def record_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken rules, a repeated record among them, counted."""
    found = records.record_issues(records.tender_records(silver.payloads(spark, sf_dir)[0]))
    return found.groupBy("rule").agg(F.count("*").alias("n"))


def prefix_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", codes.longest_prefix(F.col("p_brand"), PREFIXES).alias("category"))


def classifier_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A length rule held against the quality labels, by precision, recall and F1."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    rows = docs.select(F.when(F.col("quality") == 1, "good").otherwise("bad").alias("gold"), F.when(F.col("n_chars") > 2000, "good").when(F.col("n_chars") > 500, "bad").otherwise("Other").alias("predicted"))
    found = legacy.evaluation(rows, "gold", "predicted", ["good", "bad", "absent"])
    return found.select("label", "tp", "fp", "fn", "support", *(F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")))


def quality_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"title_required": F.coalesce("text", F.lit("")) == "", "short_text": F.col("n_chars") < 100, "unknown_language": ~F.col("lang").isin("en", "fr", "de")}
    return legacy.quality_issues(table(spark, sf_dir, "documents"), "doc_id", rules)


def quality_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = legacy.shares(table(spark, sf_dir, "documents"), short_share=F.col("n_chars") < 500, spanish_share=F.col("lang") == "es")
    return legacy.quality_gates(metrics, [("short_share", "<=", 0.1), ("spanish_share", ">=", 0.05)])


def tech_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderpriority", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate")).alias("day"), (F.col("o_orderkey") % 5).alias("score"))
    return legacy.technology_summary(o, "o_orderpriority", "day", "score")


def buyer_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 10 == 0, "").when(F.col("c_custkey") % 10 != 1, F.concat(F.lit("n"), (F.col("c_custkey") % 10).cast("string"))).alias("buyer"), "c_mktsegment")
    return legacy.buyer_category(c, "buyer", "c_mktsegment")


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("block"), F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("source"), F.when(F.col("o_orderkey") % 8 != 0, F.col("o_orderdate").cast("date")).alias("day"))


def linkage_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.linkage_candidates(_dated(spark, sf_dir), "block", "key", "source", "day", 7)


def linkage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates, records in them, and records without a date."""
    rows = _dated(spark, sf_dir)
    pairs = legacy.linkage_candidates(rows, "block", "key", "source", "day", 7)
    counted = pairs.select(F.explode(F.array("a", "b")).alias("k")).agg((F.count("*") / 2).cast("long").alias("candidates"), F.count_distinct("k").alias("involved"))
    undated = rows.agg(F.count_if(F.col("day").isNull()).alias("undated"))
    return counted.crossJoin(undated)  # a single row each


def linkage_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of linked records, numbered by their smallest member."""
    links = legacy.linkage_candidates(_dated(spark, sf_dir), "block", "key", "source", "day", 7)
    return legacy.numbered_groups(legacy.link_groups(links)).select("node", "root", "group_no")


def linked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole linkage over orders as records of three sources: candidates, similarity of
    titles, groups and their canonical records."""
    title = F.lower(F.concat_ws(" ", F.lit("supply order"), F.col("o_orderpriority"), F.concat(F.lit("lot"), (F.col("o_orderkey") % 3).cast("string"))))
    rows = _dated(spark, sf_dir).join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), title.alias("title")), "key")
    return builds.link_duplicates(rows, 7, 0.75)


def tfidf_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that share a token, by cosine of their TF-IDF weights."""
    items = table(spark, sf_dir, "benchmark").select(F.lit("all").alias("block"), F.col("item_id").alias("key"), F.lower("text").alias("text"))
    weights = cut(legacy.tfidf(items, "block", "key", "text"))
    a, b = (weights.select("token", F.col("key").alias(k)) for k in ("a", "b"))
    pairs = a.join(b, "token").where("a < b").select(F.lit("all").alias("block"), "a", "b").distinct()
    return legacy.similarities(pairs, weights).select("a", "b", F.round("similarity", 6).alias("similarity"))


#: What titles of the lineage's orders end with, by order: the same procedure's notices share it.
GOODS = ("servidores y almacenamiento", "licencias de software", "mantenimiento de aplicaciones", "servicios en la nube", "obras de pavimentación", "suministro de energía")
LINEAGE_CODES = ("30200000", "48000000", "72260000", "72415000", "45233000", "09310000")


def lineage_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of orders as notices of their customers, of which two in five are published in a
    second source, some days later and with another title, or none."""
    o, k = spread(table(spark, sf_dir, "orders")), F.col("o_orderkey")
    of = lambda names: F.element_at(F.array(*map(F.lit, names)), (k % len(names) + 1).cast("int"))
    buyer = F.when(F.col("o_custkey") % 20 != 0, F.concat(F.lit("Ayuntamiento de la Villa nº "), (F.col("o_custkey") % 400 + 1000).cast("string")))
    title = F.concat_ws(" ", F.lit("Expediente"), k.cast("string"), F.lit("contrato de"), of(GOODS))
    day = F.when(k % 9 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    ted = F.struct(k.cast("string").alias("ND"), F.create_map(F.lit("spa"), title).alias("TI"), F.array(F.create_map(F.lit("spa"), buyer)).alias("_b"), buyer.alias("buyer-name"), F.array(of(LINEAGE_CODES)).alias("PC"), day.alias("PD"))
    again = F.when(k % 35 == 0, F.lit("!")).when(k % 5 == 0, F.concat(F.upper(title), F.lit(" (lote único)"))).otherwise(F.concat_ws(" ", F.lit("Otro anuncio"), of(GOODS)))
    later = F.concat(F.date_format(F.date_add("o_orderdate", (k % 10).cast("int")), "yyyy-MM-dd"), F.lit("T10:00:00Z"))
    feed = F.struct(F.concat(F.lit("https://x/"), k.cast("string")).alias("atom_id"), k.cast("string").alias("tender_no"), again.alias("title"), buyer.alias("buyer"), F.array(of(LINEAGE_CODES)).alias("cpv"), later.alias("updated"))
    both = [o.select(F.lit("ted").alias("source"), F.to_json(ted).alias("payload_json")), o.where(k % 5 < 2).select(F.lit("placsp").alias("source"), F.to_json(feed).alias("payload_json"))]
    return both[0].unionByName(both[1])


def _lineage(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scored records, assignments and counters, from payloads."""
    scored = cut(records.scored(records.tender_records(lineage_payloads(spark, sf_dir))).drop("raw"))
    return scored, *lineage.duplicate_groups(lineage.linkable(scored))


def record_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From payloads to opportunities with their duplicate groups."""
    scored, assigned, _ = _lineage(spark, sf_dir)
    rows = lineage.assigned_opportunities(scored, assigned)
    return rows.select("source", "tender_id", "category", "category_source", "dup_group", "is_canonical", "duplicate_of")


def lineage_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of the lineage's linkage, and the share of records that repeat another."""
    scored, _, stats = _lineage(spark, sf_dir)
    n = scored.agg(F.count("*").alias("records"))
    both = stats.drop("compared_pairs").join(F.broadcast(n))  # a single row each
    return both.withColumn("duplicate_share", money.share(F.col("duplicated_records"), F.col("records")))


def classifier_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyword verdict of the lineage's records against their codes."""
    return lineage.code_evaluation(records.scored(records.tender_records(lineage_payloads(spark, sf_dir))))


QUERIES = {
    f.__name__: f
    for f in (
        keyword_classify, tender_records, record_opportunities, record_quality, record_issues, prefix_category, classifier_eval, quality_issues, quality_gates, tech_summary, buyer_category, linkage_candidates, linkage_stats, linkage_groups, linked_records, tfidf_similarity, record_lineage, lineage_counters, classifier_by_code,
    )
}

def _hit(word: str) -> str:
    return f"regexp_matches(t, '(^|[^\\p{{L}}\\p{{N}}_]){word}($|[^\\p{{L}}\\p{{N}}_])')"


_WORDS = sorted({w for _, ws in records.CATEGORIES for w in ws})
_CASE = " ".join(f"WHEN {' OR '.join(_hit(w) for w in ws)} THEN '{name}'" for name, ws in records.CATEGORIES)
_BY_CODE = " ".join(f"WHEN starts_with(cpv_main, '{p}') THEN '{name}'" for p, name in sorted(records.PREFIXES, key=lambda x: -len(x[0])))
_CLASSED = f"""coalesce(w, c, 'Other') AS category, CASE WHEN w IS NOT NULL THEN 'keywords' WHEN c IS NOT NULL THEN 'cpv' ELSE 'none' END AS category_source"""
_FOUND = f"""list_filter([{", ".join(f"CASE WHEN {_hit(w)} THEN '{w}' END" for w in _WORDS)}], lambda x: x IS NOT NULL)"""
_PHRASE = "[" + ", ".join(f"'{x}'" for x in PHRASES) + "]"
_CODE = "[" + ", ".join("NULL" if x is None else f"'{x}'" for x in CODES) + "]"
_NULL = "CAST(NULL AS VARCHAR)"
#: The records of silver.payloads: a feed's entries are observed twice.
_R = f"""r AS (
  SELECT 'ted' AS source, CAST(o_orderkey AS VARCHAR) AS tender_id, CASE WHEN o_orderkey % 5 = 0 THEN '[Anulado] t' ELSE 't' END || o_custkey AS title, 'a ' || chr(65533) || ' b' AS summary, {_NULL} AS buyer,
     CAST(o_orderdate AS DATE) AS published_date, 'EUR' AS currency, 'ESP' AS country, {_NULL} AS url, '72000000' AS cpv_main, {_NULL} AS buyer_id, {_NULL} AS region, {_NULL} AS status,
     CASE WHEN o_orderkey % 3 = 0 THEN 7.25 WHEN o_orderkey % 4 = 0 THEN 1500 ELSE CAST(CAST(o_totalprice AS DECIMAL(20,2)) AS DOUBLE) END AS amount FROM orders
  UNION ALL SELECT 'placsp', CAST(c_custkey AS VARCHAR), c_name, '', NULL, CASE WHEN c_custkey % 3 <> 0 THEN DATE '2024-01-02' END, 'EUR', 'ES', NULL, c_mktsegment, NULL, NULL, 'PUB',
     CAST(CAST(abs(c_acctbal) AS DECIMAL(20,2)) AS DOUBLE) FROM customer, range(2)
  UNION ALL SELECT 'boe', 'B' || s_suppkey, s_name, '', NULL, DATE '2024-01-05', NULL, 'ES', NULL, NULL, NULL, NULL, NULL, NULL FROM supplier)"""
_L = """r AS (SELECT o_custkey AS block, o_orderkey AS key, o_orderstatus AS source, CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders),
l AS (SELECT x.block, x.key AS a, y.key AS b FROM r x JOIN r y ON x.block = y.block AND x.key < y.key AND x.source <> y.source AND abs(date_diff('day', x.day, y.day)) <= 7)"""
_LIST = lambda names: "[" + ", ".join(f"'{x}'" for x in names) + "]"
#: The records of lineage_payloads, their groups and verdicts.
_LINEAGE = f"""
o AS (SELECT *, o_orderkey AS k, {_LIST(GOODS)}[o_orderkey % {len(GOODS)} + 1] AS goods, {_LIST(LINEAGE_CODES)}[o_orderkey % {len(LINEAGE_CODES)} + 1] AS code,
  CASE WHEN o_custkey % 20 <> 0 THEN 'ayuntamiento villa ' || (o_custkey % 400 + 1000) ELSE 'sin-comprador' END AS buyer FROM orders),
r AS (SELECT 'ted' AS source, k, code, buyer || '|' || substr(code, 1, 2) AS block, CASE WHEN k % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS day, 'Expediente ' || k || ' contrato de ' || goods AS title FROM o
  UNION ALL SELECT 'placsp', k, code, buyer || '|' || substr(code, 1, 2), CAST(o_orderdate AS DATE) + CAST(k % 10 AS INT),
    CASE WHEN k % 35 = 0 THEN '!' WHEN k % 5 = 0 THEN upper('Expediente ' || k || ' contrato de ' || goods) || ' (lote único)' ELSE 'Otro anuncio ' || goods END FROM o WHERE k % 5 < 2),
s AS (SELECT *, source || chr(1) || k AS key, strip_accents(lower(title)) AS t FROM r),
c AS (SELECT x.block, x.key AS a, y.key AS b FROM s x JOIN s y ON x.block = y.block AND x.source = 'placsp' AND y.source = 'ted' AND abs(date_diff('day', x.day, y.day)) <= 7),
i AS (SELECT block, a AS key FROM c UNION SELECT block, b FROM c),
w AS (SELECT block, key, unnest(list_filter(regexp_extract_all(t, '[\\p{{L}}\\p{{N}}]+'), lambda x: length(x) > 2)) AS w FROM i JOIN s USING (block, key)),
f AS (SELECT block, key, w, count(*) AS tf FROM w GROUP BY ALL), d AS (SELECT block, w, count(*) AS df FROM f GROUP BY ALL), n AS (SELECT block, count(*) AS n FROM i GROUP BY block),
x AS (SELECT block, key, w, (1 + tf) * ln((1 + n)::DOUBLE / (1 + df)) + 1 AS v FROM f JOIN d USING (block, w) JOIN n USING (block)),
y AS (SELECT block, key, w, v / sqrt(sum(v * v) OVER (PARTITION BY block, key)) AS v FROM x),
l AS (SELECT a, b FROM c JOIN y p ON p.block = c.block AND p.key = a JOIN y q ON q.block = c.block AND q.key = b AND q.w = p.w GROUP BY a, b HAVING round(sum(p.v * q.v), 12) >= 0.75),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
g AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, g.root FROM g JOIN e ON e.a = g.node AND g.root < e.b),
m AS (SELECT node AS key, min(root) AS root FROM g GROUP BY node),
z AS (SELECT m.*, dense_rank() OVER (ORDER BY root) AS group_no, first_value(key) OVER q AS canonical, first_value(CAST(k AS VARCHAR)) OVER q AS canonical_id
  FROM m JOIN s USING (key) WINDOW q AS (PARTITION BY root ORDER BY day, -length(title), CAST(k AS VARCHAR), source)),
v AS (SELECT s.*, CASE {_CASE} END AS by_word, CASE {_BY_CODE.replace("cpv_main", "code")} END AS by_code FROM s)"""
_MARKS = ", ".join(f"round_even({x}, 4) AS {name}" for x, name in (("p", "precision"), ("r", "recall"), ("f", "f1")))
ORACLES = {
    "record_lineage": f"""WITH RECURSIVE {_LINEAGE} SELECT source, CAST(k AS VARCHAR) AS tender_id, coalesce(by_word, by_code, 'Other') AS category,
        CASE WHEN by_word IS NOT NULL THEN 'keywords' WHEN by_code IS NOT NULL THEN 'cpv' ELSE 'none' END AS category_source, CAST(group_no AS INT) AS dup_group,
        coalesce(key = canonical, true) AS is_canonical, CASE WHEN key <> canonical THEN canonical_id END AS duplicate_of FROM v LEFT JOIN z USING (key)""",
    "lineage_counters": f"""WITH RECURSIVE {_LINEAGE} SELECT (SELECT count(*) FROM c) AS candidate_pairs, (SELECT count(*) FROM c JOIN s ON s.key = a WHERE t <> '!') AS evaluated_pairs, (SELECT count(*) FROM l) AS linked_pairs,
        (SELECT count(DISTINCT root) FROM m) AS linked_groups, (SELECT count(*) - count(DISTINCT root) FROM m) AS duplicated_records, (SELECT count(*) FROM s WHERE day IS NULL) AS records_without_date,
        (SELECT count(*) FROM s) AS records, round_even((SELECT count(*) - count(DISTINCT root) FROM m)::DOUBLE / (SELECT count(*) FROM s), 4) AS duplicate_share""",
    "classifier_by_code": f"""WITH RECURSIVE {_LINEAGE}, h AS (SELECT by_code AS gold, coalesce(by_word, 'Other') AS said FROM v WHERE by_code IS NOT NULL AND by_word IS NOT NULL),
        labels AS (SELECT unnest({_LIST([name for name, _ in records.CATEGORIES])}) AS label),
        n2 AS (SELECT label, count(*) FILTER (gold = label AND said = label) AS tp, count(*) FILTER (gold <> label AND said = label) AS fp, count(*) FILTER (gold = label AND said <> label) AS fn FROM labels, h GROUP BY label),
        p2 AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fn) END AS r FROM n2),
        f2 AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0::DOUBLE ELSE 2 * p * r / (p + r) END AS f FROM p2)
        SELECT label AS category, {_MARKS}, tp + fn AS support, (SELECT count(*) FROM h) AS evaluated_records, (SELECT count(*) FROM s) AS total_records,
        round_even((SELECT count(*) FROM h)::DOUBLE / (SELECT count(*) FROM s), 4) AS coverage, round_even((SELECT avg(f) FROM f2), 4) AS macro_f1 FROM f2""",
    "keyword_classify": f"""SELECT doc_id, array_to_string({_FOUND}, '|') AS matched, {_CLASSED}, CAST(len({_FOUND}) AS INT) AS score
        FROM (SELECT *, CASE {_CASE} END AS w, CASE {_BY_CODE} END AS c FROM (SELECT doc_id, {_CODE}[doc_id % {len(CODES)} + 1] AS cpv_main,
              strip_accents(lower({_PHRASE}[doc_id % {len(PHRASES)} + 1] || ' ' || coalesce(text, ''))) AS t FROM documents))""",
    "tender_records": f"""WITH {_R} SELECT *, true AS has_raw FROM (SELECT * REPLACE (round(amount, 4) AS amount, CASE WHEN source = 'placsp' AND amount IS NULL THEN NULL ELSE currency END AS currency) FROM r)""",
    "record_opportunities": f"""WITH {_R} SELECT source, tender_id, {_CLASSED}, CAST(len({_FOUND}) AS INT) AS technology_score, array_to_string({_FOUND}, ', ') AS matched_keywords,
        coalesce(strftime(published_date, '%Y-%m-%d'), '') AS published_date, true AS is_canonical
        FROM (SELECT *, CASE {_CASE} END AS w, CASE {_BY_CODE} END AS c FROM (SELECT *, strip_accents(lower(title || ' ' || summary)) AS t FROM r))""",
    "record_quality": f"""WITH {_R}, n AS (SELECT count(*) AS n, count(*) FILTER (published_date IS NULL) AS d, count(*) FILTER (CASE WHEN len({_FOUND.replace("(t, ", "(strip_accents(lower(title || ' ' || summary)), ")}) > 0 THEN true ELSE false END) AS m FROM r),
        k AS (SELECT count(*) AS k FROM (SELECT source, tender_id FROM r GROUP BY ALL HAVING count(*) > 1)),
        g AS (SELECT 'records' AS metric, CAST(n AS DOUBLE) AS value, '>=' AS operator, 1.0::DOUBLE AS threshold FROM n UNION ALL SELECT 'title_null_share', 0, '<=', 0.05 FROM n
          UNION ALL SELECT 'publication_date_null_share', round_even(d::DOUBLE / n, 4), '<=', 0.05 FROM n UNION ALL SELECT 'invalid_amount_share', 0, '<=', 0.1 FROM n
          UNION ALL SELECT 'technology_match_share', round_even(m::DOUBLE / n, 4), '>=', 0.05 FROM n UNION ALL SELECT 'duplicate_keys', CAST(k AS DOUBLE), '<=', 0 FROM k
          UNION ALL SELECT 'duplicate_share', 0, '<=', 0.35)
        SELECT *, CASE operator WHEN '<=' THEN value <= threshold ELSE value >= threshold END AS passed FROM g""",
    "record_issues": "SELECT 'unique_source_tender_id' AS rule, count(*) AS n FROM customer",
    "prefix_category": "SELECT p_partkey, CASE WHEN p_brand LIKE 'Brand#12%' THEN 'twelve' WHEN p_brand LIKE 'Brand#1%' THEN 'ones' WHEN p_brand LIKE 'Brand#2%' THEN 'twos' ELSE 'any' END AS category FROM part",
    "classifier_eval": """WITH r AS (SELECT CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS g, CASE WHEN n_chars > 2000 THEN 'good' WHEN n_chars > 500 THEN 'bad' ELSE 'Other' END AS p FROM documents JOIN labels USING (doc_id)),
        l AS (SELECT unnest(['good', 'bad', 'absent']) AS label),
        c AS (SELECT label, (SELECT count(*) FROM r WHERE g = label AND p = label) AS tp, (SELECT count(*) FROM r WHERE g <> label AND p = label) AS fp, (SELECT count(*) FROM r WHERE g = label AND p <> label) AS fn FROM l),
        d AS (SELECT *, tp + fn AS support, CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fp) END AS pr, CASE WHEN tp + fn = 0 THEN 0.0::DOUBLE ELSE tp::DOUBLE / (tp + fn) END AS re FROM c)
        SELECT label, tp, fp, fn, support, round(pr, 4) AS precision, round(re, 4) AS recall, round(CASE WHEN pr + re = 0 THEN 0.0::DOUBLE ELSE 2 * pr * re / (pr + re) END, 4) AS f1 FROM d""",
    "quality_issues": """SELECT doc_id AS record, 'title_required' AS rule FROM documents WHERE coalesce(text, '') = '' UNION ALL SELECT doc_id, 'short_text' FROM documents WHERE n_chars < 100
        UNION ALL SELECT doc_id, 'unknown_language' FROM documents WHERE lang NOT IN ('en', 'fr', 'de')""",
    "quality_gates": """WITH m AS (SELECT round_even(avg(CAST(n_chars < 500 AS DOUBLE)), 4) AS a, round_even(avg(CAST(lang = 'es' AS DOUBLE)), 4) AS b FROM documents)
        SELECT 'short_share' AS metric, a AS value, '<=' AS operator, CAST(0.1 AS DOUBLE) AS threshold, a <= 0.1 AS passed FROM m
        UNION ALL SELECT 'spanish_share', b, '>=', 0.05, b >= 0.05 FROM m""",
    "tech_summary": """SELECT o_orderpriority AS category, CASE WHEN o_orderkey % 9 <> 0 THEN strftime(o_orderdate, '%Y-%m') ELSE 'unknown' END AS month, count(*) AS records,
        CAST(sum(o_orderkey % 5) AS BIGINT) AS score FROM orders GROUP BY ALL""",
    "buyer_category": """SELECT CASE WHEN c_custkey % 10 < 2 THEN '(unknown)' ELSE 'n' || (c_custkey % 10) END AS buyer, c_mktsegment AS category, count(*) AS records FROM customer GROUP BY ALL""",
    "linkage_candidates": f"WITH {_L} SELECT block, a, b FROM l",
    "linkage_stats": f"""WITH {_L} SELECT (SELECT count(*) FROM l) AS candidates, (SELECT count(*) FROM (SELECT a FROM l UNION SELECT b FROM l)) AS involved, (SELECT count(*) FROM r WHERE day IS NULL) AS undated""",
    "linkage_groups": f"""WITH RECURSIVE {_L}, e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
        g AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, g.root FROM g JOIN e ON e.a = g.node AND g.root < e.b),
        m AS (SELECT node, min(root) AS root FROM g GROUP BY node)
        SELECT node, root, CAST(dense_rank() OVER (ORDER BY root) AS INT) AS group_no FROM m""",
    "linked_records": f"""WITH RECURSIVE {_L},
        s AS (SELECT r.*, lower('supply order ' || o_orderpriority || ' lot' || (o_orderkey % 3)) AS title FROM r JOIN orders ON o_orderkey = key),
        i AS (SELECT block, a AS key FROM l UNION SELECT block, b FROM l), t AS (SELECT block, key, unnest(list_filter(regexp_extract_all(title, '[\\p{{L}}\\p{{N}}]+'), lambda x: length(x) > 2)) AS w FROM i JOIN s USING (block, key)),
        f AS (SELECT block, key, w, count(*) AS tf FROM t GROUP BY ALL), d AS (SELECT block, w, count(*) AS df FROM f GROUP BY ALL), n AS (SELECT block, count(*) AS n FROM i GROUP BY block),
        x AS (SELECT block, key, w, (1 + tf) * ln((1 + n)::DOUBLE / (1 + df)) + 1 AS v FROM f JOIN d USING (block, w) JOIN n USING (block)),
        y AS (SELECT block, key, w, v / sqrt(sum(v * v) OVER (PARTITION BY block, key)) AS v FROM x),
        k AS (SELECT a, b FROM l JOIN y p ON p.block = l.block AND p.key = a JOIN y q ON q.block = l.block AND q.key = b AND q.w = p.w GROUP BY a, b HAVING round(sum(p.v * q.v), 12) >= 0.75),
        e AS (SELECT a, b FROM k UNION SELECT b, a FROM k),
        g AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, g.root FROM g JOIN e ON e.a = g.node AND g.root < e.b),
        m AS (SELECT node, min(root) AS root FROM g GROUP BY node)
        SELECT node AS key, root, CAST(dense_rank() OVER (ORDER BY root) AS INT) AS group_no, first_value(node) OVER (PARTITION BY root ORDER BY day, -length(title), node, source) AS canonical
        FROM m JOIN s ON s.key = node""",
    "tfidf_similarity": r"""WITH t AS (SELECT item_id AS k, unnest(list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), lambda x: length(x) > 2)) AS w FROM benchmark),
        f AS (SELECT k, w, count(*) AS tf FROM t GROUP BY k, w), d AS (SELECT w, count(*) AS df FROM f GROUP BY w), n AS (SELECT count(*) AS n FROM benchmark),
        x AS (SELECT k, f.w, (1 + tf) * ln((1 + n)::DOUBLE / (1 + df)) + 1 AS v FROM f JOIN d ON f.w = d.w, n),
        y AS (SELECT k, w, v / sqrt(sum(v * v) OVER (PARTITION BY k)) AS v FROM x)
        SELECT a.k AS a, b.k AS b, round(sum(a.v * b.v), 6) AS similarity FROM y a JOIN y b ON a.w = b.w AND a.k < b.k GROUP BY a.k, b.k""",
}
