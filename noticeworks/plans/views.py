"""Enrichment and summaries: orders as opportunities, their parts as codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.functions import codes
from noticeworks.operators import builds, enrich
from noticeworks.session import in_parts, table


def _opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("procedure_id"), F.lpad((F.col("l_partkey") % 400).cast("string"), 9, "0").alias("_code"))
    parts = in_parts(items, "procedure_id").groupBy("procedure_id").agg(F.array_sort(F.collect_set("_code")).alias("cpv_codes"))
    rows = o.select(
        F.col("o_orderkey").alias("procedure_id"),
        F.when(F.col("o_custkey") % 4 != 0, F.concat(F.lit("B"), F.col("o_custkey").cast("string"))).alias("buyer_id"),
        F.when(F.col("o_custkey") % 8 != 0, F.concat(F.lit("name "), (F.col("o_custkey") % 50).cast("string"))).alias("buyer_name"),
        F.col("o_totalprice").cast("decimal(20,2)").alias("estimated_value"),
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate").cast("date")).alias("publication_date"),
        F.col("o_orderdate").alias("deadline"),
        F.col("o_orderpriority").alias("source"),
    )
    none = F.array().cast("array<string>")
    return rows.join(parts, "procedure_id", "left").withColumn("cpv_codes", F.coalesce("cpv_codes", none))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.lpad((2 * F.col("p_partkey")).cast("string"), 9, "0").alias("code"), F.col("p_name").alias("label"))


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_dimension(enrich.exploded_codes(_opportunities(spark, sf_dir)), enrich.dimension(_labels(spark, sf_dir)), "cpv_code", "code", "cpv_matched")


def codes_posexplode_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _codes(spark, sf_dir).select("procedure_id", "cpv_position", "cpv_code", "label", "cpv_matched")


def coverage_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.code_coverage(_codes(spark, sf_dir))


def buyer_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with and without a buyer id, resolved and unresolved; units have even numbers."""
    dim = table(spark, sf_dir, "customer").select(F.concat(F.lit("B"), (2 * F.col("c_custkey")).cast("string")).alias("code"), "c_mktsegment")
    joined = enrich.with_dimension(_opportunities(spark, sf_dir), enrich.dimension(dim), "buyer_id", "code", "buyer_matched")
    return joined.agg(
        F.count("buyer_id").alias("with_id"), F.count_if(F.col("buyer_id").isNull()).alias("without_id"), F.count_if("buyer_matched").alias("resolved"),
        F.count_if(F.col("buyer_id").isNotNull() & ~F.col("buyer_matched")).alias("unresolved"),
    )


def buyer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.buyer_summary(_opportunities(spark, sf_dir))


def code_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.code_summary(enrich.exploded_codes(_opportunities(spark, sf_dir)), _labels(spark, sf_dir))


def monthly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.monthly_summary(_opportunities(spark, sf_dir))


def undated_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.undated_summary(_opportunities(spark, sf_dir))


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _opportunities(spark, sf_dir)
    return enrich.reconciliation(base, _codes(spark, sf_dir), enrich.buyer_summary(base), enrich.monthly_summary(base), enrich.undated_summary(base))


def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as the CSV export writes them: arrays as JSON, instants with a zone."""
    rows = _opportunities(spark, sf_dir)
    return rows.select("procedure_id", F.to_json("cpv_codes").alias("cpv_codes"), "estimated_value", F.date_format("deadline", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("deadline"))


def _tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.rpad((F.col("p_partkey") + 10).cast("string"), 8, "0").alias("code"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_name")).alias("es"), F.lit(" ").alias("en")).dropDuplicates(["code"])


def hierarchy_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _tree(spark, sf_dir).select("code")
    c = F.col("code")
    return rows.select("code", codes.level(c).cast("int").alias("level"), codes.structural_parent(c).alias("parent"), codes.is_valid(c).alias("valid"))


def nearest_ancestor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.code_dimension(_tree(spark, sf_dir), "code", "es", "en").select("cpv_code", "label_en", F.col("level").cast("int").alias("level"), "parent_code", "is_leaf")


def row_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first reason against each customer row, counted with the parents that don't exist."""
    c = table(spark, sf_dir, "customer")
    reason = (
        F.when(~F.col("c_name").rlike(r"^Customer#\d{9}$"), "invalid_format")
        .when(F.col("c_acctbal") < 1000, "missing_status")
        .when(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY", "HOUSEHOLD"), "invalid_status")
        .when(F.col("c_custkey") % 13 == 0, "invalid_parent")
    )
    marked = c.withColumn("reason", F.coalesce(reason, F.lit("accepted")))
    return marked.groupBy("reason").agg(F.count("*").alias("n"), F.count_distinct("c_nationkey").alias("nations"))


def unit_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as facts whose buyers are suppliers, of which most have none: the coverage."""
    s, key = table(spark, sf_dir, "supplier"), F.concat(F.lit("E"), F.col("s_suppkey").cast("string"))
    none = F.lit(None).cast("string")
    units = s.select(key.alias("code"), F.col("s_name").alias("name"), F.lit("1").alias("scope"), F.lit(1).cast("smallint").alias("hierarchy"), none.alias("parent"), none.alias("principal"), F.lit("V").alias("status"), none.alias("nif"))
    facts = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("procedure_id"), F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit("E"), F.col("c_custkey").cast("string"))).alias("buyer_id"))
    return enrich.unit_coverage(builds.with_units(facts, units))


QUERIES = {
    f.__name__: f
    for f in (
        codes_posexplode_left_join, coverage_metrics, buyer_coverage, buyer_summary, code_summary, monthly_summary, undated_summary, reconciliation, export_rows,
        hierarchy_levels, nearest_ancestor, row_validation, unit_enrichment,
    )
}

_O = """k AS (SELECT l_orderkey, list_sort(list(DISTINCT lpad(CAST(l_partkey % 400 AS VARCHAR), 9, '0'))) AS c FROM lineitem GROUP BY l_orderkey),
o AS (SELECT o_orderkey AS procedure_id, CASE WHEN o_custkey % 4 <> 0 THEN 'B' || o_custkey END AS buyer_id, CASE WHEN o_custkey % 8 <> 0 THEN 'name ' || (o_custkey % 50) END AS buyer_name,
   CAST(o_totalprice AS DECIMAL(20,2)) AS estimated_value, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS publication_date, o_orderdate AS deadline,
   o_orderpriority AS source, coalesce(c, []) AS cpv_codes FROM orders LEFT JOIN k ON l_orderkey = o_orderkey)"""
_C = """p AS (SELECT lpad(CAST(2 * p_partkey AS VARCHAR), 9, '0') AS code, p_name AS label FROM part),
x AS (SELECT o.* EXCLUDE cpv_codes, CAST(i AS INT) AS cpv_position, cpv_codes[i] AS cpv_code FROM o, unnest(range(1, len(cpv_codes) + 1)) AS t(i)),
j AS (SELECT x.*, label, code IS NOT NULL AS cpv_matched FROM x LEFT JOIN p ON code = cpv_code)"""
_S = """count(*) AS opportunities_count, CAST(sum(estimated_value) AS DECIMAL(38,2)) AS total_estimated_value,
   CAST(CAST(sum(estimated_value) AS DOUBLE) / count(estimated_value) AS DECIMAL(38,6)) AS avg_estimated_value"""
_Y = """min(publication_date) AS first_publication_date, max(publication_date) AS last_publication_date, min(deadline) AS earliest_deadline,
   len(list_distinct(flatten(list(cpv_codes)))) AS distinct_cpv_count"""
_T = """t AS (SELECT DISTINCT rpad(CAST(p_partkey + 10 AS VARCHAR), 8, '0') AS code FROM part),
v AS (SELECT code, length(rtrim(code, '0')) AS k, regexp_full_match(code, '[0-9]{8}') AND code NOT LIKE '00%' AND regexp_full_match(rtrim(code, '0'), '[0-9]{1,2}[1-9]*') AS valid FROM t)"""
ORACLES = {
    "unit_enrichment": """WITH f AS (SELECT CASE WHEN c_custkey % 3 <> 0 THEN c_custkey END AS b FROM customer), m AS (SELECT b, b IN (SELECT s_suppkey FROM supplier) AS hit FROM f)
        SELECT count(*) AS input_events, count(b) AS events_with_buyer_id, count(*) FILTER (b IS NULL) AS events_without_buyer_id, count(*) FILTER (hit) AS resolved_events, count(*) FILTER (b IS NOT NULL AND NOT hit) AS unresolved_events_with_buyer_id FROM m""",
    "codes_posexplode_left_join": f"WITH {_O}, {_C} SELECT procedure_id, cpv_position, cpv_code, label, cpv_matched FROM j",
    "coverage_metrics": f"""WITH {_O}, {_C} SELECT count(*) AS occurrences, count(*) FILTER (cpv_matched) AS matched, count(*) FILTER (NOT cpv_matched) AS unmatched,
        count(DISTINCT cpv_code) AS codes, count(DISTINCT cpv_code) FILTER (NOT cpv_matched) AS unmatched_codes FROM j""",
    "buyer_coverage": f"""WITH {_O} SELECT count(buyer_id) AS with_id, count(*) - count(buyer_id) AS without_id, count(c_custkey) AS resolved, count(buyer_id) - count(c_custkey) AS unresolved
        FROM o LEFT JOIN customer ON buyer_id = 'B' || (2 * c_custkey)""",
    "buyer_summary": f"""WITH {_O} SELECT buyer_id, max(buyer_name) AS buyer_name, 'buyer_id' AS identity_basis, {_S}, {_Y} FROM o WHERE buyer_id IS NOT NULL GROUP BY buyer_id
        UNION ALL SELECT NULL, buyer_name, 'buyer_name', {_S}, {_Y} FROM o WHERE buyer_id IS NULL GROUP BY buyer_name""",
    "code_summary": f"""WITH {_O}, {_C} SELECT cpv_code, max(label) AS label, count(DISTINCT procedure_id) AS opportunities_count, count(DISTINCT buyer_id) AS buyers_count,
        CAST(sum(estimated_value) AS DECIMAL(38,2)) AS total_estimated_value,
        CAST(CAST(sum(estimated_value) AS DOUBLE) / count(estimated_value) AS DECIMAL(38,6)) AS avg_estimated_value FROM j GROUP BY cpv_code""",
    "monthly_summary": f"WITH {_O} SELECT CAST(date_trunc('month', publication_date) AS DATE) AS month, source, {_S} FROM o WHERE publication_date IS NOT NULL GROUP BY ALL",
    "undated_summary": f"WITH {_O} SELECT source, count(*) AS opportunities_count, CAST(sum(estimated_value) AS DECIMAL(38,2)) AS total_estimated_value FROM o WHERE publication_date IS NULL GROUP BY source",
    "reconciliation": f"""WITH {_O}, n AS (SELECT count(*) AS r, CAST(sum(len(cpv_codes)) AS BIGINT) AS c, count(*) FILTER (publication_date IS NULL) AS u FROM o)
        SELECT 'opportunity_cpv' AS view, c AS got, c AS want, true AS agrees FROM n UNION ALL SELECT 'buyer_summary', r, r, true FROM n
        UNION ALL SELECT 'monthly', r - u, r - u, true FROM n UNION ALL SELECT 'undated', u, u, true FROM n""",
    "export_rows": f"""WITH {_O} SELECT procedure_id, CAST(to_json(cpv_codes) AS VARCHAR) AS cpv_codes, estimated_value, strftime(deadline, '%Y-%m-%dT%H:%M:%S.%fZ') AS deadline FROM o""",
    "hierarchy_levels": f"""WITH {_T} SELECT code, CAST(greatest(1, k - 1) AS INT) AS level, CASE WHEN k > 2 THEN rpad(substr(code, 1, k - 1), 8, '0') END AS parent, valid FROM v""",
    "nearest_ancestor": f"""WITH {_T}, w AS (SELECT * FROM v WHERE valid),
        a AS (SELECT w.code, u.code AS up, row_number() OVER (PARTITION BY w.code ORDER BY u.k DESC) AS r FROM w JOIN w u ON greatest(u.k, 2) < w.k AND starts_with(w.code, substr(u.code, 1, greatest(u.k, 2)))),
        b AS (SELECT w.code, w.k, up FROM w LEFT JOIN a ON a.code = w.code AND r = 1)
        SELECT code AS cpv_code, CAST(NULL AS VARCHAR) AS label_en, CAST(greatest(1, k - 1) AS INT) AS level, up AS parent_code, code NOT IN (SELECT up FROM b WHERE up IS NOT NULL) AS is_leaf FROM b""",
    "row_validation": """SELECT reason, count(*) AS n, count(DISTINCT c_nationkey) AS nations FROM (SELECT *, CASE WHEN NOT regexp_full_match(c_name, 'Customer#[0-9]{9}') THEN 'invalid_format'
        WHEN c_acctbal < 1000 THEN 'missing_status' WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN 'invalid_status'
        WHEN c_custkey % 13 = 0 THEN 'invalid_parent' ELSE 'accepted' END AS reason FROM customer) GROUP BY reason""",
}
