"""Typed events from payloads made of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.operators import intake, state
from noticeworks.operators.events import procurement_events
from noticeworks.session import spread, table
from noticeworks.sources import raw


def _text(c):
    return c.cast("string")


def payloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Accepted records and deletes, with what real payloads hold: brackets in titles, several
    amounts, numbers without their text, exponents, padded instants, replacement characters."""
    o, k = spread(table(spark, sf_dir, "orders")), F.col("o_orderkey")
    money = F.when(k % 4 == 0, "1.5e3").otherwise(_text(F.col("o_totalprice").cast("decimal(20,2)")))
    title = F.concat(F.when(k % 5 == 0, "[Anulado] t").otherwise("t"), _text(F.col("o_custkey")))
    ted = F.struct(
        _text(k).alias("ND"), F.create_map(F.lit("eng"), F.lit("x"), F.lit("spa"), title).alias("TI"), F.array(F.lit("72000000"), F.lit(" 72000000 ")).alias("PC"),
        F.create_map(F.lit("spa"), F.lit("a \ufffd b")).alias("description-glo"), F.when(k % 3 == 0, F.array(F.lit("7,25"))).alias("estimated-value-lot"),
        money.alias("amount"), F.lit("ESP").alias("CY"), F.date_format("o_orderdate", "yyyy-MM-dd'Z'").alias("PD"), F.lit("ted").alias("_source"),
    )
    c, n = spread(table(spark, sf_dir, "customer")), F.col("c_custkey")
    euros = F.abs("c_acctbal").cast("decimal(20,2)")
    overall = n + F.lit(0.5)
    placsp = F.struct(
        F.concat(F.lit("https://x/"), _text(n)).alias("atom_id"), _text(n).alias("tender_no"), F.col("c_name").alias("title"),
        F.when(n % 3 != 0, " 2024-01-02T03:04:05+01:00\n").alias("updated"), F.lit("PUB").alias("status_code"),
        euros.cast("double").alias("amount_tax_exclusive"), F.when(n % 5 != 0, _text(euros)).alias("amount_tax_exclusive_raw"), F.lit("EUR").alias("amount_tax_exclusive_currency"),
        F.when(n % 2 == 0, overall).alias("amount_estimated_overall"), F.when(n % 4 == 0, F.concat(_text(n), F.lit(",50"))).alias("amount_estimated_overall_raw"),
        F.when(n % 2 == 0, "USD").alias("amount_estimated_overall_currency"), F.array(F.col("c_mktsegment")).alias("cpv"),
    )
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    records = o.select(F.lit("ted").alias("source"), F.to_json(ted).alias("payload_json"), at.alias("retrieved_at"))
    # every customer is observed twice, an hour apart
    twice = c.select(F.lit("placsp").alias("source"), F.to_json(placsp).alias("payload_json"), F.explode(F.array(at, at + F.expr("INTERVAL 1 HOUR"))).alias("retrieved_at"))
    s = spread(table(spark, sf_dir, "supplier"))
    gone = s.select(F.concat(F.lit("https://x/"), _text(F.col("s_suppkey"))).alias("ref"), F.when(F.col("s_suppkey") % 2 == 0, "2024-01-03T00:00:00Z").alias("deleted_at"), at.alias("retrieved_at"))
    boe = F.struct(F.concat(F.lit("B"), _text(F.col("s_suppkey"))).alias("identificador"), F.lit("").alias("title"), F.col("s_name").alias("titulo"), F.lit("2024-01-05T10:00").alias("publication_date"))
    items = s.select(F.lit("boe").alias("source"), F.to_json(boe).alias("payload_json"), at.alias("retrieved_at"))
    return records.unionByName(twice).unionByName(items), gone


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = procurement_events(*payloads(spark, sf_dir))
    first = state.first_observation(found, "event_id", F.struct("ingested_at"))
    shown = ["event_id", "procedure_id", "source", "source_event_type", "title", "description", "estimated_value", "currency", "publication_date", "status", "country"]
    return first.select(*shown, F.array_join("cpv_codes", ",").alias("cpv_codes"), F.unix_micros("source_updated_at").alias("updated"), F.unix_micros("ingested_at").alias("ingested"))


def acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with every fault, by reason."""
    k = F.col("c_custkey") % 6
    payload = F.when(k == 0, '{"ND": "1", "TI": {"spa": "t"}}').when(k == 1, '{"ND": "1", "TI": ""}').when(k == 2, '{"TI": "t"}').when(k == 3, '{"_source": "boe", "ND": "1", "TI": "t"}').otherwise('{"ND": 5, "title": ["", "x"]}')
    rows = spread(table(spark, sf_dir, "customer")).select(F.when(k == 4, "other").otherwise("ted").alias("source"), payload.alias("payload_json"))
    reason = F.coalesce(F.col("rejection_reason"), F.lit("accepted"))
    return intake.judged(rows).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def ingestion_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as records of three sources, some of them faulty, and suppliers as deletes: what
    was parsed, accepted and rejected of each source."""
    k = F.col("c_custkey")
    source = F.when(k % 3 == 0, "ted").when(k % 3 == 1, "placsp").otherwise("boe")
    payload = F.when(k % 7 == 0, '{"ND": "1", "title": ""}').when(k % 11 == 0, '{"title": "t"}').otherwise('{"ND": "1", "tender_no": "1", "item_id": "1", "title": "t"}')
    reason = intake.rejection_reason(F.col("source"), F.col("payload_json"))
    rows = spread(table(spark, sf_dir, "customer")).select(source.alias("source"), payload.alias("payload_json")).withColumn("reason", reason)
    kind = F.when(F.col("reason").isNull(), "record").otherwise("rejection")
    judged = rows.select("source", kind.alias("kind"), F.when(F.col("reason").isNotNull(), "record").alias("scope"))
    deletes = table(spark, sf_dir, "supplier").select(F.lit("placsp").alias("source"), F.lit("tombstone").alias("kind"), F.lit(None).cast("string").alias("scope"))
    return raw.accounting(judged.unionByName(deletes), "source")


def extraction_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intake.windows(spark, "2024-01-01", "2024-03-05", 7).unionByName(intake.months(spark, "2024-01-15", "2024-03-05").toDF("window_start", "window_end"))


def unresolved_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("code"), (F.col("p_partkey") * 2 % 3001).alias("parent"))
    return intake.unresolved_parents(units)


QUERIES = {"silver_events": silver_events, "acceptance": acceptance, "ingestion_by_source": ingestion_by_source, "extraction_windows": extraction_windows, "unresolved_parents": unresolved_parents}

_NO = "CAST(NULL AS VARCHAR)"
ORACLES = {
    "silver_events": f"""
        SELECT 'ted:notice:' || o_orderkey AS event_id, {_NO} AS procedure_id, 'ted' AS source, 'notice' AS source_event_type,
               CASE WHEN o_orderkey % 5 = 0 THEN '[Anulado] t' ELSE 't' END || o_custkey AS title, 'a ' || chr(65533) || ' b' AS description,
               CAST(CASE WHEN o_orderkey % 3 = 0 THEN 7.25 WHEN o_orderkey % 4 = 0 THEN 1500 ELSE CAST(o_totalprice AS DECIMAL(20,2)) END AS DECIMAL(20,2)) AS estimated_value,
               'EUR' AS currency, CAST(o_orderdate AS DATE) AS publication_date, {_NO} AS status, 'ES' AS country,
               '72000000' AS cpv_codes, CAST(NULL AS BIGINT) AS updated, epoch_us(TIMESTAMP '2024-02-01') AS ingested FROM orders
        UNION ALL SELECT 'placsp:notice:https://x/' || c_custkey || '@' || CASE WHEN c_custkey % 3 <> 0 THEN '2024-01-02T02:04:05+00:00' ELSE 'undated' END, 'placsp:procedure:https://x/' || c_custkey,
               'placsp', 'notice_snapshot', c_name, NULL, CASE WHEN c_custkey % 2 = 0 THEN c_custkey + 0.5 ELSE CAST(abs(c_acctbal) AS DECIMAL(20,2)) END,
               CASE WHEN c_custkey % 2 = 0 THEN 'USD' ELSE 'EUR' END, NULL, 'PUB', 'ES', c_mktsegment,
               CASE WHEN c_custkey % 3 <> 0 THEN epoch_us(TIMESTAMP '2024-01-02 02:04:05') END, epoch_us(TIMESTAMP '2024-02-01') FROM customer
        UNION ALL SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'placsp:tombstone-dated:' || epoch_us(TIMESTAMP '2024-01-03') || ':https://x/' || s_suppkey ELSE 'placsp:tombstone:https://x/' || s_suppkey END,
               'placsp:procedure:https://x/' || s_suppkey, 'placsp', 'tombstone', NULL, NULL, NULL, NULL, NULL, NULL, NULL, '',
               CASE WHEN s_suppkey % 2 = 0 THEN epoch_us(TIMESTAMP '2024-01-03') END, epoch_us(TIMESTAMP '2024-02-01') FROM supplier
        UNION ALL SELECT 'boe:notice:B' || s_suppkey, NULL, 'boe', 'notice', s_name, NULL, NULL, NULL, DATE '2024-01-05', NULL, 'ES', '', NULL, epoch_us(TIMESTAMP '2024-02-01') FROM supplier""",
    "ingestion_by_source": """WITH r AS (SELECT CASE c_custkey % 3 WHEN 0 THEN 'ted' WHEN 1 THEN 'placsp' ELSE 'boe' END AS source, c_custkey % 7 = 0 OR c_custkey % 11 = 0 AS bad FROM customer)
        SELECT source, count(*) AS parsed, count(*) FILTER (NOT bad) AS accepted, count(*) FILTER (bad) AS rejected, 0::BIGINT AS document_errors, 0::BIGINT AS control_errors,
            CASE source WHEN 'placsp' THEN (SELECT count(*) FROM supplier) ELSE 0 END AS tombstones, NOT bool_or(bad) AS passed FROM r GROUP BY source""",
    "acceptance": """SELECT CASE c_custkey % 6 WHEN 0 THEN 'accepted' WHEN 1 THEN 'missing_title' WHEN 2 THEN 'missing_tender_id' WHEN 3 THEN 'source_mismatch' WHEN 4 THEN 'unsupported_source'
        ELSE 'accepted' END AS reason, count(*) AS n FROM customer GROUP BY 1""",
    "extraction_windows": """SELECT CAST(d AS DATE) AS window_start, CAST(least(d + INTERVAL 6 DAY, TIMESTAMP '2024-03-05') AS DATE) AS window_end FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-03-06', INTERVAL 7 DAY) AS t(d)
        UNION ALL SELECT CAST(d AS DATE), last_day(d) FROM range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-03-06', INTERVAL 1 MONTH) AS t(d)""",
    "unresolved_parents": "SELECT DISTINCT p_partkey * 2 % 3001 AS parent FROM part WHERE p_partkey * 2 % 3001 NOT IN (SELECT p_partkey FROM part)",
}
