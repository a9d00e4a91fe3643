"""Identity, decisions and open rows, over orders as procedures."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.operators import state
from noticeworks.session import table

AS_OF = datetime(1998, 1, 1, tzinfo=UTC)


def identity_waterfall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with sound and broken identities of every kind, and why they are broken."""
    o = table(spark, sf_dir, "orders")
    k, m = F.col("o_orderkey"), F.col("o_orderkey") % 9
    ref = F.concat(F.lit("https://x/"), k.cast("string"))
    event = (
        F.when(m == 0, F.concat(F.lit("placsp:notice:"), ref, F.lit("@undated")))
        .when(m == 1, F.concat(F.lit("placsp:tombstone:"), ref))
        .when(m == 2, F.concat(F.lit("placsp:tombstone-dated:-12:"), ref))
        .when(m == 3, F.concat(F.lit("placsp:tombstone-dated:1x:"), ref))
        .when(m == 4, F.concat(F.lit("placsp:notice:"), ref))
        .otherwise(F.concat(F.lit("ted:notice:"), k.cast("string")))
    )
    rows = o.select(
        event.alias("event_id"),
        F.when(m == 5, "placsp:procedure:").when(m != 6, F.concat(F.lit("placsp:procedure:"), ref)).alias("procedure_id"),
        F.when(m == 8, "ted").otherwise("placsp").alias("source"),
        F.when(m.isin(0, 4, 5, 6), "notice_snapshot").when(m.isin(1, 2, 3), "tombstone").otherwise("notice").alias("source_event_type"),
    )
    return rows.select("event_id", "source", F.coalesce(state.identity_reason(), F.lit("valid")).alias("reason"))


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    rows = o.select(
        F.col("o_orderkey").alias("procedure_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "ted").otherwise("placsp").alias("source"),
        F.lit("notice_snapshot").alias("source_event_type"),
        F.when(F.col("o_orderstatus") == "O", "PUB").when(F.col("o_orderstatus") == "F", "ADJ").when(F.col("o_orderkey") % 2 == 0, "XYZ").alias("status"),
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate").cast("timestamp")).alias("deadline"),
        (F.col("o_orderkey") % 11 == 0).alias("is_deleted"),
    )
    return rows.withColumn("decision", state.decision(AS_OF))


def decision_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _decided(spark, sf_dir)
    return rows.select("procedure_id", "decision", state.bucket(F.col("decision")).alias("bucket"))


def decision_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.decision_counts(_decided(spark, sf_dir))


def open_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = state.open_opportunities(_decided(spark, sf_dir).drop("decision"), AS_OF)
    return found


QUERIES = {"identity_waterfall": identity_waterfall, "decision_policy": decision_policy, "decision_counts": decision_counts, "open_projection": open_projection}

_D = """d AS (SELECT o_orderkey AS procedure_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'ted' ELSE 'placsp' END AS source,
   CASE WHEN o_orderstatus = 'O' THEN 'PUB' WHEN o_orderstatus = 'F' THEN 'ADJ' WHEN o_orderkey % 2 = 0 THEN 'XYZ' END AS status,
   CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS deadline, o_orderkey % 11 = 0 AS is_deleted FROM orders),
e AS (SELECT *, CASE WHEN is_deleted THEN 'deleted' WHEN deadline < TIMESTAMP '1998-01-01' THEN 'deadline_passed'
   WHEN source = 'placsp' AND status = 'PUB' THEN 'open' WHEN source = 'placsp' AND status = 'ADJ' THEN 'status_closed'
   WHEN source <> 'placsp' AND status IS NULL AND deadline >= TIMESTAMP '1998-01-01' THEN 'open' ELSE 'insufficient_evidence' END AS decision FROM d)"""
_B = "CASE decision WHEN 'open' THEN 'open' WHEN 'deleted' THEN 'excluded_deleted' WHEN 'insufficient_evidence' THEN 'excluded_insufficient_evidence' ELSE 'excluded_not_actionable' END AS bucket"
ORACLES = {
    "identity_waterfall": """
        SELECT CASE m WHEN 0 THEN 'placsp:notice:' || ref || '@undated' WHEN 1 THEN 'placsp:tombstone:' || ref WHEN 2 THEN 'placsp:tombstone-dated:-12:' || ref
                      WHEN 3 THEN 'placsp:tombstone-dated:1x:' || ref WHEN 4 THEN 'placsp:notice:' || ref ELSE 'ted:notice:' || o_orderkey END AS event_id,
               CASE WHEN m = 8 THEN 'ted' ELSE 'placsp' END AS source,
               CASE WHEN m IN (0, 1, 2, 8) THEN 'valid' WHEN m IN (3, 4) THEN 'event_procedure_identity_mismatch'
                    WHEN m IN (5, 6) THEN 'missing_or_invalid_procedure_id' ELSE 'unsupported_placsp_event_type' END AS reason
        FROM (SELECT o_orderkey, o_orderkey % 9 AS m, 'https://x/' || o_orderkey AS ref FROM orders)""",
    "decision_policy": f"WITH {_D} SELECT procedure_id, decision, {_B} FROM e",
    "decision_counts": f"""WITH {_D}, a AS (SELECT unnest(['open', 'deleted', 'deadline_passed', 'status_closed', 'insufficient_evidence']) AS decision)
        SELECT decision, {_B}, (SELECT count(*) FROM e WHERE e.decision = a.decision) AS n FROM a""",
    "open_projection": f"WITH {_D} SELECT procedure_id, source, status, deadline FROM e WHERE decision = 'open'",
}
