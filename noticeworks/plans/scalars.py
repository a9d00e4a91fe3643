"""Scalar functions over events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.functions import jsonx, money, timex
from noticeworks.session import table


def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", jsonx.payload(F.col("props")).alias("v"))
    return e.select("event_id", jsonx.field(F.col("v"), "k").alias("k"), jsonx.field(F.col("v"), "missing").alias("missing"), jsonx.schema_of(F.col("v"), "k").isNotNull().alias("has_k"))


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    text = F.concat(
        F.lit('{"a":'), F.when(k % 4 == 0, '""').when(k % 4 == 1, "0").when(k % 4 == 2, "[]").otherwise(F.concat(F.lit('"'), k.cast("string"), F.lit('"'))),
        F.lit(',"b":'), F.when(k % 3 == 0, "null").otherwise('" x "'), F.lit(',"c":["y"," y","'), F.when(k % 5 == 0, "y").otherwise("z"), F.lit('"]}'),
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("text"), jsonx.payload(text).alias("v"))


def or_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first truthy and the first given of two fields, and whether one is there at all."""
    v = F.col("v")
    return _payloads(spark, sf_dir).select("event_id", jsonx.first_truthy(v, "a", "b").alias("truthy"), jsonx.first_given(v, "b", "a").alias("given"), jsonx.present(F.col("text"), "b").alias("present"))


def single_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    return _payloads(spark, sf_dir).select("event_id", jsonx.single_value(v, "c").alias("one"), F.array_join(jsonx.codes(v, "c"), "|").alias("codes"), jsonx.localized(v, "c").alias("first"))


def _amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, k = F.col("o_totalprice").cast("decimal(20,2)"), F.col("o_orderkey") % 6
    text = price.cast("string")
    spanish = F.replace(text, F.lit("."), F.lit(","))
    grouped = F.concat(F.lit("1.234."), F.lpad((F.col("o_orderkey") % 1000).cast("string"), 3, "0"))
    shown = (
        F.when(k == 0, text).when(k == 1, spanish).when(k == 2, F.concat(grouped, F.lit(",50"))).when(k == 3, grouped)
        .when(k == 4, F.concat(text, F.lit("5"))).otherwise(F.concat(F.lit("-"), text))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", shown.alias("t"))


def amount_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _amounts(spark, sf_dir).select("o_orderkey", money.amount_text(F.col("t")).alias("amount"), F.round(money.lenient_amount(F.col("t")), 3).alias("lenient"))


def exact_decimal_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _amounts(spark, sf_dir).withColumn("x", money.exact_amount(F.col("t")))
    return found.select("o_orderkey", F.col("x.value").alias("value"), F.col("x.error").alias("error"))


def aware_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, m = table(spark, sf_dir, "events"), F.col("event_id") % 5
    day = F.date_format("ts", "yyyy-MM-dd")
    text = (
        F.when(m == 0, F.concat(day, F.lit("T10:20:30Z"))).when(m == 1, F.concat(day, F.lit("T10:20:30.123456+02:00"))).when(m == 2, F.concat(day, F.lit("T10:20:30")))
        .when(m == 3, F.concat(day, F.lit("T10:20z"))).otherwise(F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("T102030-0130")))
    )
    found = e.select("event_id", timex.aware_instant(text).alias("at"), timex.lenient_date(text).alias("day"))
    return found.select("event_id", F.unix_micros("at").alias("micros"), "day")


def iso_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", "ts")).otherwise(F.col("ts")).cast("timestamp").alias("at"))
    return e.select("event_id", timex.iso_marker(F.col("at")).alias("marker"), F.unix_micros("at").alias("micros"))


QUERIES = {f.__name__: f for f in (json_fields, or_chain, single_value, amount_normalize, exact_decimal_issues, aware_instant, iso_marker)}

_K = "CAST(json_extract_string(props, '$.k') AS INT)"
_A = """a AS (SELECT o_orderkey, o_orderkey % 6 AS k, CAST(o_totalprice AS DECIMAL(20,2)) AS p, lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') AS g FROM orders)"""
ORACLES = {
    "json_fields": "SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing, true AS has_k FROM events",
    "or_chain": f"""SELECT event_id, CASE WHEN k % 4 = 3 THEN CAST(k AS VARCHAR) WHEN k % 3 <> 0 THEN ' x ' END AS truthy,
        CASE WHEN k % 3 <> 0 THEN ' x ' ELSE CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '[]' ELSE CAST(k AS VARCHAR) END END AS given, true AS present
        FROM (SELECT event_id, {_K} AS k FROM events)""",
    "single_value": f"""SELECT event_id, CASE WHEN {_K} % 5 = 0 THEN 'y' END AS one, CASE WHEN {_K} % 5 = 0 THEN 'y' ELSE 'y|z' END AS codes, 'y' AS first FROM events""",
    "amount_normalize": f"""WITH {_A} SELECT o_orderkey, CASE k WHEN 0 THEN CAST(p AS VARCHAR) WHEN 1 THEN CAST(p AS VARCHAR) WHEN 2 THEN '1234' || g || '.50' WHEN 3 THEN '1234' || g
          WHEN 4 THEN p || '5' ELSE '-' || p END AS amount,
        CASE k WHEN 0 THEN CAST(p AS DOUBLE) WHEN 1 THEN CAST(p AS DOUBLE) WHEN 2 THEN CAST('1234' || g || '.50' AS DOUBLE) WHEN 3 THEN CAST('1234' || g AS DOUBLE)
          WHEN 4 THEN round(CAST(p || '5' AS DOUBLE), 3) END AS lenient FROM a""",
    "exact_decimal_issues": f"""WITH {_A} SELECT o_orderkey, CAST(CASE k WHEN 0 THEN p WHEN 1 THEN p WHEN 2 THEN CAST('1234' || g || '.50' AS DECIMAL(20,2)) WHEN 3 THEN CAST('1234' || g AS DECIMAL(20,2)) END AS DECIMAL(20,2)) AS value,
        CASE WHEN k = 4 THEN 'too_many_fraction_digits' END AS error FROM a""",
    "aware_instant": """SELECT event_id, CASE event_id % 5 WHEN 0 THEN epoch_us(d + INTERVAL 37230 SECOND) WHEN 1 THEN epoch_us(d + INTERVAL 30030 SECOND) + 123456
          WHEN 3 THEN epoch_us(d + INTERVAL 37200 SECOND) WHEN 4 THEN epoch_us(d + INTERVAL 42630 SECOND) END AS micros,
        CASE WHEN event_id % 5 <> 4 THEN CAST(d AS DATE) END AS day FROM (SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS d FROM events)""",
    "iso_marker": """SELECT event_id, CASE WHEN epoch_us(t) % 1000000 = 0 THEN strftime(t, '%Y-%m-%dT%H:%M:%S+00:00') ELSE strftime(t, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS marker, epoch_us(t) AS micros
        FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE ts END AS t FROM events)""",
}
