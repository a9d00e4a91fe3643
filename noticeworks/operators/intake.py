"""From raw rows to accepted records: acceptance, snapshots, flattening, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.functions import jsonx, money, text
from noticeworks.operators.events import _once

SOURCES = ("ted", "placsp", "boe")


#: Half of a surrogate pair, escaped, without the other: text that can't be encoded. U+FFFD can.
_HALF_PAIR = r"(?i)\\ud[89ab][0-9a-f]{2}(?!\\ud[c-f])|(?<!\\ud[89ab][0-9a-f]{2})\\ud[c-f][0-9a-f]{2}"


_IDS, _TITLES = ("ND", "notice_id", "tender_no", "item_id", "identificador"), ("TI", "title", "titulo")


def rejection_reason(source: Column, payload: Column) -> Column:
    """Why a candidate isn't accepted, by the first rule broken; null if it is.

    Rules in order: valid unicode, a known source, the payload's own source, an id, a title. The
    reasons are fixed values.
    """
    names = ("_source", "source", *_IDS, *_TITLES)

    def asked(f: Column) -> Column:
        first = lambda of: jsonx.first_value(*(f[n] for n in of))
        own = F.lower(F.coalesce(jsonx.as_text(first(("_source", "source"))), source))
        title = F.coalesce(money.let(first(_TITLES), lambda x: jsonx.shown_text(x)), F.lit(""))
        return F.struct(own.alias("own"), jsonx.as_text(first(_IDS)).alias("id"), title.alias("title"))

    def judged(r: Column) -> Column:
        return (
            F.when(~F.coalesce(source.isin(*SOURCES) & r["own"].isin(*SOURCES), F.lit(False)), "unsupported_source")
            .when(r["own"] != source, "source_mismatch")
            .when(r["id"].isNull(), "missing_tender_id")
            .when(r["title"] == "", "missing_title")
        )

    halves = F.replace(payload, F.lit("\\\\"), F.lit(""))  # an escaped backslash escapes nothing after it
    found = money.let(jsonx.fields(jsonx.payload(payload), names), lambda f: money.let(asked(f), judged))
    return F.when(~F.is_valid_utf8(payload) | halves.rlike(_HALF_PAIR), "invalid_unicode_payload").otherwise(found)


def judged(rows: DataFrame) -> DataFrame:
    """Candidates (source, payload_json, ...) with their rejection_reason, each judged once."""
    return _once(rows, rejection_reason=rejection_reason(F.col("source"), F.col("payload_json")))


def accepted_and_rejected(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates (source, payload_json, ...) split by rejection_reason."""
    found = judged(rows)
    return found.where("rejection_reason IS NULL").drop("rejection_reason"), found.where("rejection_reason IS NOT NULL")


def latest_snapshots(files: DataFrame, keys: list[str], retrieved: str, digest: str) -> DataFrame:
    """The latest retrieval of each partition; ``tie`` marks several of different content then."""
    newest = files.groupBy(*keys).agg(F.max(retrieved).alias("_at"), F.max(F.struct(F.col(retrieved), *[c for c in files.columns if c != retrieved])).alias("_r"))
    at_newest = files.join(newest.select(*(F.col(k).alias(f"_{k}") for k in keys), "_at"), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col(retrieved) == F.col("_at")])
    ties = at_newest.groupBy(*keys).agg((F.count_distinct(digest) > 1).alias("tie"))
    return newest.select("_r.*").join(ties, [*keys])


def windows(spark: SparkSession, start: str, end: str, days: int) -> DataFrame:
    """Inclusive, contiguous windows of at most so many days."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    starts = spark.range(1).select(F.explode(F.sequence(first, last, F.expr(f"INTERVAL {int(days)} DAYS"))).alias("window_start"))
    return starts.select("window_start", F.least(F.date_add("window_start", days - 1), last).alias("window_end"))


def months(spark: SparkSession, start: str, end: str) -> DataFrame:
    """First and last day of each month touched."""
    first = F.trunc(F.lit(start).cast("date"), "month")
    return spark.range(1).select(F.explode(F.sequence(first, F.lit(end).cast("date"), F.expr("INTERVAL 1 MONTH"))).alias("month")).select("month", F.last_day("month").alias("month_end"))


def gazette_items(days: DataFrame, body: str = "body", sections: tuple[str, ...] = ()) -> DataFrame:
    """Items of a gazette's daily summary: sections, departments, headings and items are single
    objects or lists of them; the five levels become rows."""

    def listed(v: Column, name: str) -> Column:
        inner = F.try_variant_get(v, f"$.{name}", "variant")
        many = F.try_variant_get(v, f"$.{name}", "array<variant>")
        return F.coalesce(many, F.when(inner.isNotNull(), F.array(inner)), F.array().cast("array<variant>"))

    def name_of(v: str, key: str) -> Column:
        return F.try_variant_get(F.col(v), f"$.{key}", "string")

    rows = days.select(*(c for c in days.columns if c != body), F.try_parse_json(body).alias("_d"))
    keep = [c for c in days.columns if c != body]
    rows = rows.select(*keep, F.explode(listed(F.try_variant_get(F.col("_d"), "$.data.sumario", "variant"), "diario")).alias("_p"))
    rows = rows.select(*keep, F.explode(listed(F.col("_p"), "seccion")).alias("_s"))
    rows = rows.withColumn("section", name_of("_s", "codigo"))
    if sections:
        rows = rows.where(F.col("section").isin(*sections))
    rows = rows.select(*keep, "section", F.explode(listed(F.col("_s"), "departamento")).alias("_b"))
    rows = rows.withColumn("department", name_of("_b", "nombre"))
    # items stand under headings or directly under the department
    under = F.concat(F.array(F.col("_b")), listed(F.col("_b"), "epigrafe"))
    rows = rows.select(*keep, "section", "department", F.explode(under).alias("_e"))
    rows = rows.select(*keep, "section", "department", F.explode(listed(F.col("_e"), "item")).alias("_i"))
    return rows.select(*keep, "section", "department", name_of("_i", "identificador").alias("item_id"), name_of("_i", "titulo").alias("title"), name_of("_i", "url_html").alias("url"))


def unit_rejection(scope: str, code: str = "code") -> Column:
    """Why a unit's row isn't accepted, by the first rule broken; null if it is.

    Columns: code, name, status, scope, hierarchy, parent, principal, valid_from.
    """
    c = {n: text.blank_to_null(F.col(n)) for n in (code, "name", "status", "scope", "hierarchy", "parent", "principal", "valid_from")}
    unit, number = r"^[A-Z][A-Z0-9][0-9]{7}$", "^[0-9]+$"
    rules = [
        (c[code].isNull(), "missing_dir3_code"),
        (~c[code].rlike(unit), "invalid_dir3_code_format"),
        (c["name"].isNull(), "missing_name"),
        (c["status"].isNull(), "missing_status"),
        (~c["status"].isin("V", "E", "A", "T"), "invalid_status"),
        (~F.coalesce(c["scope"] == scope, F.lit(False)), "nivel_admin_mismatch"),
        (c["hierarchy"].isNull(), "missing_hierarchy_level"),
        (~c["hierarchy"].rlike(number), "invalid_hierarchy_level"),
        (c["parent"].isNull(), "missing_parent_dir3_code"),
        (~c["parent"].rlike(unit), "invalid_parent_dir3_code"),
        (c["principal"].isNull(), "missing_principal_dir3_code"),
        (~c["principal"].rlike(unit), "invalid_principal_dir3_code"),
        (c["valid_from"].isNotNull() & ~c["valid_from"].rlike(r"^(0[1-9]|[12][0-9]|3[01])/(0[1-9]|1[0-2])/[0-9]{2}$"), "invalid_valid_from_date"),
    ]
    found = F.lit(None).cast("string")
    for broken, reason in reversed(rules):
        found = F.when(broken, reason).otherwise(found)
    return found


def unresolved_parents(units: DataFrame, code: str = "code", parent: str = "parent") -> DataFrame:
    """Distinct parents that are no unit."""
    known = units.select(F.col(code).alias("_known"))
    return units.select(parent).where(F.col(parent).isNotNull()).distinct().join(known, F.col(parent) == F.col("_known"), "left_anti")
