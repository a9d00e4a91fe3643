"""Builds: what the outermost caller runs, with checks, datasets and a manifest."""

from __future__ import annotations

import functools
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.operators import enrich, intake, legacy, state
from noticeworks.operators.contracts import EVENT_FIELDS, ContractError, assert_key, assert_row_count, check, read_checked
from noticeworks.operators.events import procurement_events
from noticeworks.sources import dimensions, exports, files, publication

#: Version of the datasets' and manifests' layout.
FORMAT = 1


def build_events(records: DataFrame, tombstones: DataFrame, provenance: list[str], path: str) -> int:
    """Events without repeated observations, at ``path``, in order of their ids. Differing contents
    of one event fail, naming its first observation by ``provenance``."""
    found = procurement_events(records, tombstones)
    fields = [f.name for f in EVENT_FIELDS if f.name not in ("event_id", "ingested_at")]
    if bad := state.collisions(found, "event_id", fields).orderBy("event_id").limit(5).collect():
        seen = found.where(F.col("event_id").isin([r.event_id for r in bad]))
        firsts = {r.event_id: r.first.asDict() for r in seen.groupBy("event_id").agg(F.min(F.struct("ingested_at", *provenance)).alias("first")).collect()}
        raise ContractError(f"events with different contents: {[(r.event_id, r.fields, firsts[r.event_id]) for r in bad]}")
    first = state.first_observation(found, "event_id", F.struct("ingested_at", *provenance))
    exports.write_parquet(first, path, ("event_id",), whole=True)
    return check(first.sparkSession.read.parquet(path), EVENT_FIELDS)


def build_current_state(spark: SparkSession, events_path: str, out: str) -> dict:
    """Current state and its issues below ``out``, with a manifest beside them."""
    events = read_checked(spark, events_path, EVENT_FIELDS)
    assert_key(events, "event_id")
    current, issues = state.current_state(events)
    exports.write_parquet(current, f"{out}/current_state", ("procedure_id",))
    exports.write_parquet(issues, f"{out}/current_state_issues")
    counts = {name: spark.read.parquet(f"{out}/{name}").count() for name in ("current_state", "current_state_issues")}
    manifest = {"format_version": FORMAT, "events": events_path, "rows": counts}
    files.write_document(spark, f"{out}/current_state_manifest.json", manifest)
    return manifest


def build_gold(spark: SparkSession, events_path: str, out: str, as_of: datetime | None, codes: DataFrame | None = None, units: DataFrame | None = None) -> dict:
    """Current state, its issues, open opportunities, their codes and their buyers' units below
    ``out``, with manifests beside them; the last one is returned.

    Codes and units are joined where their dimensions are given. An opportunity that lists a
    code twice fails the build with codes, as its facts would count twice.
    """
    rows = build_current_state(spark, events_path, out)["rows"]
    current = spark.read.parquet(f"{out}/current_state")
    opened, counts = state.open_opportunities(current, as_of)
    exports.write_parquet(opened, f"{out}/open_opportunities", ("procedure_id",))
    opened = spark.read.parquet(f"{out}/open_opportunities")
    decisions = {r.decision: r.n for r in counts.collect()}
    manifest = {"format_version": FORMAT, "as_of": as_of.isoformat() if as_of else None, "decisions": decisions, "issues": rows["current_state_issues"], "open": opened.count()}
    if sum(decisions.values()) != rows["current_state"] or manifest["open"] != decisions["open"]:
        raise ContractError(f"rows unaccounted for: {manifest}")
    if codes is not None:
        assert_key(codes, "cpv_code")
        if twice := enrich.repeated_codes(opened).orderBy("procedure_id").limit(5).collect():
            raise ContractError(f"codes listed twice: {[(r.procedure_id, r.cpv_codes) for r in twice]}")
        exploded = enrich.exploded_codes(opened)
        coded = enrich.with_dimension(exploded, enrich.dimension(codes.withColumnRenamed("cpv_code", "_code")), "cpv_code", "_code", "cpv_matched")
        exports.write_parquet(coded, f"{out}/cpv_enriched", ("procedure_id", "cpv_position"))
        written = spark.read.parquet(f"{out}/cpv_enriched")
        expected = opened.agg(F.coalesce(F.sum(F.size("cpv_codes")), F.lit(0))).first()[0]
        assert_row_count(written, expected, "the code dimension")
        manifest["codes"] = enrich.code_coverage(written).first().asDict()
    if units is not None:
        exports.write_parquet(with_units(opened, units), f"{out}/buyer_enriched", ("procedure_id",))
        written = spark.read.parquet(f"{out}/buyer_enriched")
        assert_row_count(written, manifest["open"], "the unit dimension")
        manifest["units"] = enrich.unit_coverage(written).first().asDict() | {"dimension_rows": units.count()}
    files.write_document(spark, f"{out}/gold_manifest.json", manifest)
    return manifest


#: Fixed: the columns of a unit that its buyer's facts get, under these names.
UNIT_FIELDS = {
    "name": "buyer_dir3_name", "scope": "buyer_dir3_scope", "hierarchy": "buyer_dir3_hierarchy_level", "parent": "buyer_dir3_parent_code", "principal": "buyer_dir3_principal_code",
    "status": "buyer_dir3_status", "nif": "buyer_dir3_nif",
}


def with_units(events: DataFrame, units: DataFrame) -> DataFrame:
    """events with buyer_dir3_matched and their buyers' unit; all are kept, each once. The units'
    key is checked."""
    assert_key(units, "code")
    dim = enrich.dimension(units.select("code", *(F.col(c).alias(name) for c, name in UNIT_FIELDS.items())))
    joined = enrich.with_dimension(events, dim, "buyer_id", "code", "buyer_dir3_matched")
    return joined.select(*events.columns, "buyer_dir3_matched", *UNIT_FIELDS.values())


def publish_gold(spark: SparkSession, events_path: str, out: str, as_of: datetime | None, codes: DataFrame | None = None, units: DataFrame | None = None) -> dict:
    """``build_gold`` in a folder of its own, which is published when all of it is there."""
    with publication.publishing(spark, out) as folder:
        return build_gold(spark, events_path, folder, as_of, codes, units)


def resolve_code_dimension(spark: SparkSession, explicit: str | None = None, built: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """The code dimension: a Parquet named for this run, else the one built before, else built
    from the vocabulary; without any of them an error. Its key is checked."""
    if explicit is not None:
        found = spark.read.parquet(explicit)
    elif built is not None and files.exists(spark, built):
        found = spark.read.parquet(built)
    elif vocabulary is not None and files.exists(spark, vocabulary):
        found = dimensions.read_code_dimension(spark, vocabulary)
    else:
        raise ContractError(f"no code dimension at {explicit}, {built} or {vocabulary}")
    assert_key(found, "cpv_code")
    return found.orderBy("cpv_code")


def resolve_unit_dimension(spark: SparkSession, built: str | None) -> DataFrame | None:
    """The units' dimension, which a build can do without."""
    if built is None or not files.exists(spark, built):
        return None
    found = spark.read.parquet(built)
    assert_key(found, "code")
    return found


def build_units(sheets: dict[str, DataFrame], out: str) -> dict:
    """Units of all scopes (scope to sheet rows) as one dimension below ``out``, in order of code.

    A code in two scopes fails. The manifest counts what each scope accepted and rejected, by
    reason, the units of each status, and parents that are no units.
    """
    parts = {scope: dimensions.units(rows, scope) for scope, rows in sheets.items()}
    good, bad = (functools.reduce(DataFrame.unionByName, [p[i].withColumn("_of", F.lit(scope)) for scope, p in parts.items()]) for i in (0, 1))
    assert_key(good, "code", 10)
    spark = good.sparkSession
    exports.write_parquet(good.drop("_of").orderBy("code"), f"{out}/units")
    reasons = {}
    for r in bad.groupBy("_of", "rejection_reason").agg(F.count("*").alias("n")).collect():
        reasons.setdefault(r["_of"], {})[r["rejection_reason"]] = r["n"]
    done = spark.read.parquet(f"{out}/units")
    by = lambda c: {r[c]: r["n"] for r in done.groupBy(c).agg(F.count("*").alias("n")).collect()}
    accepted = by("scope")
    manifest = {
        "dimension": "units",
        "format_version": FORMAT,
        "row_count": sum(accepted.values()),
        "status_counts": by("status"),
        "parents_unresolved": intake.unresolved_parents(done).count(),
        "scopes": {s: {"accepted": accepted.get(s, 0), "rejected": sum(reasons.get(s, {}).values()), "rejection_reasons": reasons.get(s, {})} for s in sheets},
    }
    files.write_document(spark, f"{out}/units_manifest.json", manifest)
    return manifest


#: The types of the views, by name and place; fixed, as exports and readers rely on them.
VIEW_TYPES = {
    "opportunity_cpv": "procedure_id string, source string, buyer_id string, publication_date date, estimated_value decimal(20,2), currency string, cpv_position int, cpv_code string, "
    "cpv_matched boolean, label_es string, label_en string, level tinyint, parent_code string, is_leaf boolean",
    "buyer_summary": "buyer_id string, buyer_name string, identity_basis string, opportunities_count bigint, total_estimated_value decimal(38,2), avg_estimated_value decimal(38,6), "
    "first_publication_date date, last_publication_date date, earliest_deadline timestamp, distinct_cpv_count bigint",
    "cpv_summary": "cpv_code string, label string, opportunities_count bigint, buyers_count bigint, total_estimated_value decimal(38,2), avg_estimated_value decimal(38,6)",
    "opportunities_monthly": "month date, source string, opportunities_count bigint, total_estimated_value decimal(38,2), avg_estimated_value decimal(38,6)",
    "opportunities_without_publication_date": "source string, opportunities_count bigint, total_estimated_value decimal(38,2)",
}


def check_views(views: dict[str, DataFrame]) -> None:
    """Names, order and types of the columns of every view that has a contract."""
    for name, wanted in VIEW_TYPES.items():
        found = [(c, kind) for c, kind in views[name].dtypes]
        if found != [tuple(x.split(" ", 1)) for x in wanted.split(", ")]:
            raise ContractError(f"{name} has {found}, not {wanted}")


def register_views(spark: SparkSession, gold: str, codes: DataFrame | None = None) -> dict[str, DataFrame]:
    """Views over a gold folder, in order of dependency, under their export names.

    The base view keeps the contract's names, order, types and key, and the views' totals agree
    with it, or nothing is registered. Codes are counted from 0 in their view; without a code
    dimension all are unmatched.
    """
    opened = spark.read.parquet(f"{gold}/open_opportunities")
    check(opened, tuple(f for f in EVENT_FIELDS if f.name not in ("source_event_type",)))
    assert_key(opened, "procedure_id")
    dim = codes if codes is not None else dimensions.empty_code_dimension(spark)
    assert_key(dim, "cpv_code")
    attributes = ("label_es", "label_en", "level", "parent_code", "is_leaf")
    exploded = enrich.exploded_codes(opened).withColumn("cpv_position", F.col("cpv_position") - 1)
    joined = enrich.with_dimension(exploded, enrich.dimension(dim.select(F.col("cpv_code").alias("_code"), *attributes).withColumn("level", F.col("level").cast("tinyint"))), "cpv_code", "_code", "cpv_matched")
    coded = joined.select("procedure_id", "source", "buyer_id", "publication_date", "estimated_value", "currency", "cpv_position", "cpv_code", "cpv_matched", *attributes)
    views = {
        "open_opportunities": opened,
        "opportunity_cpv": coded,
        "buyer_summary": enrich.buyer_summary(opened),
        "cpv_summary": enrich.code_summary(coded.withColumnRenamed("label_es", "label")),
        "opportunities_monthly": enrich.monthly_summary(opened),
        "opportunities_without_publication_date": enrich.undated_summary(opened),
    }
    check_views(views)
    totals = enrich.reconciliation(opened, coded, views["buyer_summary"], views["opportunities_monthly"], views["opportunities_without_publication_date"])
    if wrong := totals.where("NOT agrees").collect():
        raise ContractError(f"views don't agree with their base: {[(r.view, r.got, r.want) for r in wrong]}")
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views


def export_views(views: dict[str, DataFrame], out: str) -> dict[str, int]:
    """The five exports as CSV below ``out``; rows of each.

    All are written beside their places and read back, columns and rows compared, before the
    first takes its place; a manifest follows last. A failure leaves what was there before.
    """
    missing = set(exports.EXPORTS) - set(views)
    if missing:
        raise ContractError(f"views missing: {sorted(missing)}")
    spark = next(iter(views.values())).sparkSession
    staging, rows = f"{out}/_staging-{uuid.uuid4().hex}", {}
    try:
        for name, order in exports.EXPORTS.items():
            exports.write_csv(views[name], f"{staging}/{name}", order)
            rows[name] = views[name].count()
            back = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(f"{staging}/{name}")
            if (found := back.count()) != rows[name]:
                raise ContractError(f"{name} was exported with {found} rows of {rows[name]}")
            if rows[name] and back.columns != views[name].columns:
                raise ContractError(f"{name} was exported with {back.columns}")
        for name in rows:
            files.replace(spark, f"{staging}/{name}", f"{out}/{name}")
        files.write_document(spark, f"{out}/manifest.json", {"format_version": FORMAT, "files": {name: {"view": name, "row_count": n} for name, n in rows.items()}})
    finally:
        files.remove(spark, staging)
    return rows


def link_duplicates(rows: DataFrame, window: int = 7, threshold: float = 0.75) -> DataFrame:
    """Assignments of linked records: key, root, group_no, canonical.

    ``rows``: key, source, block, day, title (folded), one row per record. Titles that share
    no token can't reach a positive threshold.
    """
    pairs = legacy.linkage_candidates(rows, "block", "key", "source", "day", window)
    involved = pairs.select("block", F.explode(F.array("a", "b")).alias("key")).distinct()
    weights = legacy.tfidf(rows.join(involved, ["block", "key"]).select("block", "key", "title"), "block", "key", "title")
    links = legacy.similarities(pairs, weights).where(F.col("similarity") >= threshold)
    groups = legacy.numbered_groups(legacy.link_groups(links))
    members = groups.join(rows.select(F.col("key").alias("node"), "day", "title", "source"), "node")
    best = legacy.canonical(members, "day", "title", "node", "source")
    return members.join(best, "root").select(F.col("node").alias("key"), "root", "group_no", "canonical")
