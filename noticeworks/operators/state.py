"""Event history: collisions, observations, current state, decisions.

A delete is an event like any other; nothing is removed from the history. Retrieval time never
orders business state.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Fixed values of the contract.
NOTICE_SNAPSHOT, TOMBSTONE = "notice_snapshot", "tombstone"
PROCEDURE = "placsp:procedure:"
OPEN_STATUSES = ("PUB",)
CLOSED_STATUSES = ("EV", "ADJ", "ADJ_PAR", "RES", "RES_PAR", "ANUL")
NO_ID = "missing_procedure_id"
MISSING_ID = "missing_or_invalid_procedure_id"
UNSUPPORTED = "unsupported_placsp_event_type"
MISMATCH = "event_procedure_identity_mismatch"
UNDATED = "undated_competing_events"
DECISIONS = ("open", "deleted", "deadline_passed", "status_closed", "insufficient_evidence")
BUCKETS = {"open": "open", "deleted": "excluded_deleted", "deadline_passed": "excluded_not_actionable", "status_closed": "excluded_not_actionable", "insufficient_evidence": "excluded_insufficient_evidence"}


def provenance(time: str, file: str, index: str, member: str, locator: str, sha: str) -> Column:
    """What orders observations of an event: null indexes last, null members and locators first."""
    return F.struct(
        F.col(time), F.col(file), F.col(index).isNull().alias("none"), F.col(index),
        F.coalesce(member, F.lit("")).alias("member"), F.coalesce(locator, F.lit("")).alias("locator"), F.col(sha),
    )


def first_observation(events: DataFrame, key: str, order: Column) -> DataFrame:
    """The observation of each event with the least provenance; one partial aggregation."""
    row = F.struct(*events.columns)
    return events.groupBy(key).agg(F.min_by(row, order).alias("_r")).select("_r.*")


def collisions(events: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Keys observed with different contents, and the fields that differ: an issue frame.

    An empty result is the proof of a clean history; a build fails if there is any.
    """
    counts = events.groupBy(key).agg(*(F.count_distinct(F.struct(f)).alias(f) for f in fields))
    differ = F.array_compact(F.array(*(F.when(F.col(f) > 1, F.lit(f)) for f in fields)))
    return counts.select(key, differ.alias("fields")).where(F.size("fields") > 0)


def fold_updates(rows: DataFrame, keys: list[str], updated: str, position: str) -> tuple[DataFrame, DataFrame]:
    """Latest revision of each key by the update's raw text, then place; and one row: how many were folded.

    The text is compared as such, so offsets sort as text too; that is the contract.
    """
    order = F.struct(F.coalesce(F.col(updated), F.lit("")), F.col(position))
    kept = rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), order).alias("_r"), F.count("*").alias("_n"))
    return kept.select("_r.*"), kept.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("folded"))


def without_tombstones(rows: DataFrame, tombstones: DataFrame, record_id: str, ref: str) -> DataFrame:
    """Rows whose id is no tombstone's last segment, whatever their source and time."""
    gone = tombstones.select(F.substring_index(ref, "/", -1).alias("_gone")).distinct()
    return rows.join(gone, F.col(record_id) == F.col("_gone"), "left_anti")


def identity_reason() -> Column:
    """Why an event doesn't belong to its procedure; null if it does. Only one source's are checked.

    A notice carries the procedure's reference before its ``@``, an undated delete at its end,
    a dated one after its time in microseconds.
    """
    ref = F.when(F.col("procedure_id").startswith(PROCEDURE), F.nullif(F.replace(F.col("procedure_id"), F.lit(PROCEDURE), F.lit("")), F.lit("")))
    event = F.col("event_id")
    dated = F.regexp_extract(event, r"(?s)^placsp:tombstone-dated:-*[0-9]+:(.*)$", 1)
    notice = event.startswith(F.concat(F.lit("placsp:notice:"), ref, F.lit("@")))
    delete = (event == F.concat(F.lit("placsp:tombstone:"), ref)) | (F.nullif(dated, F.lit("")) == ref)
    kind = F.col("source_event_type")
    fits = F.when(kind == NOTICE_SNAPSHOT, notice).when(kind == TOMBSTONE, F.coalesce(delete, F.lit(False)))
    return F.when(F.col("source") == "placsp", F.when(ref.isNull(), MISSING_ID).when(fits.isNull(), UNSUPPORTED).when(~fits, MISMATCH))


def current_state(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(state, issues). State: the latest event of each procedure, with is_deleted. Issues:
    events that can't be placed, with their reason.

    Procedures of several events with an undated one among them are issues: all their events
    compete. Events are combined by procedure before they are shuffled, and only the procedures
    that compete are looked up again.
    """
    judged = events.withColumn("_reason", F.when(F.col("procedure_id").isNull(), NO_ID).otherwise(identity_reason()))
    unplaced, placed = judged.where("_reason IS NOT NULL"), judged.where("_reason IS NULL")
    newest = F.max_by(F.struct(*events.columns), F.struct("source_updated_at", "event_id"))
    grouped = placed.groupBy("procedure_id").agg(F.count("*").alias("_n"), F.count_if(F.col("source_updated_at").isNull()).alias("_undated"), newest.alias("_event"))
    competing = (F.col("_n") > 1) & (F.col("_undated") > 0)
    state = grouped.where(~competing).select("_event.*")
    state = state.withColumn("is_deleted", F.col("source_event_type") == TOMBSTONE).select(*events.columns, "is_deleted")
    columns = ["event_id", "procedure_id", "source", "source_event_type"]
    rivals = placed.join(grouped.where(competing).select(F.concat("procedure_id", F.lit("")).alias("procedure_id")), "procedure_id", "left_semi")
    issues = unplaced.select(*columns, F.col("_reason").alias("reason")).unionByName(rivals.select(*columns, F.lit(UNDATED).alias("reason")))
    return state, issues


def decision(as_of: datetime | None) -> Column:
    """open, deleted, deadline_passed, status_closed or insufficient_evidence."""
    at = F.lit(as_of).cast("timestamp")
    by_status = F.when(F.col("status").isin(*OPEN_STATUSES), "open").when(F.col("status").isin(*CLOSED_STATUSES), "status_closed")
    elsewhere = F.when(F.col("status").isNull() & (F.col("deadline") >= at), "open")
    judged = F.when(F.col("source") == "placsp", by_status).otherwise(elsewhere)
    return F.when(F.col("is_deleted"), "deleted").when(F.col("deadline") < at, "deadline_passed").otherwise(F.coalesce(judged, F.lit("insufficient_evidence")))


def bucket(decided: Column) -> Column:
    found = F.lit(None).cast("string")
    for name, value in BUCKETS.items():
        found = F.when(decided == name, value).otherwise(found)
    return found


def decision_counts(decided: DataFrame) -> DataFrame:
    """Rows of each decision, all five of them, with bucket: they add up to the input."""
    every = decided.sparkSession.createDataFrame([(d, BUCKETS[d]) for d in DECISIONS], "decision string, bucket string")
    counts = decided.groupBy("decision").agg(F.count("*").alias("n"))
    return F.broadcast(every).join(counts, "decision", "left").select("decision", "bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def open_opportunities(state: DataFrame, as_of: datetime | None) -> tuple[DataFrame, DataFrame]:
    """(open rows without the two internal columns, decision counts)."""
    decided = state.withColumn("decision", decision(as_of))
    return decided.where("decision = 'open'").drop("decision", "source_event_type", "is_deleted"), decision_counts(decided)


def parity(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys of one side only, and keys whose columns differ, with the columns' names."""
    a = left.select(F.col(key), F.struct(*columns).alias("_l"))
    b = right.select(F.col(key), F.struct(*columns).alias("_r"))
    differ = F.array_compact(F.array(*(F.when(~F.col(f"_l.{c}").eqNullSafe(F.col(f"_r.{c}")), F.lit(c)) for c in columns)))
    side = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("differs")
    both = a.join(b, key, "full").select(key, side.alias("kind"), F.when(side == "differs", F.array_join(differ, ",")).otherwise("").alias("fields"))
    return both.where("kind <> 'differs' OR fields <> ''")


#: The prime that sums of hashes are taken modulo of: that of 61 bits.
_PRIME = (1 << 61) - 1


def digest(rows: DataFrame) -> DataFrame:
    """One row: ``rows``, their number, and ``digest``, one of the dataset as a multiset.

    Two hashes of 64 bits of each row, with its columns by name, are summed modulo a prime, so
    that partial sums are combined in any order: equal datasets have equal digests however they
    are sorted and partitioned, and one with a row lost, doubled or changed has another (chances
    of 2**-61 for each sum apart). Column names and types go into it too.
    """
    names = sorted(rows.columns)
    kinds = "|".join(f"{c}:{dict(rows.dtypes)[c]}" for c in names)
    # as a text, in which a null differs from all values and neighbours can't run together
    text = F.to_json(F.struct(*(F.col(c) for c in names)), {"ignoreNullFields": "false"})
    sums = [F.sum(F.pmod(F.xxhash64(F.lit(seed), text), F.lit(_PRIME)).cast("decimal(38,0)")) for seed in (1, 2)]
    added = rows.agg(F.count("*").alias("rows"), *(F.coalesce(x, F.lit(0).cast("decimal(38,0)")).alias(f"s{i}") for i, x in enumerate(sums)))
    parts = [F.lit(kinds), F.col("rows").cast("string"), *((F.col(f"s{i}") % F.lit(_PRIME)).cast("string") for i in range(2))]
    return added.select("rows", F.sha2(F.concat_ws("/", *parts), 256).alias("digest"))
