"""Event history over events, documents and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticeworks.operators import state
from noticeworks.session import scratch_path, table
from noticeworks.streaming import latest


def latest_state(events: DataFrame, key: str, time: str, event_id: str) -> DataFrame:
    """The row of each key with the greatest time; a tie goes to the greatest event id. Rows are
    combined before they are shuffled; a time that is there beats one that isn't."""
    order = F.struct(F.col(time), F.col(event_id))
    return events.groupBy(key).agg(F.max_by(F.struct(*events.columns), order).alias("_r")).select("_r.*")


def latest_state_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_state(table(spark, sf_dir, "events"), "user_id", "ts", "event_id")


def latest_state_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event of each user, with a deleted/open/closed/insufficient decision."""
    found = latest_state(table(spark, sf_dir, "events"), "user_id", "ts", "event_id")
    decision = (
        F.when(F.col("event_type") == "error", "deleted")
        .when(F.col("event_type").isin("click", "view"), "open")
        .when(F.col("event_type") == "purchase", "closed")
        .otherwise("insufficient")
    )
    return found.select("user_id", "event_id", "event_type", "ts", decision.alias("decision"))


def _as_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.floor(F.col("event_id") / 3)
    ref = F.concat(F.lit("u/"), k.cast("string"))
    delete = F.col("event_type") == "error"
    return e.select(
        F.when(delete, F.concat(F.lit("placsp:tombstone:"), ref)).otherwise(F.concat(F.lit("placsp:notice:"), ref, F.lit("@"), F.col("event_id").cast("string"))).alias("event_id"),
        F.when(F.col("event_type") != "signup", F.concat(F.lit("placsp:procedure:"), ref)).alias("procedure_id"),
        F.lit("placsp").alias("source"),
        F.when(delete, "tombstone").otherwise("notice_snapshot").alias("source_event_type"),
        F.when(~delete, F.col("ts").cast("timestamp")).alias("source_updated_at"),
    )


def current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current state of procedures of three events each, deletes undated, some without an id."""
    return state.current_state(_as_history(spark, sf_dir))[0].select("procedure_id", "event_id", "source_updated_at", "is_deleted")


def undated_competing_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = state.current_state(_as_history(spark, sf_dir))[1]
    return issues.groupBy("procedure_id", "event_id", "reason").agg(F.count("*").alias("n"))


def provenance_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a user's events the one with the least provenance, some members and indexes null."""
    e = table(spark, sf_dir, "events").select(
        "user_id", "event_id", F.date_trunc("day", "ts").alias("retrieved"), F.lit("f").alias("file"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_id") % 7).alias("idx"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).alias("member"),
        F.col("props").alias("locator"), F.col("event_id").cast("string").alias("sha"),
    )
    found = state.first_observation(e, "user_id", state.provenance("retrieved", "file", "idx", "member", "locator", "sha"))
    return found.select("user_id", "event_id")


def dedup_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id", "event_type").dropDuplicates()


def collision_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a source taken as observations of one event, and the fields that differ."""
    found = state.collisions(table(spark, sf_dir, "documents"), "source", ["lang", "n_chars", "text"])
    return found.select("source", F.array_join("fields", ",").alias("fields"))


def fold_latest_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.when(F.col("event_id") % 5 != 0, F.col("props")).alias("updated"), F.col("event_id").alias("position"))
    return state.fold_updates(e, ["user_id", "event_type"], "updated", "position")[0]


def folded_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "props", "event_id")
    return state.fold_updates(e, ["user_id", "event_type"], "props", "event_id")[1]


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest retrieval of each partition, with a flag for ties of different content."""
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("part"), F.date_trunc("minute", "ts").alias("at"), F.sha2("props", 256).alias("sha"))
    best = e.groupBy("part").agg(F.max("at").alias("at"))
    return e.join(best, ["part", "at"]).groupBy("part", "at").agg(F.min("sha").alias("sha"), (F.count_distinct("sha") > 1).alias("tie"))


def tombstone_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), "o_custkey")
    t = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.concat(F.lit("https://x/y/"), F.col("l_orderkey").cast("string")).alias("ref"))
    return state.without_tombstones(o, t, "id", "ref")


def offenders_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders whose lines disagree about the flag."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    bad = state.collisions(li, "l_orderkey", ["l_returnflag"]).select("l_orderkey")
    return li.join(bad, "l_orderkey", "left_semi")


def parity_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    # keys that only one side has: every tenth of either side is moved out of the other's reach
    k = F.col("o_orderkey")
    left = o.withColumn("o_orderkey", F.when(k % 10 == 7, -k).otherwise(k))
    right = o.select(F.when(k % 10 == 3, -k).otherwise(k).alias("o_orderkey"), F.when(k % 4 != 0, F.col("o_orderstatus")).alias("o_orderstatus"), "o_orderpriority")
    return state.parity(left, right, "o_orderkey", ["o_orderstatus", "o_orderpriority"])


def streamed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each user, kept by a stream that reads the table in batches."""
    schema = table(spark, sf_dir, "events").schema
    top = scratch_path(spark)
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", 1).parquet(f"{sf_dir}/events.parquet*")
    fold = latest.latest("user_id", "ts", "event_id")
    latest.run_fold(stream, f"{top}/state", f"{top}/checkpoint", "user_id", fold).awaitTermination()
    return latest.read_state(spark, f"{top}/state", schema, fold)


def dataset_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One digest for each of three datasets: a table, the same in another order and partitioning,
    and one with a row twice; and whether it equals the first."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    sets = {"orders": o, "shuffled": o.repartition(7, "o_custkey"), "doubled": o.unionByName(o.where("o_orderkey = 7"))}
    rows = [state.digest(df).select(F.lit(name).alias("dataset"), "*") for name, df in sets.items()]
    every = rows[0].unionByName(rows[1]).unionByName(rows[2])
    first = state.digest(o).select(F.col("digest").alias("_first"))
    same = every.join(F.broadcast(first)).withColumn("same", F.col("digest") == F.col("_first"))  # a single row
    return same.select("dataset", "rows", "same")


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest per row; equal datasets have equal sets of them."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.sha2(F.to_json(F.struct("o_custkey", "o_orderkey", "o_orderstatus")), 256).alias("digest"))


QUERIES = {
    f.__name__: f
    for f in (
        latest_state_per_key, latest_state_decisions, current_state, undated_competing_issues, provenance_min, dedup_observations, collision_detect,
        fold_latest_updates, folded_updates, latest_snapshot, tombstone_anti, offenders_semi, parity_diff, fingerprint, streamed_latest, dataset_digests,
    )
}

_H = """h AS (SELECT CASE WHEN event_type = 'error' THEN 'placsp:tombstone:u/' || (event_id // 3) ELSE 'placsp:notice:u/' || (event_id // 3) || '@' || event_id END AS event_id,
   CASE WHEN event_type <> 'signup' THEN 'placsp:procedure:u/' || (event_id // 3) END AS procedure_id,
   event_type = 'error' AS is_deleted, CASE WHEN event_type <> 'error' THEN ts END AS u FROM events),
c AS (SELECT *, count(*) OVER (PARTITION BY procedure_id) AS n, count(*) FILTER (u IS NULL) OVER (PARTITION BY procedure_id) AS k FROM h WHERE procedure_id IS NOT NULL)"""
ORACLES = {
    "streamed_latest": "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1",
    "dataset_digests": """WITH n AS (SELECT count(*) AS n, count(*) FILTER (o_orderkey = 7) AS again FROM orders)
        SELECT 'orders' AS dataset, n AS rows, true AS same FROM n UNION ALL SELECT 'shuffled', n, true FROM n UNION ALL SELECT 'doubled', n + again, again = 0 FROM n""",
    "latest_state_per_key": "SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS r FROM events) WHERE r = 1",
    "latest_state_decisions": """
        SELECT user_id, event_id, event_type, ts,
               CASE WHEN event_type = 'error' THEN 'deleted'
                    WHEN event_type IN ('click', 'view') THEN 'open'
                    WHEN event_type = 'purchase' THEN 'closed' ELSE 'insufficient' END AS decision
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS r FROM events)
        WHERE r = 1""",
    "current_state": f"""WITH {_H} SELECT procedure_id, event_id, u AS source_updated_at, is_deleted FROM
        (SELECT *, row_number() OVER (PARTITION BY procedure_id ORDER BY u DESC NULLS LAST, event_id DESC) AS r FROM c WHERE NOT (n > 1 AND k > 0)) WHERE r = 1""",
    "undated_competing_issues": f"""WITH {_H}, i AS (SELECT procedure_id, event_id, 'undated_competing_events' AS reason FROM c WHERE n > 1 AND k > 0
        UNION ALL SELECT procedure_id, event_id, 'missing_procedure_id' FROM h WHERE procedure_id IS NULL)
        SELECT procedure_id, event_id, reason, count(*) AS n FROM i GROUP BY ALL""",
    "provenance_min": """SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts),
        CASE WHEN event_id % 3 <> 0 THEN event_id % 7 END NULLS LAST, coalesce(CASE WHEN event_id % 2 = 0 THEN event_type END, ''), props, CAST(event_id AS VARCHAR)) AS r FROM events) WHERE r = 1""",
    "dedup_observations": "SELECT DISTINCT user_id, event_type FROM events",
    "collision_detect": """SELECT source, concat_ws(',', CASE WHEN count(DISTINCT row(lang)) > 1 THEN 'lang' END, CASE WHEN count(DISTINCT row(n_chars)) > 1 THEN 'n_chars' END,
        CASE WHEN count(DISTINCT row(text)) > 1 THEN 'text' END) AS fields FROM documents GROUP BY source
        HAVING count(DISTINCT row(lang)) > 1 OR count(DISTINCT row(n_chars)) > 1 OR count(DISTINCT row(text)) > 1""",
    "fold_latest_updates": """SELECT user_id, event_type, updated, position FROM (SELECT user_id, event_type, CASE WHEN event_id % 5 <> 0 THEN props END AS updated, event_id AS position,
        row_number() OVER (PARTITION BY user_id, event_type ORDER BY coalesce(CASE WHEN event_id % 5 <> 0 THEN props END, '') DESC, event_id DESC) AS r FROM events) WHERE r = 1""",
    "folded_updates": "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT user_id, event_type FROM events)) AS BIGINT) AS folded FROM events",
    "latest_snapshot": """WITH e AS (SELECT event_type AS part, date_trunc('minute', ts) AS "at", sha256(props) AS sha FROM events),
        m AS (SELECT part, max("at") AS "at" FROM e GROUP BY part)
        SELECT e.part, e."at", min(sha) AS sha, count(DISTINCT sha) > 1 AS tie FROM e JOIN m ON e.part = m.part AND e."at" = m."at" GROUP BY e."at", e.part""",
    "tombstone_anti": "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')",
    "offenders_semi": """SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey FROM lineitem
        WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) > 1)""",
    "parity_diff": """WITH a AS (SELECT * REPLACE (CASE WHEN o_orderkey % 10 = 7 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey) FROM orders),
        b AS (SELECT CASE WHEN o_orderkey % 10 = 3 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS s, o_orderpriority AS p FROM orders)
        SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'left_only' WHEN a.o_orderkey IS NULL THEN 'right_only' ELSE 'differs' END AS kind,
            CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN 'o_orderstatus' ELSE '' END AS fields
        FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR o_orderstatus IS DISTINCT FROM s OR o_orderpriority IS DISTINCT FROM p""",
    "fingerprint": """SELECT o_orderkey, sha256('{"o_custkey":' || o_custkey || ',"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS digest FROM orders""",
}
