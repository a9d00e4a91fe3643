"""Sharding by jump consistent hashing.

The shard of a row is a function of its key and of the number of shards alone: no ring table
and no statistics. With one more shard the expected 1/(n+1) of the rows move, all of them
into the new shard. The generator is the published 64-bit linear congruential one; Spark's
checked arithmetic has no wrapping product, so it is computed on 16-bit parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from noticeworks.llm.common import empty_if_null, expanded, partitions, table, unused

#: Fixed multiplier of the generator, and its two halves of 32 bits.
MULTIPLIER = 2862933555777941757
_HIGH, _LOW = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
#: Steps that nearly every key of any number of shards ends within.
SOON = 48
_MASK16, _MASK32 = 0xFFFF, 0xFFFFFFFF


def _mask32(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_MASK32))


def _times_low(x: Column, factor: int) -> tuple[Column, Column]:
    """Low and high part (from bit 32) of x * factor, both below 2**32."""
    p = x * F.lit(factor & 0xFFFF)
    q = x * F.lit(factor >> 16) + F.shiftright(p, 16)
    return F.shiftleft(q.bitwiseAND(F.lit(_MASK16)), 16).bitwiseOR(p.bitwiseAND(F.lit(_MASK16))), F.shiftright(q, 16)


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """The generator's next 64-bit state, from and as halves of 32 bits."""
    product, carry = _times_low(low, _LOW)
    cross = _times_low(high, _LOW)[0] + _times_low(low, _HIGH)[0]
    total = product + F.lit(1)
    return _mask32(carry + cross + F.shiftright(total, 32)), _mask32(total)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0..shards-1 of a 64-bit key; null keys count as 0."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    key = F.coalesce(key.cast("long"), F.lit(0))
    start = F.struct(
        _mask32(F.shiftright(key, 32)).alias("high"),
        _mask32(key).alias("low"),
        F.lit(0).cast("long").alias("at"),
        F.lit(0).cast("long").alias("to"),
    )

    def step(state: Column, _: Column) -> Column:
        high, low = _next_state(state["high"], state["low"])
        # (at + 1) * (2**31 / ((state >>> 33) + 1)), in doubles as published
        to = F.floor((state["to"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double")))
        moved = F.struct(high.alias("high"), low.alias("low"), state["to"].alias("at"), to.alias("to"))
        return F.when(state["to"] < shards, moved).otherwise(state)

    # the steps of a key number about the logarithm of the shards; each moves at least one shard
    # ahead, so those few keys that aren't there yet are after as many steps as shards
    soon = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, SOON))), start, step)
    if shards <= SOON:
        return soon["at"].cast("int")
    late = lambda s: F.when(s["to"] >= shards, s).otherwise(F.aggregate(F.sequence(F.lit(SOON), F.lit(shards)), s, step))
    return F.get(F.transform(F.array(soon), lambda s: late(s)["at"].cast("int")), F.lit(0))


def numbered(df: DataFrame, group: str, order: list[Column], spread: Column, parts: int, name: str) -> DataFrame:
    """Rows numbered from 0 without gaps within each group, however large the groups are.

    Equal rows are counted as one before anything is shuffled, and spread out again when they
    are numbered, so that a row that stands very often is one row of its part. Each group is
    split in ``parts`` by ``spread``; parts are numbered on their own and start where the parts
    before them end.
    """
    n, part, start, held, of, copy = unused(df, "_n", "_part", "_start", "_group", "_of", "_copy")
    same = df.groupBy(*df.columns).agg(F.count("*").alias(n))
    split = same.withColumn(part, F.pmod(F.xxhash64(spread), F.lit(parts)).cast("int"))
    counts = split.groupBy(group, part).agg(F.sum(n).alias(n))
    before = W.partitionBy(group).orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias(held), F.col(part).alias(of), F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    within = W.partitionBy(group, part).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    ranked = split.withColumn(copy, F.coalesce(F.sum(n).over(within), F.lit(0)))
    joined = ranked.join(starts, (F.col(group) == F.col(held)) & (F.col(part) == F.col(of))).withColumn(start, F.col(start) + F.col(copy))
    return expanded(joined.drop(copy, held, of, part), n, copy).withColumn(name, F.col(start) + F.col(copy)).select(*df.columns, name)


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's shard with ``shards`` and with one more, and its slot there.

    Result: doc_id, size, text_crc32, law, shard, slot, grown_shard. Rows with a null key all
    go to the shard of key 0. A null text has size 1. Equal rows share a shard and get slots
    of their own. An empty table gives an empty result; other columns are ignored.
    """
    parts = max(16, partitions(docs.sparkSession))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(empty_if_null(text), "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        jump_hash(F.col(key), shards).alias("shard"),
        jump_hash(F.col(key), shards + 1).alias("grown_shard"),
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    spread = F.struct("doc_id", "text_crc32")
    return numbered(rows, "shard", order, spread, parts, "slot").select("doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), "grown_shard")


def op10_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7."""
    return shard_documents(table(spark, sf_dir, "documents"), 8)
