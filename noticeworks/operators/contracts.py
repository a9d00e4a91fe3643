"""Contract checks: schemas, required values, keys. One aggregate per frame, never one per column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType


class ContractError(ValueError):
    """Data that breaks its contract; the build ends."""


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    required: bool = False


#: The event contract, in order; fixed names and types.
EVENT_FIELDS = (
    Field("event_id", "string", True), Field("procedure_id", "string"), Field("source", "string", True),
    Field("source_event_type", "string", True), Field("buyer_id", "string"), Field("buyer_name", "string"),
    Field("title", "string"), Field("description", "string"), Field("cpv_codes", "array<string>", True),
    Field("estimated_value", "decimal(20,2)"), Field("awarded_value", "decimal(20,2)"), Field("currency", "string"),
    Field("publication_date", "date"), Field("source_updated_at", "timestamp"), Field("deadline", "timestamp"),
    Field("status", "string"), Field("nuts_code", "string"), Field("country", "string"), Field("source_url", "string"),
    Field("ingested_at", "timestamp", True),
)


def schema_of(fields: tuple[Field, ...]) -> StructType:
    return StructType([StructField(f.name, DataType.fromDDL(f.kind), not f.required) for f in fields])


def signature(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def violations(df: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """One row: nulls of each required column, and null elements of each array."""
    required = [F.count_if(F.col(f.name).isNull()).alias(f"null_{f.name}") for f in fields if f.required]
    arrays = [F.count_if(F.exists(f.name, lambda x: x.isNull())).alias(f"null_in_{f.name}") for f in fields if f.kind.startswith("array")]
    return df.agg(F.count("*").alias("rows"), *required, *arrays)


def check(df: DataFrame, fields: tuple[Field, ...]) -> int:
    """The number of rows, if names, order, types and required values are the contract's."""
    wanted = [(f.name, DataType.fromDDL(f.kind).simpleString()) for f in fields]
    if signature(df.schema) != wanted:
        raise ContractError(f"schema {signature(df.schema)} is not {wanted}")
    found = violations(df, fields).first().asDict()
    rows = found.pop("rows")
    if broken := {k: v for k, v in found.items() if v}:
        raise ContractError(f"contract broken: {broken}")
    return rows


def read_checked(spark: SparkSession, path: str, fields: tuple[Field, ...]) -> DataFrame:
    """Parquet of a contract. The file's own schema is compared first, as a given one would
    make missing columns null."""
    found = spark.read.parquet(path)
    check(found, fields)
    return spark.read.schema(schema_of(fields)).parquet(path)


def empty(spark: SparkSession, fields: tuple[Field, ...]) -> DataFrame:
    """A frame without rows, with the contract's types."""
    return spark.createDataFrame([], schema_of(fields))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that are null or occur more than once, with their numbers of rows."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col(key).isNull())


def assert_key(df: DataFrame, key: str, shown: int = 5) -> None:
    if found := duplicate_keys(df, key).orderBy(key).limit(shown).collect():
        raise ContractError(f"{key} is no key: {[r[key] for r in found]}")


def assert_row_count(df: DataFrame, expected: int, label: str) -> int:
    """A join by a key adds no rows and loses none."""
    if (found := df.count()) != expected:
        raise ContractError(f"{label} changed the number of rows: {expected} before, {found} after")
    return found


def nested_arrays(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, ArrayType)]
