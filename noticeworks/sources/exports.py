"""Sinks: typed Parquet, JSON lines, ordered CSV for BI tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Export views and their sort keys; nulls come last.
EXPORTS = {
    "open_opportunities": ("procedure_id",),
    "opportunity_cpv": ("procedure_id", "cpv_position", "cpv_code"),
    "buyer_summary": ("identity_basis", "buyer_id", "buyer_name"),
    "cpv_summary": ("cpv_code",),
    "opportunities_monthly": ("month", "source"),
}


def write_parquet(df: DataFrame, path: str, order: tuple[str, ...] = (), whole: bool = False) -> None:
    """zstd Parquet. ``order`` sorts within files, which helps skipping and is no contract; with
    ``whole`` files in name order are the dataset in its order."""
    (df if not order else df.orderBy(*order) if whole else df.sortWithinPartitions(*order)).write.mode("overwrite").option("compression", "zstd").parquet(path)


def json_line(df: DataFrame) -> Column:
    """A row as JSON with its keys sorted."""
    return F.to_json(F.struct(*sorted(df.columns)))


def write_json_lines(df: DataFrame, path: str) -> None:
    df.select(json_line(df).alias("value")).write.mode("overwrite").text(path)


def csv_rows(df: DataFrame) -> DataFrame:
    """Columns as the CSV has them: arrays as JSON text, instants in UTC with microseconds."""
    shown = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind.startswith("array"):
            c = F.to_json(c)
        elif kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        shown.append(c.alias(name))
    return df.select(*shown)


def write_csv(df: DataFrame, path: str, order: tuple[str, ...]) -> None:
    """CSV with a header in a global order, in as many files as the sort makes; null is empty
    and an empty string is quoted. Files in name order are the export in its order."""
    ordered = df.orderBy(*(F.col(c).asc_nulls_last() for c in order))
    csv_rows(ordered).write.mode("overwrite").option("header", "true").option("nullValue", "").option("emptyValue", '""').option("quote", '"').option("escape", '"').csv(path)
