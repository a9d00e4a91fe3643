"""Dimension sources: a code vocabulary in CSV, organisational units in spreadsheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.functions.text import blank_to_null
from noticeworks.operators import intake
from noticeworks.operators.contracts import ContractError
from noticeworks.operators.enrich import code_dimension

#: Fixed names of the published files' columns.
VOCABULARY = ("code", "nombre", "name")
UNIT_COLUMNS = {
    "C_ID_UD_ORGANICA": "code", "C_ID_NIVEL_ADMON": "scope", "N_NIVEL_JERARQUICO": "hierarchy", "C_ID_DEP_UD_SUPERIOR": "parent", "C_ID_DEP_UD_PRINCIPAL": "principal",
    "C_ID_ESTADO": "status", "D_VIG_ALTA_OFICIAL": "valid_from", "NIF_CIF": "nif",
}


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """The vocabulary's rows as text, after a check of its columns."""
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    if missing := set(VOCABULARY) - set(rows.columns):
        raise ContractError(f"vocabulary without {sorted(missing)}")
    return rows.select(*VOCABULARY)


def read_code_dimension(spark: SparkSession, path: str) -> DataFrame:
    return code_dimension(read_vocabulary(spark, path), "code", "nombre", "name")


def empty_code_dimension(spark: SparkSession) -> DataFrame:
    """No rows, with the dimension's types: what views use when there is no vocabulary."""
    return spark.createDataFrame([], "cpv_code string, label_es string, label_en string, level tinyint, parent_code string, is_leaf boolean")


def units(rows: DataFrame, scope: str, header: int = 2) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) units of one scope from sheet rows (path, row, cells).

    Columns go by the header's names; the unit's own name is the first name column after the
    code, as several columns are called alike. A sheet has one header row per file.
    """
    titles = rows.where(F.col("row") == header).select("path", F.explode("cells").alias("letter", "title"))
    column = F.lpad("letter", 3, " ")
    code_at = F.max(F.when(F.col("title") == "C_ID_UD_ORGANICA", column))
    anchors = titles.groupBy("path").agg(code_at.alias("_code_at"))
    names = titles.join(anchors, "path").where(F.regexp_replace("title", "^EDP[.]", "").startswith("C_DNM_UD_ORGANICA") & (column > F.col("_code_at")))
    name_at = names.groupBy("path").agg(F.trim(F.min(column)).alias("_name_at"))
    wanted = titles.where(F.col("title").isin(*UNIT_COLUMNS)).groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("title", "letter"))).alias("_at"))
    body = rows.where(F.col("row") > header).join(F.broadcast(wanted.join(name_at, "path")), "path")
    cells = [F.try_element_at("cells", F.try_element_at("_at", F.lit(title))).alias(name) for title, name in UNIT_COLUMNS.items()]
    named = body.select("path", "row", *cells, F.try_element_at("cells", F.col("_name_at")).alias("name"))
    judged = named.withColumn("rejection_reason", intake.unit_rejection(scope))
    good = judged.where("rejection_reason IS NULL").select(
        "code", blank_to_null(F.col("name")).alias("name"), "scope", F.col("hierarchy").cast("smallint").alias("hierarchy"), "parent", "principal", "status", "valid_from", F.upper(blank_to_null(F.col("nif"))).alias("nif")
    )
    return good, judged.where("rejection_reason IS NOT NULL").select("path", "row", F.coalesce("code", F.lit("")).alias("code"), "rejection_reason")
