"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes the documents that its predecessor kept; ``run`` chains them, and a caller
may write and read again between stages or not. All but the last return the columns of
documents. Stages remove nothing that their result is read from: operators write small results
of their own (runs of lines, keys that stay, pieces), which belong to the caller.

All stages take null doc_ids and texts, empty and very long texts, ties, repeated rows, empty
tables and further columns (which are left behind): documents without words go with the first
stage, texts are read whole, of copies one document stays (rows equal in doc_id and text are
one document, which stays or goes as a whole), and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm import jaccard, lines, packing, quality, secrets
from noticeworks.llm.common import noting, remove_tables, table, written

#: The columns of documents; others that a table may have are left behind.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled ones; the others go."""
    return quality.judge(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines of 50 words or more that came earlier. One that repeats
    as a whole is left without words and goes: quality rules kept none that had none before."""
    return lines.dedup_lines(docs.select(*COLUMNS)).where(F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 on shingles of five words."""
    return jaccard.keep_one(docs.select(*COLUMNS), jaccard.Threshold(5, 80, 100))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kinds."""
    return secrets.redact_secrets(docs.select(*COLUMNS))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents in sequences of 4096."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: The tokenizer and the binomial thresholds are outside SQL; tests hold run() against a
#: brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir, each written to the shared folder between.

    What a stage has read and kept goes when its output is written. The pieces that the result
    is read from stay.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with noting() as kept:
            docs = written(stage(spark, docs, sf_dir), name)
        remove_tables(spark, before + kept[:-1])
        before = kept[-1:]
    packed = STAGES[-1][1](spark, docs, sf_dir)  # its pieces are written
    remove_tables(spark, before)
    return packed
