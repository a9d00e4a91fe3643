"""The operators' queries, with their SQL oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from noticeworks.llm import chat, classifier, jaccard, lines, packing, pieces, quality, resampling, runs, secrets, sharding, syncmers, urls


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_ownership": secrets.op1_secret_ownership,
        "op2_url_filter": urls.op2_url_filter,
        "op3_line_winnowing": lines.op3_line_winnowing,
        "op4_ngram_jaccard": jaccard.op4_ngram_jaccard,
        "op5_syncmer_fingerprints": syncmers.op5_syncmer_fingerprints,
        "op6_chat_format": chat.op6_chat_format,
        "op7_gumbel_segmentations": pieces.op7_gumbel_segmentations,
        "op8_bin_completion": packing.op8_bin_completion,
        "op9_risk_controlled_quality": quality.op9_risk_controlled_quality,
        "op10_jump_sharding": sharding.op10_jump_sharding,
        "op11_importance_resampling": resampling.op11_importance_resampling,
        "op12_lyndon_runs": runs.op12_lyndon_runs,
        "op13_quality_classifier": classifier.op13_quality_classifier,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_ownership": secrets.OP1_SQL,
        "op2_url_filter": urls.OP2_SQL,
        "op3_line_winnowing": lines.OP3_SQL,
        "op4_ngram_jaccard": jaccard.OP4_SQL,
        "op6_chat_format": chat.OP6_SQL,
        "op9_risk_controlled_quality": quality.OP9_SQL,
        "op11_importance_resampling": resampling.OP11_SQL,
    }
