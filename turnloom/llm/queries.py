"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnloom.llm import centroids, decontamination, fingerprints, html_text, language_model, mixing, near_dedup, quality, substring_dedup, token_output, url_filter, warc, whitening


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Return each query by name: the operators, and parts of them that SQL can express (``l``)."""
    return {
        "op1_url_filter": url_filter.op1_url_filter,
        "op2_fingerprints": fingerprints.op2_fingerprints,
        "op3_html_extraction": html_text.op3_html_extraction,
        "op4_decontamination": decontamination.op4_decontamination,
        "op5_language_model": language_model.op5_language_model,
        "op6_quality_classifier": quality.op6_quality_classifier,
        "op7_near_dedup": near_dedup.op7_near_dedup,
        "op8_token_output": token_output.op8_token_output,
        "op9_substring_dedup": substring_dedup.op9_substring_dedup,
        "op10_mixing": mixing.op10_mixing,
        "op11_warc": warc.op11_warc,
        "op12_centroids": centroids.op12_centroids,
        "op13_whitening": whitening.op13_whitening,
        "l1_url_rules": url_filter.l1_url_rules,
        "l2_edited_texts": fingerprints.l2_edited_texts,
        "l10_targets": mixing.l10_targets,
    }


def oracle_sql() -> dict[str, str]:
    """Return DuckDB SQL by query name."""
    return {"op7_near_dedup": near_dedup.ORACLE, "op9_substring_dedup": substring_dedup.ORACLE, "l1_url_rules": url_filter.ORACLE, "l2_edited_texts": fingerprints.ORACLE, "l10_targets": mixing.ORACLE, "op11_warc": warc.ORACLE, "op12_centroids": centroids.ORACLE}
