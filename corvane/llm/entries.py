"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import (
    decontamination,
    hard_negatives,
    html_extraction,
    mixing,
    near_duplicates,
    personal_data,
    quality_classifier,
    quality_rules,
    suffix_dedup,
    token_counts,
    toxicity,
    url_filters,
    vector_codes,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filters": url_filters.op1_url_filters,
        "op10_token_counts": token_counts.op10_token_counts,
        "op2_decontamination": decontamination.op2_decontamination,
        "op3_personal_data": personal_data.op3_personal_data,
        "op4_near_duplicates": near_duplicates.op4_near_duplicates,
        "op5_toxicity": toxicity.op5_toxicity,
        "op6_mixing": mixing.op6_mixing,
        "op7_quality_classifier": quality_classifier.op7_quality_classifier,
        "op8_quality_rules": quality_rules.op8_quality_rules,
        "quality_base_measures": quality_rules.quality_base_measures,
        "mixing_targets": mixing.mixing_targets,
        "url_rules": url_filters.url_rules,
        "token_edits": token_counts.token_edits,
        "url_link_graph": url_filters.url_link_graph,
        "op9_html_extraction": html_extraction.op9_html_extraction,
        "op11_hard_negatives": hard_negatives.op11_hard_negatives,
        "op12_vector_codes": vector_codes.op12_vector_codes,
        "op13_suffix_dedup": suffix_dedup.op13_suffix_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": decontamination.SQL,
        "op3_personal_data": personal_data.SQL,
        "quality_base_measures": quality_rules.BASE_SQL,
        "mixing_targets": mixing.TARGETS_SQL,
        "url_rules": url_filters.RULES_SQL,
        "op11_hard_negatives": hard_negatives.SQL,
        "op12_vector_codes": vector_codes.SQL,
    }
