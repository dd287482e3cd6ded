"""Queries of the operators in this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (
    decontaminate,
    embedding_dedup,
    fill_middle,
    html_extract,
    license_scan,
    line_dedup,
    merkle,
    packing,
    quality_rules,
    simhash_dedup,
    substring_dedup,
    suffix_dedup,
    warc,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash_dedup": simhash_dedup.run,
        "op2_license_scan": license_scan.run,
        "op3_decontaminate": decontaminate.run,
        "op4_packing": packing.run,
        "op5_line_dedup": line_dedup.run,
        "op6_substring_dedup": substring_dedup.run,
        "op7_suffix_dedup": suffix_dedup.run,
        "op8_warc": warc.run,
        "op9_quality_rules": quality_rules.run,
        "op10_html_extract": html_extract.run,
        "op11_embedding_dedup": embedding_dedup.run,
        "op12_merkle_manifest": merkle.run,
        "op13_fill_middle": fill_middle.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_line_dedup": line_dedup.SQL,
        "op6_substring_dedup": substring_dedup.SQL,
        "op7_suffix_dedup": suffix_dedup.SQL,
        "op8_warc": warc.SQL,
        "op9_quality_rules": quality_rules.SQL,
        "op11_embedding_dedup": embedding_dedup.run,
        "op11_embedding_dedup": embedding_dedup.SQL,
        "op12_merkle_manifest": merkle.SQL,
        "op13_fill_middle": fill_middle.SQL,
    }
