"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from notewarden.llm import decontaminate, html_text, language_id, license_scan, line_dedup, near_dups, packing, quality_model, quality_rules, spelling, substring_dedup, url_filter, whitening
from notewarden.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    docs = lambda s, d: table(s, d, "documents")
    pages = lambda s, d: table(s, d, "pages")
    labels = lambda s, d: table(s, d, "labels")
    return {
        "op1_decontamination": lambda s, d: decontaminate.op1(docs(s, d), table(s, d, "benchmark")),
        "op2_quality_rules": lambda s, d: quality_rules.op2(docs(s, d), labels(s, d)),
        "op3_license_scan": lambda s, d: license_scan.op3(docs(s, d)),
        "op4_url_filter": lambda s, d: url_filter.op4(pages(s, d)),
        "op5_quality_classifier": lambda s, d: quality_model.op5(docs(s, d), labels(s, d)),
        "op6_language_id": lambda s, d: language_id.op6(docs(s, d)),
        "op7_packing": lambda s, d: packing.op7(docs(s, d)),
        "op8_substring_dedup": lambda s, d: substring_dedup.op8(docs(s, d)),
        "op9_simhash_near_dedup": lambda s, d: near_dups.op9(docs(s, d)),
        "op10_html_extraction": lambda s, d: html_text.op10(pages(s, d)),
        "op11_embedding_whitening": lambda s, d: whitening.op11(table(s, d, "embeddings")),
        "op12_spelling_variants": lambda s, d: spelling.op12(docs(s, d)),
        "op13_line_dedup": lambda s, d: line_dedup.op13(docs(s, d)),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontaminate.SQL,
        "op2_quality_rules": quality_rules.SQL,
        "op3_license_scan": license_scan.SQL,
        "op4_url_filter": url_filter.SQL,
        "op8_substring_dedup": substring_dedup.SQL,
        "op12_spelling_variants": spelling.SQL,
        "op13_line_dedup": line_dedup.SQL,
    }
