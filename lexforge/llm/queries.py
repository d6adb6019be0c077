"""The queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, language_id, license_scan, ogg, pii, quality, simhash, substring_dedup, url_filter
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def over(name: str, function: Callable[..., DataFrame], *more: str) -> Query:
    return lambda spark, sf_dir: function(*(table(spark, sf_dir, n) for n in (name, *more)))


def queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": over("documents", substring_dedup.deduplicated_documents),
        "op2_language_id": over("documents", language_id.language_of_documents),
        "op3_pii_surrogates": over("documents", pii.private_documents),
        "op4_url_filter": over("pages", url_filter.verdicts_of_pages),
        "op5_license_scan": over("documents", license_scan.licenses_of_documents),
        "op6_word_bpe": over("documents", bpe.tokens_of_documents),
        "op7_quality": over("documents", quality.quality_of_documents, "labels"),
        "op8_simhash": over("documents", simhash.groups_of_documents),
        "op9_decontamination": over("documents", decontaminate.matches, "benchmark"),
        "op10_ogg": over("documents", ogg.media_of_documents),
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_url_filter": url_filter.oracle(), "op5_license_scan": license_scan.oracle()}
