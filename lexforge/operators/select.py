"""Which filings a stage works on; all are filters and anti-joins, so a second run of a stage finds nothing to do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..schema import EXTRACTOR_VERSION, PARSER_VERSION, SCORER_VERSION, of_stack

FORMS, SCORED = ("10-K", "10-Q"), ("ok", "partial", "section_fail")


def target_filings(listed: DataFrame, forms: list[str], history_start: str, amendments: bool = False) -> DataFrame:
    """Filings to download: form, date as text, and keys that aren't blank. An amendment's base form counts."""
    rows = listed.withColumns({c: F.trim(F.coalesce(c, F.lit(""))) for c in ("form", "filingDate", "accessionNumber", "primaryDocument")})
    amended = F.col("form").endswith("/A")
    base = F.regexp_replace("form", "/A$", "")
    kept = rows.where((~amended | F.lit(amendments)) & base.isin(*forms) & (F.col("filingDate") != "") & (F.col("filingDate") >= history_start) & (F.col("accessionNumber") != "") & (F.col("primaryDocument") != ""))
    return kept.withColumn("acceptance_dt", names.acceptance(F.col("acceptanceDateTime")))


def universe(members: DataFrame, stack: str, ciks: DataFrame | None = None) -> DataFrame:
    """ticker and cik to download: the given numbers (their ticker, if known) or the stack's members with a number."""
    if ciks is not None:
        return ciks.select("cik").join(members.groupBy("cik").agg(F.min("ticker").alias("ticker")), "cik", "left").select("ticker", "cik")
    return members.where(F.col("cik").isNotNull() & F.lit(of_stack(stack) == "sp500")).select("ticker", "cik")


def complete_filings(filings: DataFrame, metadata: DataFrame) -> DataFrame:
    """Filings with a row and a completion marker."""
    return filings.join(metadata.select("accession").distinct(), "accession", "left_semi")


def to_parse(filings: DataFrame, texts: DataFrame, records: DataFrame | None = None, force: bool = False, ciks: list[int] | None = None, limit: int | None = None) -> DataFrame:
    """Filings without a status or without a full text; those that failed under the current parser are left alone."""
    out = filings.where(F.col("cik").isin(ciks)) if ciks else filings
    if not force:
        full = texts.where(F.col("section") == "full").select("accession", F.lit(True).alias("__has")).distinct()
        out = out.join(full, "accession", "left").where("parse_status is null or __has is null").drop("__has")
        if records is not None:
            failed = records.where((F.col("parser_version") == PARSER_VERSION) & (F.col("full.status") == "parse_fail"))
            out = out.join(failed.select("accession"), "accession", "left_anti")
    return limited(out, limit)


def limited(rows: DataFrame, limit: int | None) -> DataFrame:
    """The first rows by company and accession. The limit is of rows tried, not of those that succeed."""
    return rows.orderBy("cik", "accession").limit(limit) if limit else rows


def to_extract(filings: DataFrame, records: DataFrame, stack: str = "sp500", force: bool = False, ciks: list[int] | None = None, limit: int | None = None) -> DataFrame:
    statuses = ("ok", *SCORED[1:]) if force else ("ok",)
    out = filings.where(F.col("parse_status").isin(*statuses) & (F.col("stack") == of_stack(stack)) & F.col("form_type").isin(*FORMS))
    if ciks:
        out = out.where(F.col("cik").isin(ciks))
    if not force:
        out = out.join(records.where(F.col("section_extractor_version") == EXTRACTOR_VERSION).select("accession"), "accession", "left_anti")
    return limited(out, limit)


def to_score(filings: DataFrame, scores: DataFrame, force: bool = False, ciks: list[int] | None = None, limit: int | None = None) -> DataFrame:
    """Filings with usable text and no score row at all at the current version."""
    out = filings.where(F.col("parse_status").isin(*SCORED))
    if ciks:
        out = out.where(F.col("cik").isin(ciks))
    if not force:
        out = out.join(scores.where(F.col("scorer_version") == SCORER_VERSION).select("accession"), "accession", "left_anti")
    return limited(out, limit)


def members_with_ciks(members: DataFrame) -> DataFrame:
    return members.where("cik is not null").select("ticker", "cik", "name", F.coalesce("sector", F.lit("")).alias("sector")).orderBy("ticker")


def resolved_members(page: DataFrame, tickers: DataFrame) -> DataFrame:
    """The page's own number first, else the ticker table's; resolved tells which rows have one."""
    rows = page.join(tickers.select("ticker", F.col("cik").alias("__known")), "ticker", "left")
    return rows.withColumn("cik", F.coalesce("cik", "__known")).drop("__known").withColumn("resolved", F.col("cik").isNotNull())
