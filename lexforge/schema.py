"""Enumerations, versions, thresholds and table schemas of the engine."""

from __future__ import annotations

STACKS = ("sp500", "queried")
SECTIONS = ("mdna", "risk_factors")
ALL_SECTIONS = ("full", "risk_factors", "mdna")
WEIGHTINGS = ("proportional", "tfidf")
#: Lexicon column and the name of its score.
CATEGORIES = {"Negative": "neg", "Positive": "pos", "Uncertainty": "unc", "Litigious": "lit", "Strong_Modal": "strong_modal", "Weak_Modal": "weak_modal", "Constraining": "constraining"}
MEASURES = tuple(CATEGORIES.values())
PARSER_VERSION, EXTRACTOR_VERSION, SCORER_VERSION = "2", "2", "1"
#: Ranking: fewest words of a section that counts, most recent filings averaged, fewest filings of a ranked ticker.
MIN_WORDS, N_FILINGS, MIN_FILINGS = 200, 4, 2
JUMP_RATIO = 5.0

FILINGS = "accession string, cik bigint, ticker string, form_type string, period_of_report string, acceptance_dt string, filing_date string, primary_doc string, raw_path string, parse_status string, stack string, downloaded_at string"
MEMBERS = "ticker string, cik bigint, name string, sector string, weight_pct double, updated_at string"
SCORES = "accession string, section string, weighting string, scorer_version string, total_words bigint, " + ", ".join(f"{m} double" for m in MEASURES) + ", scored_at string"
TEXTS = "accession string, section string, text string"
SECTION = "struct<status:string,word_count:bigint,char_count:bigint,suspicious_flags:array<string>,head_excerpt:string>"
FULL = "struct<status:string,word_count:bigint,char_count:bigint,non_letter_ratio:double,non_ascii_ratio:double,suspicious_flags:array<string>>"
SECTION_RECORDS = f"cik bigint, accession string, parser_version string, section_extractor_version string, extractor string, form_type string, parsed_at string, status string, error string, full {FULL}, risk_factors {SECTION}, mdna {SECTION}"
SUBMISSIONS = "cik string, name string, tickers array<string>, filings struct<recent:struct<accessionNumber:array<string>,form:array<string>,filingDate:array<string>,reportDate:array<string>,acceptanceDateTime:array<string>,primaryDocument:array<string>>,files:array<struct<name:string>>>"
KEYS = {"filings": ["accession"], "members": ["ticker"], "scores": ["accession", "section", "weighting"], "texts": ["accession", "section"], "records": ["accession"]}


def of_stack(stack: str) -> str:
    if stack not in STACKS:
        raise ValueError(f"unknown stack {stack!r}; it is one of {STACKS}")
    return stack
