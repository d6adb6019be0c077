"""Column functions over tickers, company numbers, addresses of documents and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SUBMISSIONS_BASE, ARCHIVES_BASE = "https://data.sec.gov/submissions/", "https://www.sec.gov/Archives/edgar/data/"
#: The colour of each sector, and of any other.
COLOURS = {
    "Information Technology": "#8B7355",
    "Health Care": "#A0522D",
    "Financials": "#556B2F",
    "Consumer Discretionary": "#CD853F",
    "Industrials": "#708090",
    "Communication Services": "#9E7B5B",
    "Consumer Staples": "#6B8E6B",
    "Energy": "#8B6914",
    "Utilities": "#B8860B",
    "Real Estate": "#7B6B5A",
    "Materials": "#665544",
}
OTHER_COLOUR = "#A09080"


def ticker(raw: Column) -> Column:
    return F.replace(F.upper(F.trim(raw)), F.lit("."), F.lit("-"))


def cik(raw: Column) -> Column:
    """A number, null for blanks and anything else."""
    return F.trim(raw).try_cast("bigint")


def cik_padded(number: Column) -> Column:
    """Ten digits; longer numbers stay whole."""
    text = number.cast("string")
    return F.when(F.length(text) >= 10, text).otherwise(F.lpad(text, 10, "0"))


def submissions_url(number: Column) -> Column:
    return F.concat(F.lit(SUBMISSIONS_BASE + "CIK"), cik_padded(number), F.lit(".json"))


def extra_url(name: Column) -> Column:
    return F.concat(F.lit(SUBMISSIONS_BASE), name)


def document_url(number: Column, accession: Column, document: Column) -> Column:
    return F.concat(F.lit(ARCHIVES_BASE), number.cast("string"), F.lit("/"), F.replace(accession, F.lit("-"), F.lit("")), F.lit("/"), document)


def sector_colour(sector: Column) -> Column:
    found = F.lit(OTHER_COLOUR)
    for name, colour in COLOURS.items():
        found = F.when(sector == name, colour).otherwise(found)
    return found


def acceptance(raw: Column) -> Column:
    """UTC time without fractions; what can't be read stays as it is."""
    return F.coalesce(F.date_format(F.try_to_timestamp(raw), "yyyy-MM-dd'T'HH:mm:ss'Z'"), raw)


def year(date: Column) -> Column:
    return F.substring(date, 1, 4).try_cast("int")


def find(text: str, part: str) -> Column:
    """Zero-based place of a column's text in another's, -1 if there is none or it is empty."""
    return F.when(F.coalesce(F.col(part), F.lit("")) != "", F.expr(f"coalesce(locate({part}, {text}), 0)") - 1).otherwise(-1)
