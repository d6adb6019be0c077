"""Word lists with categories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CATEGORIES

#: A made-up list over common words, for tests and queries; it says nothing about sentiment. Fixed values.
SYNTHETIC = {
    "Negative": "worthless stupid idiot pathetic scum the thing",
    "Positive": "and with shall great",
    "Uncertainty": "of or may is",
    "Litigious": "by inor license",
    "Strong_Modal": "the thorst must",
    "Weak_Modal": "to er es might",
    "Constraining": "in on not erat",
}


def synthetic_rows() -> list[tuple[str, str]]:
    return [(word, category) for category, words in SYNTHETIC.items() for word in words.split()]


def synthetic(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{word}', '{category}')" for word, category in synthetic_rows())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(word, category)")


def from_wide(rows: DataFrame) -> DataFrame:
    """word and category of a table with a column of words and one for each category, whose cells are a year or 0."""
    missing = [c for c in CATEGORIES if c not in rows.columns]
    if missing:
        raise ValueError(f"the word list has no columns {missing}; it has {rows.columns}")
    word = "Word" if "Word" in rows.columns else rows.columns[0]
    long = rows.select(F.lower(F.trim(word)).alias("word"), *(F.coalesce(F.trim(F.col(c).cast("string")).try_cast("int"), F.lit(0)).alias(c) for c in CATEGORIES)).unpivot("word", list(CATEGORIES), "category", "year")
    return long.where("word is not null and word != '' and year != 0").select("word", "category").distinct()


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return from_wide(spark.read.csv(path, header=True))


def counts(lexicon: DataFrame) -> DataFrame:
    return lexicon.groupBy("category").agg(F.count("*").alias("n"))
