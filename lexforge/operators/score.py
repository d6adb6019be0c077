"""Lexicon scores of filings' sections, with proportional and tf-idf weights.

Texts come as (accession, section, text). Totals come from the size of the token array. Tokens of the lexicon (a word list,
whose size is checked) are picked within the array, so that only they become rows; these meet the broadcast categories where
they are, and a text leaves its task as a few counts: one pass, one shuffle of partial sums. Document frequencies are counted
for lexicon words alone, from the same counts.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as fn
from ..schema import CATEGORIES, MEASURES, SCORER_VERSION, SECTIONS

ID = ["accession", "section"]
#: Words of a lexicon up to which it is a set of literals, and up to which it is broadcast; a longer one is joined by shuffles.
LITERAL_WORDS, BROADCAST_WORDS = 20_000, 1_000_000


def broadcast_if_small(lexicon: DataFrame, known_size: int | None = None) -> DataFrame:
    n = known_size if known_size is not None else lexicon.limit(BROADCAST_WORDS + 1).count()
    return F.broadcast(lexicon) if n <= BROADCAST_WORDS else lexicon


def tokenized(texts: DataFrame) -> DataFrame:
    """accession, section, tokens and total_words."""
    return texts.select(*ID, fn.tokens(F.col("text")).alias("tokens")).withColumn("total_words", F.size("tokens").cast("bigint"))


def term_frequencies(texts: DataFrame) -> DataFrame:
    """accession, section, tok and tf."""
    return tokenized(texts).select(*ID, F.explode("tokens").alias("tok")).groupBy(*ID, "tok").agg(F.count("*").alias("tf"))


class Words(NamedTuple):
    """tok and all its categories in one row, and the words themselves if they are few."""

    table: DataFrame
    few: list[str] | None


def words_of(lexicon: DataFrame) -> Words:
    found = {r[0] for r in lexicon.select("word").limit(8 * LITERAL_WORDS).collect()}
    few = sorted(w for w in found if w is not None) if len(found) <= LITERAL_WORDS else None
    table = lexicon.groupBy(F.col("word").alias("tok")).agg(F.collect_set("category").alias("categories"))
    return Words(broadcast_if_small(table, None if few is None else len(few)), few)


def known_tokens(texts: DataFrame, words: Words) -> DataFrame:
    """accession, section, total_words and tok: a row for each token of the lexicon, of long lexicons for each token; one with a
    null for texts without any."""
    rows = tokenized(texts)
    if words.few is not None:
        rows = rows.withColumn("tokens", F.filter("tokens", lambda w: w.isin(words.few)))
    return rows.select(*ID, "total_words", F.explode_outer("tokens").alias("tok"))


def counted(texts: DataFrame, words: Words) -> DataFrame:
    """accession, section, total_words, tok, categories and tf: a row for each lexicon word of a text, and one with nulls for
    all its other tokens (or for none at all), so that every text stays without a second pass over it."""
    rows = known_tokens(texts, words).join(words.table, "tok", "left")
    known = F.when(F.col("categories").isNotNull(), F.col("tok"))
    return rows.groupBy(*ID, known.alias("tok"), "categories").agg(F.count("*").alias("tf"), F.max("total_words").alias("total_words"))


def lexicon_frequencies(texts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Term frequencies of lexicon words alone."""
    words = words_of(lexicon)
    hits = known_tokens(texts, words).join(words.table, "tok")
    return hits.groupBy(*ID, "total_words", "tok", "categories").agg(F.count("*").alias("tf"))


def category_sums(value: Column) -> list[Column]:
    """One conditional sum for each category, 0 where it has none, divided by all words of the text."""
    total = F.max("total_words")
    part = lambda name: F.coalesce(F.sum(F.when(F.array_contains("categories", name), value)).cast("double"), F.lit(0.0))
    return [F.when(total > 0, part(name) / total).otherwise(0.0).alias(measure) for name, measure in CATEGORIES.items()]


def filled(scores: DataFrame, keep_empty: bool) -> DataFrame:
    return scores if keep_empty else scores.where("total_words > 0")


def proportional_scores(texts: DataFrame, lexicon: DataFrame, keep_empty: bool = True) -> DataFrame:
    """Share of each text's tokens that a category has; 0.0 for texts without tokens.

    One pass and one shuffle: a text's tokens meet the broadcast lexicon where they are and leave as one row.
    """
    words = words_of(lexicon)
    rows = known_tokens(texts, words).join(words.table, "tok", "left")
    # the total is an aggregate and no key, or a filter on it would tokenize each text once more below
    return filled(rows.groupBy(*ID).agg(F.max("total_words").alias("total_words"), *category_sums(F.lit(1))), keep_empty)


def document_frequencies(texts: DataFrame, ciks: list[int] | None = None, lexicon: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Of full texts: (tok, df), and one row n_docs, the texts with a token. ciks narrows both if texts has a cik.

    A filing has one full text, so a text's distinct tokens are counted as they are. lexicon: only its words have a df, which
    is all that scores need. They come from the counts of all sections' texts: a score of the same texts reuses their shuffle.
    """
    if ciks:
        texts = texts.where(F.col("cik").isin(ciks))
    full = texts.where(F.col("section") == "full")
    n_docs = full.where(F.col("text").rlike("[A-Za-z]")).agg(F.count("*").alias("n_docs"))
    if lexicon is None:
        return tokenized(full).select(F.explode(F.array_distinct("tokens")).alias("tok")).groupBy("tok").agg(F.count("*").alias("df")), n_docs
    one = F.when((F.col("section") == "full") & F.col("tok").isNotNull(), F.least("tf", F.lit(1)))
    # a column that isn't used, or a word that may be null, would be cut below that shuffle, which then is another one
    word = F.coalesce("tok", F.lit("")).alias("tok")
    rows = counted(texts, words_of(lexicon)).groupBy(word).agg(F.sum(one).alias("df"), F.max("total_words").alias("longest"))
    return rows.where("df > 0 and longest >= 0").select("tok", "df"), n_docs


def weighted(texts: DataFrame, lexicon: DataFrame, df: DataFrame, n_docs: DataFrame) -> tuple[DataFrame, Column]:
    """counted() with df and n_docs, and the tf-idf weight of its rows.

    n_docs is one row, and of df only lexicon words are kept, so both are broadcast as the lexicon is: by their words, all
    counts would go to a few tasks.
    """
    words = words_of(lexicon)
    known = df.join(words.table.select("tok"), "tok", "left_semi")
    rows = counted(texts, words).join(known if words.few is None else F.broadcast(known), "tok", "left").crossJoin(F.broadcast(n_docs))
    idf = F.log10("n_docs") - F.log10("df")
    return rows, F.when((F.col("df") > 0) & (F.col("n_docs") > 0) & (idf > 0), (1 + F.log10("tf")) * idf).otherwise(0.0)


def tfidf_scores(texts: DataFrame, lexicon: DataFrame, df: DataFrame, n_docs: DataFrame, keep_empty: bool = True) -> DataFrame:
    """Sum of (1 + log10 tf) * (log10 n_docs - log10 df) over a category's tokens with a positive idf, by all tokens.

    A token without a document frequency adds nothing.
    """
    rows, weight = weighted(texts, lexicon, df, n_docs)
    return filled(rows.groupBy(*ID).agg(F.max("total_words").alias("total_words"), *category_sums(weight)), keep_empty)


def score_filings(texts: DataFrame, lexicon: DataFrame, df: DataFrame | None = None, n_docs: DataFrame | None = None, scored_at: str | None = None, only: DataFrame | None = None) -> DataFrame:
    """Score rows of all texts with a token: a row for each text and weighting, both from one pass over the texts.

    df and n_docs may come from another corpus. only: the keys of the texts whose rows are wanted. They are picked after the
    count, which document frequencies of the same texts share, so that no text is shuffled.
    """
    if df is None:
        df, n_docs = document_frequencies(texts, lexicon=lexicon)
    rows, weight = weighted(texts, lexicon, df, n_docs)
    both = rows.groupBy(*ID).agg(F.max("total_words").alias("total_words"), F.struct(F.lit("proportional").alias("weighting"), *category_sums(F.col("tf"))).alias("p"), F.struct(F.lit("tfidf").alias("weighting"), *category_sums(weight)).alias("t"))
    if only is not None:
        # by <=>, which sets no filter below the count; keys that are null match nothing
        keys = only.where("accession is not null and section is not null").select(*(F.col(c).alias(f"__{c}") for c in ID)).distinct()
        both = both.join(keys, F.col("accession").eqNullSafe(F.col("__accession")) & F.col("section").eqNullSafe(F.col("__section")))
    long = both.where("total_words > 0").select(*ID, "total_words", F.explode(F.array("p", "t")).alias("s"))
    return long.select(*ID, "s.weighting", F.lit(SCORER_VERSION).alias("scorer_version"), "total_words", *(f"s.{m}" for m in MEASURES), F.lit(scored_at).cast("string").alias("scored_at"))


def eligible_keys(records: DataFrame) -> DataFrame:
    """accession and section of texts that may be scored: the full one unless its status says otherwise, a section only if its
    status is ok."""
    status = records.select("accession", F.explode(F.create_map(F.lit("full"), F.coalesce("full.status", F.lit("ok")), *(x for s in SECTIONS for x in (F.lit(s), F.col(f"{s}.status")))))).toDF("accession", "section", "__status")
    return status.where("__status = 'ok'").select(*ID)


def eligible_texts(texts: DataFrame, records: DataFrame) -> DataFrame:
    return texts.join(eligible_keys(records), ID, "left_semi")


def score_stats(scores: DataFrame, version: str = SCORER_VERSION) -> DataFrame:
    """Of each section and weighting the rows, average words (truncated) and average measures (5 digits)."""
    rows = scores.where(F.col("scorer_version") == version)
    return rows.groupBy("section", "weighting").agg(F.count("*").alias("n"), F.coalesce(F.avg("total_words"), F.lit(0.0)).cast("bigint").alias("avg_total_words"), *(F.round(F.coalesce(F.avg(m), F.lit(0.0)), 5).alias(f"avg_{m}") for m in MEASURES))


def score_totals(scores: DataFrame, version: str = SCORER_VERSION) -> DataFrame:
    return scores.where(F.col("scorer_version") == version).agg(F.count("*").alias("rows"), F.countDistinct("accession").alias("distinct_filings"))
