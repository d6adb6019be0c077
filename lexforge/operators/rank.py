"""Ranking of tickers by their mean negative score, and what reports show of it.

One row for each ticker comes from a window over (ticker, section), whose row_number <= n becomes a group limit before
the shuffle, and one aggregation with fixed sections. Decile edges are exact percentiles of one value for each ticker (a
universe of companies: thousands), a single row that is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from ..schema import MIN_FILINGS, MIN_WORDS, N_FILINGS, SECTIONS

#: Names of the sections in ranking columns.
SHORT = {"mdna": "mdna", "risk_factors": "risk"}
DISPLAYED = (10, 1)


def quarterly_scores(scores: DataFrame, filings: DataFrame, members: DataFrame, stack: str | None = None) -> DataFrame:
    """Proportional section scores of 10-Q filings, for each ticker of the filing's company (two share classes both get them)."""
    kept = scores.where((F.col("weighting") == "proportional") & F.col("section").isin(*SECTIONS))
    quarterly = filings.where(F.col("form_type") == "10-Q")
    if stack is not None:
        quarterly = quarterly.where(F.col("stack") == stack)
    return kept.select("accession", "section", "neg", "total_words").join(quarterly.select("accession", "cik", "acceptance_dt", "period_of_report"), "accession").join(members.where("cik is not null").select("ticker", "cik", "name", "sector"), "cik")


def recent(rows: DataFrame, n_filings: int = N_FILINGS, min_words: int = MIN_WORDS) -> DataFrame:
    """The latest n filings of each ticker and section among those with enough words; ties by accession, later first."""
    order = Window.partitionBy("ticker", "section").orderBy(F.desc("acceptance_dt"), F.desc("accession"))
    return rows.where(F.col("total_words") >= min_words).withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= n_filings)


def section_means(rows: DataFrame) -> DataFrame:
    """Mean negative score (nulls left out) and filings (nulls counted) of each ticker and section.

    Means have 12 digits, so that ties and deciles don't depend on the order in which a sum was made.
    """
    return rows.groupBy("ticker", "name", "sector", "section").agg(F.round(F.avg("neg"), 12).alias("mean_neg"), F.count("*").alias("filing_count"))


def pivoted(means: DataFrame) -> DataFrame:
    """Sections as columns; tickers with a null name or sector stay."""
    of = lambda s, c: F.max(F.when(F.col("section") == s, F.col(c)))
    return means.groupBy("ticker", "name", "sector").agg(*(of(s, "mean_neg").alias(f"mean_neg_{k}") for s, k in SHORT.items()), *(F.coalesce(of(s, "filing_count"), F.lit(0)).alias(f"filing_count_{k}") for s, k in SHORT.items()))


def eligible(wide: DataFrame, least: int = MIN_FILINGS) -> DataFrame:
    """Tickers with enough filings in either section; the mean of a section with too few is null."""
    enough = {k: F.col(f"filing_count_{k}") >= least for k in SHORT.values()}
    return wide.where(enough["mdna"] | enough["risk"]).withColumns({f"mean_neg_{k}": F.when(ok, F.col(f"mean_neg_{k}")) for k, ok in enough.items()})


def edges_of(value: Column) -> Column:
    """Eleven interpolated quantiles, null without values."""
    return F.percentile(F.when(~F.isnan(value), value), F.array(*(F.lit(i / 10) for i in range(11))))


def decile_of(value: Column, edges: Column) -> Column:
    """Quantile bins, closed on the right; equal edges are one and bins number from 1; null if all values are equal."""
    unique = F.array_distinct(edges)
    return F.when(value.isNotNull() & ~F.isnan(value) & (F.size(unique) > 1), F.greatest(F.lit(1), F.size(F.filter(unique, lambda q: q < value)))).cast("int")


def with_deciles(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """columns: of each column of values the name of its decile column."""
    edges = rows.agg(*(edges_of(F.col(c)).alias(f"__{c}") for c in columns))
    return rows.crossJoin(F.broadcast(edges)).withColumns({d: decile_of(F.col(c), F.col(f"__{c}")) for c, d in columns.items()}).drop(*(f"__{c}" for c in columns))


def decile_boundaries(rows: DataFrame, column: str) -> DataFrame:
    """Positions 0 to 10 and their boundaries; no rows without values."""
    return rows.agg(edges_of(F.col(column)).alias("e")).select(F.posexplode("e").alias("position", "boundary"))


def compute_ranks(scores: DataFrame, filings: DataFrame, members: DataFrame, n_filings: int = N_FILINGS, min_words: int = MIN_WORDS, stack: str | None = None) -> DataFrame:
    """The nine columns of the ranking."""
    wide = eligible(pivoted(section_means(recent(quarterly_scores(scores, filings, members, stack), n_filings, min_words))))
    ranked = with_deciles(wide, {f"mean_neg_{k}": f"decile_{k}" for k in SHORT.values()})
    return ranked.select("ticker", "name", "sector", "mean_neg_mdna", "mean_neg_risk", "filing_count_mdna", "filing_count_risk", "decile_mdna", "decile_risk")


def filing_detail(scores: DataFrame, filings: DataFrame, members: DataFrame, tickers: DataFrame | str) -> DataFrame:
    """All quarterly score rows of a ticker, or of the tickers of a frame, short ones and old ones included."""
    rows = quarterly_scores(scores, filings, members.where(F.col("ticker") == tickers) if isinstance(tickers, str) else members.join(tickers.select("ticker"), "ticker", "left_semi"))
    return rows.select("ticker", "accession", "acceptance_dt", "period_of_report", "section", "neg", "total_words")


def detail_order() -> list[Column]:
    return [F.asc("ticker"), F.desc("acceptance_dt"), F.asc("section"), F.asc("accession")]


def display_rows(detail: DataFrame) -> DataFrame:
    return detail.select("ticker", F.coalesce(F.substring("acceptance_dt", 1, 10), F.lit("")).alias("acceptance_dt"), F.coalesce("period_of_report", F.lit("")).alias("period_of_report"), "section", F.col("neg").cast("double").alias("neg"), F.col("total_words").cast("bigint").alias("total_words"))


def decile_rows(ranks: DataFrame, section: str) -> DataFrame:
    """Rank within each decile, most negative first; ties by ticker."""
    decile, mean = F.col(f"decile_{section}"), F.col(f"mean_neg_{section}")
    rank = F.row_number().over(Window.partitionBy(decile).orderBy(mean.desc(), F.asc("ticker")))
    return ranks.where(decile.isNotNull()).select(decile.alias("decile"), rank.alias("rank"), "ticker", F.coalesce("name", F.lit("")).alias("name"), F.coalesce("sector", F.lit("")).alias("sector"), names.sector_colour(F.col("sector")).alias("sector_colour"), mean.alias("mean_neg"), F.col(f"filing_count_{section}").alias("filing_count"))


def rank_order(section: str = "mdna") -> list[Column]:
    return [F.desc_nulls_last(f"decile_{section}"), F.asc("ticker")]


def scored_counts(ranks: DataFrame) -> DataFrame:
    return ranks.agg(*(F.count(f"mean_neg_{k}").alias(f"n_scored_{k}") for k in SHORT.values()))
