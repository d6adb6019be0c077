"""The engine's tables as views of the test tables, with the same views in DuckDB's SQL.

From documents: a source is a company, a document a filing whose halves are its two sections (the first: risk factors);
its times follow from its id, its sector from its number; all of that is made up. From orders and lineitem: a customer is a
company, an order a filing, a line status a section, for volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import spread
from ..schema import SECTIONS
from . import lexicon

#: Names of sectors by the company number modulo 11; fixed values.
SECTORS = ["Information Technology", "Health Care", "Financials", "Consumer Discretionary", "Industrials", "Communication Services", "Consumer Staples", "Energy", "Utilities", "Real Estate", "Unknown Sector"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def company(source: Column) -> Column:
    return F.regexp_extract(source, "([0-9]+)", 1).try_cast("bigint")


def stamp(doc_id: Column) -> Column:
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    whole = lambda c, k: F.floor(c / k)
    return F.concat((2018 + doc_id % 6).cast("string"), F.lit("-"), two(1 + whole(doc_id, 6) % 12), F.lit("-"), two(1 + whole(doc_id, 72) % 28), F.lit("T"), two(whole(doc_id, 2016) % 24), F.lit(":00:00Z"))


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    form = F.when(F.floor(F.col("doc_id") / 20) % 10 == 9, "10-K").otherwise("10-Q")
    return docs.select(F.col("doc_id").cast("string").alias("accession"), company(F.col("source")).alias("cik"), F.upper("source").alias("ticker"), form.alias("form_type"), F.substring(stamp(F.col("doc_id")), 1, 7).alias("period_of_report"), stamp(F.col("doc_id")).alias("acceptance_dt"), F.substring(stamp(F.col("doc_id")), 1, 10).alias("filing_date"), F.lit("primary.html").alias("primary_doc"), F.when(F.col("doc_id") % 7 == 0, F.lit(None).cast("string")).when(F.col("doc_id") % 7 == 1, "partial").when(F.col("doc_id") % 7 == 2, "parse_fail").otherwise("ok").alias("parse_status"), F.when(F.col("doc_id") % 11 == 0, "queried").otherwise("sp500").alias("stack"))


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = read(spark, sf_dir, "documents").select("source").distinct()
    cik = company(F.col("source"))
    sector = F.element_at(F.array(*map(F.lit, SECTORS)), (cik % 11 + 1).cast("int"))
    return sources.select(F.upper("source").alias("ticker"), F.when(cik != 13, cik).alias("cik"), F.col("source").alias("name"), F.when(cik != 7, sector).alias("sector"), F.lit(0.0).alias("weight_pct"), F.lit("2024-01-01T00:00:00Z").alias("updated_at"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("accession"), F.col("text")))
    half = F.floor(F.length("text") / 2).cast("int")
    pairs = F.array(F.struct(F.lit("full").alias("section"), F.col("text").alias("text")), F.struct(F.lit("risk_factors").alias("section"), F.substring(F.col("text"), F.lit(1), half).alias("text")), F.struct(F.lit("mdna").alias("section"), F.substring(F.col("text"), half + 1, F.length("text")).alias("text")))
    return docs.select("accession", F.explode(pairs).alias("x")).select("accession", "x.section", "x.text")


def sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """accession, risk_factors and mdna."""
    docs = spread(read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("accession"), F.col("text")))
    half = F.floor(F.length("text") / 2).cast("int")
    return docs.select("accession", F.substring(F.col("text"), F.lit(1), half).alias("risk_factors"), F.substring(F.col("text"), half + 1, F.length("text")).alias("mdna"))


def volume(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """scores, filings and members of the volume views."""
    lines = read(spark, sf_dir, "lineitem")
    section = F.when(F.col("l_linestatus") == "O", SECTIONS[0]).otherwise(SECTIONS[1])
    scores = lines.groupBy(F.col("l_orderkey").cast("string").alias("accession"), section.alias("section")).agg(F.lit("proportional").alias("weighting"), F.round(F.avg("l_discount"), 10).alias("neg"), F.sum("l_quantity").cast("bigint").alias("total_words"))
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("accession"), F.col("o_custkey").alias("cik"), F.lit("10-Q").alias("form_type"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("acceptance_dt"), F.lit(None).cast("string").alias("period_of_report"))
    customers = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return scores, orders, customers.select(F.col("c_custkey").cast("string").alias("ticker"), F.col("c_custkey").alias("cik"), F.col("c_name").alias("name"), F.col("n_name").alias("sector"))


def stamp_sql(d: str) -> str:
    two = lambda x: f"lpad(CAST(CAST({x} AS BIGINT) AS VARCHAR), 2, '0')"
    return f"(CAST(2018 + {d} % 6 AS VARCHAR) || '-' || {two(f'1 + ({d} // 6) % 12')} || '-' || {two(f'1 + ({d} // 72) % 28')} || 'T' || {two(f'({d} // 2016) % 24')} || ':00:00Z')"


CIK_SQL = "TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS BIGINT)"
#: Views by name, in the order in which later ones use earlier ones.
VIEWS = {
    "lexicon": "SELECT * FROM (VALUES " + ", ".join(f"('{w}', '{c}')" for w, c in lexicon.synthetic_rows()) + ") AS v(word, category)",
    "filings": f"SELECT CAST(doc_id AS VARCHAR) AS accession, {CIK_SQL} AS cik, upper(source) AS ticker, CASE WHEN (doc_id // 20) % 10 = 9 THEN '10-K' ELSE '10-Q' END AS form_type, substr({stamp_sql('doc_id')}, 1, 7) AS period_of_report, {stamp_sql('doc_id')} AS acceptance_dt, substr({stamp_sql('doc_id')}, 1, 10) AS filing_date, 'primary.html' AS primary_doc, CASE doc_id % 7 WHEN 0 THEN NULL WHEN 1 THEN 'partial' WHEN 2 THEN 'parse_fail' ELSE 'ok' END AS parse_status, CASE WHEN doc_id % 11 = 0 THEN 'queried' ELSE 'sp500' END AS stack FROM documents",
    "members": f"SELECT upper(source) AS ticker, CASE WHEN cik <> 13 THEN cik END AS cik, source AS name, CASE WHEN cik <> 7 THEN ([{', '.join(repr(s) for s in SECTORS)}])[cik % 11 + 1] END AS sector, 0.0::DOUBLE AS weight_pct, '2024-01-01T00:00:00Z' AS updated_at FROM (SELECT DISTINCT source, {CIK_SQL} AS cik FROM documents)",
    "sections": "SELECT CAST(doc_id AS VARCHAR) AS accession, CASE WHEN text IS NOT NULL THEN substr(text, 1, length(text) // 2) END AS risk_factors, substr(text, length(text) // 2 + 1) AS mdna, text AS full_text FROM documents",
    "texts": "SELECT accession, 'full' AS section, full_text AS text FROM sections UNION ALL SELECT accession, 'risk_factors', risk_factors FROM sections UNION ALL SELECT accession, 'mdna', mdna FROM sections",
    "toks": "SELECT accession, section, list_transform(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+'), lambda x: lower(x)) AS tokens FROM texts",
    "totals": "SELECT accession, section, CAST(len(tokens) AS BIGINT) AS total_words FROM toks",
    "tf": "SELECT accession, section, tok, count(*) AS tf FROM (SELECT accession, section, unnest(tokens) AS tok FROM toks) GROUP BY ALL",
    "df": "SELECT tok, count(*) AS df FROM tf WHERE section = 'full' GROUP BY tok",
    "n_docs": "SELECT count(*) AS n_docs FROM totals WHERE section = 'full' AND total_words > 0",
    "v_scores": "SELECT CAST(l_orderkey AS VARCHAR) AS accession, CASE WHEN l_linestatus = 'O' THEN 'mdna' ELSE 'risk_factors' END AS section, 'proportional' AS weighting, round(avg(l_discount), 10) AS neg, CAST(sum(l_quantity) AS BIGINT) AS total_words FROM lineitem GROUP BY 1, 2",
    "v_filings": "SELECT CAST(o_orderkey AS VARCHAR) AS accession, o_custkey AS cik, '10-Q' AS form_type, strftime(o_orderdate, '%Y-%m-%d') AS acceptance_dt, CAST(NULL AS VARCHAR) AS period_of_report FROM orders",
    "v_members": "SELECT CAST(c_custkey AS VARCHAR) AS ticker, c_custkey AS cik, c_name AS name, n_name AS sector FROM customer JOIN nation ON c_nationkey = n_nationkey",
}


def measure_sums(value: str) -> str:
    from ..schema import CATEGORIES

    return ", ".join(f"round(coalesce(sum({value}) FILTER (category = '{c}'), 0) / total_words, 10) AS {m}" for c, m in CATEGORIES.items())


VIEWS |= {
    "hits": "SELECT accession, section, tok, tf, category FROM tf JOIN lexicon ON tok = word",
    "proportional": f"SELECT accession, section, 'proportional' AS weighting, total_words, {measure_sums('tf')} FROM totals LEFT JOIN hits USING (accession, section) WHERE total_words > 0 GROUP BY accession, section, total_words",
    "weights": "SELECT accession, section, category, CASE WHEN log10(n_docs) - log10(df) > 0 THEN (1 + log10(tf)) * (log10(n_docs) - log10(df)) ELSE 0 END AS w FROM hits JOIN df USING (tok) CROSS JOIN n_docs",
    "tfidf": f"SELECT accession, section, 'tfidf' AS weighting, total_words, {measure_sums('w')} FROM totals LEFT JOIN weights USING (accession, section) WHERE total_words > 0 GROUP BY accession, section, total_words",
    "scores": "SELECT * FROM proportional UNION ALL SELECT * FROM tfidf",
    "quarterly": "SELECT m.ticker, m.name, m.sector, s.accession, s.section, s.neg, s.total_words, f.acceptance_dt, f.period_of_report FROM proportional s JOIN filings f USING (accession) JOIN members m ON m.cik = f.cik WHERE f.form_type = '10-Q' AND s.section IN ('mdna', 'risk_factors')",
    "recent": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, section ORDER BY acceptance_dt DESC, accession DESC) AS rn FROM quarterly WHERE total_words >= 200) WHERE rn <= 4",
    "means": "SELECT ticker, name, sector, section, round(avg(neg), 12) AS mean_neg, count(*) AS filing_count FROM recent GROUP BY ALL",
    "v_quarterly": "SELECT m.ticker, m.name, m.sector, s.accession, s.section, s.neg, s.total_words, f.acceptance_dt, f.period_of_report FROM v_scores s JOIN v_filings f USING (accession) JOIN v_members m ON m.cik = f.cik WHERE f.form_type = '10-Q'",
    "v_recent": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, section ORDER BY acceptance_dt DESC, accession DESC) AS rn FROM v_quarterly WHERE total_words >= 50) WHERE rn <= 4",
    "v_means": "SELECT ticker, name, sector, section, round(avg(neg), 12) AS mean_neg, count(*) AS filing_count FROM v_recent GROUP BY ALL",
}
for prefix in ("", "v_"):
    VIEWS |= {
        f"{prefix}wide": f"SELECT ticker, name, sector, max(mean_neg) FILTER (section = 'mdna') AS mean_neg_mdna, max(mean_neg) FILTER (section = 'risk_factors') AS mean_neg_risk, coalesce(max(filing_count) FILTER (section = 'mdna'), 0) AS filing_count_mdna, coalesce(max(filing_count) FILTER (section = 'risk_factors'), 0) AS filing_count_risk FROM {prefix}means GROUP BY ticker, name, sector",
        f"{prefix}eligible": f"SELECT ticker, name, sector, CASE WHEN filing_count_mdna >= 2 THEN mean_neg_mdna END AS mean_neg_mdna, CASE WHEN filing_count_risk >= 2 THEN mean_neg_risk END AS mean_neg_risk, filing_count_mdna, filing_count_risk FROM {prefix}wide WHERE filing_count_mdna >= 2 OR filing_count_risk >= 2",
        f"{prefix}edges": "SELECT " + ", ".join(f"list_distinct(quantile_cont(mean_neg_{k}, [{', '.join(str(i / 10) for i in range(11))}])) AS e_{k}" for k in ("mdna", "risk")) + f" FROM {prefix}eligible",
        f"{prefix}ranks": "SELECT ticker, name, sector, mean_neg_mdna, mean_neg_risk, filing_count_mdna, filing_count_risk, " + ", ".join(f"CAST(CASE WHEN mean_neg_{k} IS NOT NULL AND len(e_{k}) > 1 THEN greatest(1, len(list_filter(e_{k}, lambda q: q < mean_neg_{k}))) END AS INTEGER) AS decile_{k}" for k in ("mdna", "risk")) + f" FROM {prefix}eligible CROSS JOIN {prefix}edges",
    }
WORDS_SQL = "CAST(len(list_filter(regexp_split_to_array(coalesce({0}, ''), '\\s+'), lambda w: w <> '')) AS BIGINT)"
REFERS_SQL = "regexp_matches(coalesce({0}, ''), '(?i)\\bincorporated\\b(?:\\s+\\w+){{0,3}}\\s+by\\b(?:\\s+\\w+){{0,1}}\\s+reference\\b|\\bsee\\s+our\\s+proxy\\b|\\bannual\\s+proxy\\s+statement\\b')"


def record_sql(text: str, floor: str, least: str, prefix: str) -> str:
    n = WORDS_SQL.format(text)
    return f"CASE WHEN coalesce(length({text}), 0) = 0 THEN 'missing' WHEN {n} < 500 AND {REFERS_SQL.format(text)} THEN 'incorp_ref' WHEN {n} < {floor} THEN 'missing' WHEN {n} > 50000 OR (full_words > 0 AND {n} > full_words * 0.95) THEN 'over_extracted' ELSE 'ok' END AS {prefix}_status, {n} AS {prefix}_words, CASE WHEN coalesce(length({text}), 0) = 0 THEN '' WHEN {n} < 500 AND {REFERS_SQL.format(text)} THEN 'incorp_ref_phrase' WHEN {n} < {floor} THEN 'below_hard_floor' WHEN {n} > 50000 THEN 'length_high' WHEN full_words > 0 AND {n} > full_words * 0.95 THEN 'equal_to_full' WHEN {n} < {least} THEN 'length_low' ELSE '' END AS {prefix}_flags"


VIEWS |= {
    "full_words": f"SELECT s.*, f.cik, f.form_type, f.filing_date, f.parse_status, {WORDS_SQL.format('full_text')} AS full_words FROM sections s JOIN filings f USING (accession)",
    "records": f"SELECT *, CASE WHEN rf_status = 'over_extracted' OR md_status = 'over_extracted' THEN 'section_fail' WHEN rf_status = 'ok' AND md_status = 'ok' THEN 'ok' WHEN rf_status = 'ok' OR md_status = 'ok' THEN 'partial' ELSE 'section_fail' END AS pair_status, CASE WHEN full_words >= 1000 THEN 'ok' ELSE 'parse_fail' END AS full_status FROM (SELECT *, {record_sql('risk_factors', '0', 'CASE WHEN form_type = ' + chr(39) + '10-Q' + chr(39) + ' THEN 0 ELSE 1000 END', 'rf')}, {record_sql('mdna', '100', '1000', 'md')} FROM full_words)",
    "long_records": "SELECT cik, accession, filing_date, parse_status, 'risk_factors' AS section, rf_status AS status, rf_words AS word_count, rf_flags AS flags FROM records UNION ALL SELECT cik, accession, filing_date, parse_status, 'mdna', md_status, md_words, md_flags FROM records",
    "jumps": "SELECT * FROM (SELECT *, lag(word_count) OVER (PARTITION BY cik, section ORDER BY coalesce(filing_date, ''), accession) AS previous FROM long_records)",
}


def oracle(body: str) -> str:
    """The body after WITH and the views that it uses, themselves and through others."""
    import re

    used, todo = set(), [body]
    while todo:
        names = {n for n in re.findall(r"\w+", todo.pop()) if n in VIEWS} - used
        used |= names
        todo += [VIEWS[n] for n in names]
    head = ", ".join(f"{n} AS ({VIEWS[n]})" for n in VIEWS if n in used)
    return f"WITH {head} {body}" if head else body
