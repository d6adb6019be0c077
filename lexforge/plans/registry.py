"""Queries by operator id, each over whole tables, and SQL that gives the same rows.

Doubles are rounded to 10 digits, as sums depend on the order of their parts. Arrays of flags are joined with commas.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html, names
from ..functions import text as fn
from ..operators import diagnose, rank, score, select
from ..runtime import shared_folder
from ..schema import CATEGORIES, EXTRACTOR_VERSION, MEASURES, SCORER_VERSION
from ..sources import driver, lexicon, store
from ..sources.driver import WORDS_SQL, oracle, read
from . import report

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Words a section needs in the queries over orders, whose "words" are quantities.
VOLUME_WORDS = 50


def query(name: str, sql: str | None = None):
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return function

    return add


def rounded(df: DataFrame, digits: int = 10) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def lex(spark: SparkSession) -> DataFrame:
    return lexicon.synthetic(spark)


def scores(spark: SparkSession, d: str) -> DataFrame:
    return rounded(score.score_filings(driver.texts(spark, d), lex(spark)))


def ranks(spark: SparkSession, d: str) -> DataFrame:
    proportional = rounded(score.proportional_scores(driver.texts(spark, d), lex(spark), keep_empty=False)).withColumn("weighting", F.lit("proportional"))
    return rank.compute_ranks(proportional, driver.filings(spark, d), driver.members(spark, d))


def volume_ranks(spark: SparkSession, d: str) -> DataFrame:
    return rank.compute_ranks(*driver.volume(spark, d), min_words=VOLUME_WORDS)


def quarterly(spark: SparkSession, d: str) -> DataFrame:
    return rank.quarterly_scores(*driver.volume(spark, d))


def records(spark: SparkSession, d: str) -> DataFrame:
    parsed = diagnose.parse_records(driver.filings(spark, d), driver.texts(spark, d))
    return diagnose.section_records(parsed, driver.sections(spark, d))


def docs(spark: SparkSession, d: str, *columns) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", *columns)


def TEXT():
    return F.col("text")


SCORE_COLUMNS = ["accession", "section", "weighting", "total_words", *MEASURES]
ROUNDED_MEASURES = ", ".join(MEASURES)
EMPTY_SCORES = ", ".join(f"coalesce(p.{m}, 0.0) AS {m}" for m in MEASURES)
RANK_SQL = "SELECT ticker, name, sector, round(mean_neg_mdna, 8) AS mean_neg_mdna, round(mean_neg_risk, 8) AS mean_neg_risk, filing_count_mdna, filing_count_risk, decile_mdna, decile_risk FROM "

# --- text and name functions ---------------------------------------------------------------------------------------


@query("txt01", "SELECT accession AS id, array_to_string(tokens, ' ') AS tokens FROM toks WHERE section = 'full'")
def txt01(spark, d):
    return read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.array_join(fn.tokens(TEXT()), " ").alias("tokens"))


@query("txt02", f"SELECT doc_id, {WORDS_SQL.format('text')} AS words FROM documents")
def txt02(spark, d):
    return docs(spark, d, fn.word_count(TEXT()).alias("words"))


@query("txt03", "SELECT doc_id, CAST(length(coalesce(text, '')) AS BIGINT) AS chars FROM documents")
def txt03(spark, d):
    return docs(spark, d, fn.char_count(TEXT()).alias("chars"))


@query("txt04", "SELECT doc_id, round(CASE WHEN length(coalesce(text, '')) = 0 THEN 1.0 ELSE 1 - length(regexp_replace(text, '[^\\p{L}]', '', 'g'))::DOUBLE / length(text) END, 4) AS ratio FROM documents")
def txt04(spark, d):
    return docs(spark, d, F.round(fn.non_letter_ratio(TEXT()), 4).alias("ratio"))


@query("txt05", "SELECT doc_id, round(CASE WHEN length(coalesce(text, '')) = 0 THEN 0.0 ELSE length(regexp_replace(text, '[\\x00-\\x7f]', '', 'g'))::DOUBLE / length(text) END, 4) AS ratio FROM documents")
def txt05(spark, d):
    return docs(spark, d, F.round(fn.non_ascii_ratio(TEXT()), 4).alias("ratio"))


@query("txt06", f"SELECT doc_id, array_to_string(list_filter([CASE WHEN n < 5000 THEN 'word_count_low' END, CASE WHEN n > 250000 THEN 'word_count_high' END, CASE WHEN CASE WHEN c = 0 THEN 1.0 ELSE 1 - length(regexp_replace(text, '[^\\p{{L}}]', '', 'g'))::DOUBLE / c END > 0.5 THEN 'low_alpha_ratio' END, CASE WHEN c > 0 AND length(regexp_replace(text, '[\\x00-\\x7f]', '', 'g'))::DOUBLE / c > 0.05 THEN 'non_ascii_dense' END], lambda x: x IS NOT NULL), ',') AS flags FROM (SELECT doc_id, text, length(coalesce(text, '')) AS c, {WORDS_SQL.format('text')} AS n FROM documents)")
def txt06(spark, d):
    return docs(spark, d, F.array_join(fn.full_text_flags(TEXT()), ",").alias("flags"))


@query("txt07")
def txt07(spark, d):
    return read(spark, d, "pages").select("page_id", html.clean_html(F.col("html"))["text"].alias("text"))


@query("txt08")
def txt08(spark, d):
    return docs(spark, d, html.nfkc(TEXT()).alias("text"))


@query("txt09", "SELECT doc_id, md5(replace(translate(text, '‘’‚‛“”„‟–—− ', '''''''''\"\"\"\"--- '), '…', '...')) AS folded FROM documents")
def txt09(spark, d):
    return docs(spark, d, F.md5(fn.fold_punctuation(TEXT())).alias("folded"))


@query("txt10", "SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(html, '[ \\t]+', ' ', 'g'), '\\n{2,}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')) AS collapsed FROM pages")
def txt10(spark, d):
    return read(spark, d, "pages").select("page_id", F.md5(fn.collapse_space(F.col("html"))).alias("collapsed"))


@query("txt11", f"SELECT doc_id, CASE WHEN {WORDS_SQL.format('text')} >= 1000 THEN 'ok' ELSE 'parse_fail' END AS status FROM documents")
def txt11(spark, d):
    return docs(spark, d, fn.parse_status(fn.word_count(TEXT())).alias("status"))


STRIPPED = "regexp_replace(coalesce({0}, ''), '^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+$', '', 'g')"


@query("txt12", f"SELECT accession, {STRIPPED.format('risk_factors')} AS mdna, {STRIPPED.format('mdna')} AS risk_factors FROM sections")
def txt12(spark, d):
    """Sections by their headings, in quarterly reports made of the documents' halves, after a table of contents."""
    from ..functions import sections

    body = F.concat(F.lit("PART I\nItem 2.\nPART II\nItem 1A.\nItem 6.\nPART I\nItem 2.\n"), F.coalesce("risk_factors", F.lit("")), F.lit("\nPART II\nItem 1A.\n"), F.coalesce("mdna", F.lit("")), F.lit("\nItem 6.\n"))
    return driver.sections(spark, d).select("accession", sections.split_sections(body, F.lit("10-Q")).alias("s")).select("accession", "s.mdna", "s.risk_factors")


@query("txt16", "SELECT accession, CASE WHEN accession::BIGINT % 3 = 0 THEN 'section_fail' WHEN full_status <> 'ok' THEN full_status ELSE pair_status END AS status, CASE WHEN accession::BIGINT % 3 = 0 THEN 'raw_missing' ELSE rf_flags END AS flag, CASE WHEN accession::BIGINT % 3 = 0 THEN 'missing' ELSE md_status END AS mdna FROM records")
def txt16(spark, d):
    """Every third filing's raw file is gone."""
    parsed = diagnose.parse_records(driver.filings(spark, d), driver.texts(spark, d))
    gone = F.when(F.col("accession").cast("bigint") % 3 == 0, "raw_missing")
    made = diagnose.section_records(parsed, driver.sections(spark, d).withColumn("error", gone))
    return made.select("accession", "status", F.array_join("risk_factors.suspicious_flags", ",").alias("flag"), F.col("mdna.status").alias("mdna"))


@query("txt13", f"SELECT doc_id, {driver.REFERS_SQL.format('text')} AS refers FROM documents")
def txt13(spark, d):
    return docs(spark, d, fn.by_reference(TEXT()).alias("refers"))


@query("txt14", "SELECT accession, section, status, word_count, flags FROM long_records")
def txt14(spark, d):
    return diagnose.long_sections(records(spark, d)).select("accession", "section", "status", "word_count", F.array_join("suspicious_flags", ",").alias("flags"))


@query("txt15", "SELECT accession, CASE WHEN full_status <> 'ok' THEN full_status ELSE pair_status END AS status, pair_status FROM records")
def txt15(spark, d):
    pair = fn.filing_status(F.lit("ok"), F.col("risk_factors.status"), F.col("mdna.status"))
    return records(spark, d).select("accession", "status", pair.alias("pair_status"))


@query("str01", "SELECT c_custkey, replace(upper(trim(' ' || lower(c_mktsegment) || '.b ')), '.', '-') AS ticker FROM customer")
def str01(spark, d):
    return read(spark, d, "customer").select("c_custkey", names.ticker(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(".b "))).alias("ticker"))


@query("str02", "SELECT c_custkey, TRY_CAST(trim(raw) AS BIGINT) AS cik FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN ' 000' || c_custkey || ' ' ELSE ' ' END AS raw FROM customer)")
def str02(spark, d):
    key = F.col("c_custkey")
    raw = F.when(key % 3 == 0, F.col("c_name")).when(key % 3 == 1, F.concat(F.lit(" 000"), key.cast("string"), F.lit(" "))).otherwise(" ")
    return read(spark, d, "customer").select("c_custkey", names.cik(raw).alias("cik"))


@query("str03", "SELECT c_custkey, CASE WHEN length(c_custkey::VARCHAR) >= 10 THEN c_custkey::VARCHAR ELSE lpad(c_custkey::VARCHAR, 10, '0') END AS padded FROM customer")
def str03(spark, d):
    return read(spark, d, "customer").select("c_custkey", names.cik_padded(F.col("c_custkey")).alias("padded"))


@query("str04", f"SELECT o_orderkey, '{names.SUBMISSIONS_BASE}CIK' || lpad(o_custkey::VARCHAR, 10, '0') || '.json' AS submissions, '{names.ARCHIVES_BASE}' || o_custkey || '/' || replace(o_orderpriority, '-', '') || '/primary.htm' AS document, '{names.SUBMISSIONS_BASE}' || o_orderpriority AS extra FROM orders")
def str04(spark, d):
    return read(spark, d, "orders").select("o_orderkey", names.submissions_url(F.col("o_custkey")).alias("submissions"), names.document_url(F.col("o_custkey"), F.col("o_orderpriority"), F.lit("primary.htm")).alias("document"), names.extra_url(F.col("o_orderpriority")).alias("extra"))


@query("str05", "SELECT doc_id, CAST(CASE WHEN coalesce(part, '') <> '' THEN coalesce(strpos(text, part), 0) - 1 ELSE -1 END AS INTEGER) AS place FROM (SELECT doc_id, text, CASE WHEN doc_id % 5 = 0 THEN 'no such words' WHEN doc_id % 5 = 1 THEN '' ELSE substr(text, 1 + CAST(doc_id % 90 AS INTEGER), 20) END AS part FROM documents)")
def str05(spark, d):
    key = F.col("doc_id")
    part = F.when(key % 5 == 0, "no such words").when(key % 5 == 1, "").otherwise(F.substring(TEXT(), (1 + key % 90).cast("int"), F.lit(20)))
    return docs(spark, d, TEXT(), part.alias("part")).select("doc_id", names.find("text", "part").alias("place"))


@query("str06", "SELECT ticker, CASE sector " + " ".join(f"WHEN '{s}' THEN '{c}'" for s, c in names.COLOURS.items()) + f" ELSE '{names.OTHER_COLOUR}' END AS colour FROM members")
def str06(spark, d):
    return driver.members(spark, d).select("ticker", names.sector_colour(F.col("sector")).alias("colour"))


@query("dat01", "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'garbled' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS accepted FROM events")
def dat01(spark, d):
    raw = F.when(F.col("event_id") % 5 == 0, "garbled").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    return read(spark, d, "events").select("event_id", names.acceptance(raw).alias("accepted"))


@query("dat03", "SELECT accession, TRY_CAST(substr(filing_date, 1, 4) AS INTEGER) AS year FROM filings")
def dat03(spark, d):
    return driver.filings(spark, d).select("accession", names.year(F.col("filing_date")).alias("year"))


@query("mth01", "SELECT o_orderkey, round(log10(o_totalprice), 10) AS log_price, greatest(o_totalprice, o_custkey) / least(o_totalprice, o_custkey) AS ratio FROM orders WHERE o_totalprice > 0 AND o_custkey > 0")
def mth01(spark, d):
    price, key = F.col("o_totalprice"), F.col("o_custkey")
    return read(spark, d, "orders").where((price > 0) & (key > 0)).select("o_orderkey", F.round(F.log10(price), 10).alias("log_price"), fn.jump_ratio(price, key.cast("double")).alias("ratio"))


@query("arr01", "SELECT section, flags AS flag, count(*) AS n FROM long_records WHERE flags <> '' GROUP BY ALL")
def arr01(spark, d):
    return diagnose.flag_tally(diagnose.long_sections(records(spark, d)), "section")


# --- sources and stores --------------------------------------------------------------------------------------------


def wide_lexicon(spark):
    words = lex(spark).groupBy(F.col("word").alias("Word")).pivot("category", list(CATEGORIES)).agg(F.max(F.when(F.col("category").isNotNull(), "2009")))
    return words.select(F.concat(F.lit(" "), F.upper("Word")).alias("Word"), *(F.coalesce(c, F.lit("0")).alias(c) for c in CATEGORIES))


@query("src11")
def src11(spark, d):
    """Pages as filings' bytes; every seventh is cut off and every eleventh is gone."""
    from ..sources import raw

    pages = read(spark, d, "pages").select(F.col("page_id").cast("string").alias("accession"), F.when(F.col("page_id") % 7 == 0, F.unhex(F.lit("1f8b0800"))).otherwise(F.col("html").cast("binary")).alias("content"))
    return raw.parsed(pages.where("cast(accession as bigint) % 11 != 0"), pages).select("accession", "full.word_count", "full.status", F.col("error").isNotNull().alias("failed"))


@query("src05", "SELECT upper(ticker) AS ticker, arg_max(cik, place) AS cik FROM (SELECT c_custkey AS place, c_custkey + 1000 AS cik, lower(c_mktsegment) || (c_custkey % 97) AS ticker FROM customer) GROUP BY 1")
def src05(spark, d):
    """Ticker lists as JSON objects of numbered entries."""
    from ..sources import edgar

    key = F.col("c_custkey")
    entry = F.create_map(key.cast("string"), F.struct((key + 1000).alias("cik_str"), F.concat(F.lower("c_mktsegment"), (key % 97).cast("string")).alias("ticker"), F.col("c_name").alias("title")))
    return edgar.read_tickers(read(spark, d, "customer").select(F.to_json(entry).alias("json")))


@query("src10", "SELECT o_orderkey::VARCHAR AS accession, strftime(o_orderdate, '%Y-%m-%d') AS filed, CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1 THEN 'period' END AS period FROM orders")
def src10(spark, d):
    """Filing lists as blocks of parallel arrays, one of which is shorter."""
    from ..sources import edgar

    rows = read(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")))).alias("x"))
    keys, days = F.transform("x", lambda r: r["o_orderkey"].cast("string")), F.transform("x", lambda r: r["day"])
    block = F.struct(keys.alias("accessionNumber"), F.transform("x", lambda r: F.lit("10-Q")).alias("form"), days.alias("filingDate"), F.array(F.lit("period")).alias("reportDate"), days.alias("acceptanceDateTime"), keys.alias("primaryDocument"))
    return edgar.listed_filings(rows.select(block.alias("block"))).select(F.col("accessionNumber").alias("accession"), F.col("filingDate").alias("filed"), F.col("reportDate").alias("period"))


@query("src12", "SELECT DISTINCT word, category FROM lexicon")
def src12(spark, d):
    return lexicon.from_wide(wide_lexicon(spark))


@query("src13", "SELECT category, count(*) AS n FROM lexicon GROUP BY category")
def src13(spark, d):
    return lexicon.counts(lexicon.from_wide(wide_lexicon(spark)))


@query("src16", "SELECT accession, CASE WHEN full_status <> 'ok' THEN full_status ELSE pair_status END AS status, full_words AS words FROM records")
def src16(spark, d):
    """Section records through JSON and back."""
    from ..sources import raw

    return raw.records_from_json(raw.records_to_json(records(spark, d))).select("accession", "status", F.col("full.word_count").alias("words"))


@query("snk02", "SELECT o_orderkey::VARCHAR AS accession, o_orderstatus AS form FROM orders WHERE o_orderkey % 2 = 1")
def snk02(spark, d):
    rows = read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("accession"), F.col("o_orderstatus").alias("form"))
    return store.insert_or_ignore(rows.where("cast(accession as bigint) % 2 = 0"), rows.unionByName(rows), ["accession"])


@query("snk03", "SELECT CAST(l_orderkey AS VARCHAR) AS accession, l_linestatus AS section, round(CASE WHEN l_orderkey % 2 = 0 THEN 1 + avg(l_discount) ELSE avg(l_discount) END, 10) AS neg FROM lineitem GROUP BY l_orderkey, l_linestatus")
def snk03(spark, d):
    old = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("accession"), F.col("l_linestatus").alias("section")).agg(F.avg("l_discount").alias("neg"))
    new = old.where("cast(accession as bigint) % 2 = 0").withColumn("neg", 1 + F.col("neg"))
    return rounded(store.insert_or_replace(old, new, ["accession", "section"]))


@query("snk04", "SELECT c_name AS ticker, CASE WHEN c_custkey % 5 > 0 THEN c_custkey END AS cik, c_name AS name, c_mktsegment AS sector, 0.0::DOUBLE AS weight_pct, '2024-01-01T00:00:00Z' AS updated_at FROM customer")
def snk04(spark, d):
    page = read(spark, d, "customer").select(F.col("c_name").alias("ticker"), F.when(F.col("c_custkey") % 5 > 0, F.col("c_custkey")).alias("cik"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("sector"))
    return store.replaced_members(page, "2024-01-01T00:00:00Z")


@query("snk05", "SELECT f.accession, CASE WHEN full_status <> 'ok' AND f.form_type = '10-Q' THEN full_status WHEN f.form_type = '10-Q' THEN pair_status ELSE f.parse_status END AS parse_status FROM filings f JOIN records USING (accession)")
def snk05(spark, d):
    status = records(spark, d).where("form_type = '10-Q'").select("accession", F.col("status").alias("parse_status"))
    return store.with_status(driver.filings(spark, d), status).select("accession", "parse_status")


@query("snk11", "SELECT 'filings' AS table_name, count(*) AS n FROM v_filings UNION ALL SELECT 'members', count(*) FROM v_members UNION ALL SELECT 'scores', count(*) FROM v_scores")
def snk11(spark, d):
    s, f, m = driver.volume(spark, d)
    return diagnose.table_counts(filings=f, members=m, scores=s)


@query("snk01", "SELECT o_orderkey::VARCHAR AS accession, CASE WHEN o_orderkey % 3 = 0 THEN 'changed' WHEN o_orderkey % 2 = 0 THEN 'first' ELSE 'added' END AS form_type FROM orders")
def snk01(spark, d):
    """A table of the store, made, filled, changed and read: half of the rows, a third of all once more, and the rest."""
    s = store.Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4()}").ensure()
    rows = read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("accession"), F.lit("first").alias("form_type"))
    key = F.col("accession").cast("bigint")
    s.replace("filings", rows.where(key % 2 == 0))
    s.upsert("filings", rows.where(key % 3 == 0).withColumn("form_type", F.lit("changed")))
    s.append_new("filings", rows.withColumn("form_type", F.lit("added")))
    return s.read("filings").select("accession", "form_type")


@query("snk10", "SELECT table_name, CAST(0 AS BIGINT) AS n FROM (VALUES ('filings'), ('members'), ('scores')) t(table_name)")
def snk10(spark, d):
    """New tables are there and empty."""
    return store.Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4()}").ensure().counts()


@query("snk12")
def snk12(spark, d):
    """The sheet of filings to be labelled by hand."""
    r, f = records(spark, d), driver.filings(spark, d)
    return diagnose.validation_sheet(diagnose.validation_set(diagnose.flagged_records(r, f), f, 40))


@query("jsn01", "SELECT accession, CASE WHEN full_status <> 'ok' THEN full_status ELSE pair_status END AS status, full_words AS words, rf_status AS risk, md_flags AS flag FROM records")
def jsn01(spark, d):
    """Fields of the records' JSON."""
    from ..sources import raw

    at = lambda path: F.get_json_object("json", path)
    flag = F.coalesce(at("$.mdna.suspicious_flags[0]"), F.lit(""))
    return raw.records_to_json(records(spark, d)).select("accession", at("$.status").alias("status"), at("$.full.word_count").cast("bigint").alias("words"), at("$.risk_factors.status").alias("risk"), flag.alias("flag"))


# --- filters and joins ---------------------------------------------------------------------------------------------

LISTED_SQL = "SELECT o_orderkey::VARCHAR AS accession, form, filing_date FROM (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' WHEN 2 THEN '10-Q/A' ELSE '8-K' END AS form, strftime(o_orderdate, '%Y-%m-%d') AS filing_date FROM orders)"


def listed(spark, d):
    key = F.col("o_orderkey")
    form = F.when(key % 4 == 0, "10-K").when(key % 4 == 1, "10-Q").when(key % 4 == 2, "10-Q/A").otherwise("8-K")
    date = F.date_format("o_orderdate", "yyyy-MM-dd")
    return read(spark, d, "orders").select(key.cast("string").alias("accessionNumber"), form.alias("form"), date.alias("filingDate"), F.lit(None).cast("string").alias("reportDate"), F.concat(date, F.lit("T10:00:00.000Z")).alias("acceptanceDateTime"), F.when(key % 9 > 0, "primary.htm").otherwise(" ").alias("primaryDocument"))


@query("flt01", f"SELECT accession, form, filing_date || 'T10:00:00Z' AS acceptance_dt FROM ({LISTED_SQL}) WHERE form IN ('10-Q', '10-Q/A') AND filing_date >= '1995-06-01' AND accession::BIGINT % 9 > 0")
def flt01(spark, d):
    return select.target_filings(listed(spark, d), ["10-Q"], "1995-06-01", amendments=True).select(F.col("accessionNumber").alias("accession"), "form", "acceptance_dt")


@query("flt02", "SELECT 'stack' AS kind, ticker, cik FROM members WHERE cik IS NOT NULL UNION ALL SELECT 'given', min(m.ticker), c.cik FROM (SELECT DISTINCT o_custkey AS cik FROM orders) c LEFT JOIN members m ON m.cik = c.cik GROUP BY c.cik")
def flt02(spark, d):
    members = driver.members(spark, d)
    given = read(spark, d, "orders").select(F.col("o_custkey").alias("cik")).distinct()
    both = select.universe(members, "sp500").select(F.lit("stack").alias("kind"), "ticker", "cik")
    return both.unionByName(select.universe(members, "sp500", given).select(F.lit("given").alias("kind"), "ticker", "cik"))


@query("flt03", "SELECT accession FROM v_filings WHERE accession::BIGINT % 3 = 0")
def flt03(spark, d):
    f = driver.volume(spark, d)[1]
    marks = f.where("cast(accession as bigint) % 3 = 0").select("accession")
    return select.complete_filings(f, marks.unionByName(marks)).select("accession")


@query("flt04", "SELECT accession FROM filings WHERE parse_status IS NULL OR accession::BIGINT % 3 = 0")
def flt04(spark, d):
    have = driver.texts(spark, d).where("cast(accession as bigint) % 3 != 0")
    return select.to_parse(driver.filings(spark, d), have).select("accession")


@query("flt05", "SELECT accession FROM filings WHERE parse_status = 'ok' AND stack = 'sp500' AND form_type IN ('10-K', '10-Q') AND accession::BIGINT % 5 <> 0")
def flt05(spark, d):
    done = driver.filings(spark, d).where("cast(accession as bigint) % 5 = 0").select("accession", F.lit(EXTRACTOR_VERSION).alias("section_extractor_version"))
    return select.to_extract(driver.filings(spark, d), done).select("accession")


@query("flt06", "SELECT accession FROM filings WHERE parse_status IN ('ok', 'partial', 'section_fail') AND accession::BIGINT % 5 <> 0")
def flt06(spark, d):
    done = driver.filings(spark, d).where("cast(accession as bigint) % 5 = 0").select("accession", F.lit(SCORER_VERSION).alias("scorer_version"))
    return select.to_score(driver.filings(spark, d), done).select("accession")


@query("flt07", "SELECT accession, 'full' AS section FROM records WHERE full_status = 'ok' UNION ALL SELECT accession, section FROM long_records WHERE status = 'ok'")
def flt07(spark, d):
    return score.eligible_texts(driver.texts(spark, d), records(spark, d)).select("accession", "section")


@query("flt08", "SELECT accession, section, total_words FROM v_quarterly WHERE total_words >= 50")
def flt08(spark, d):
    return quarterly(spark, d).where(F.col("total_words") >= VOLUME_WORDS).select("accession", "section", "total_words")


@query("flt09", "SELECT ticker, cik, name, coalesce(sector, '') AS sector FROM members WHERE cik IS NOT NULL")
def flt09(spark, d):
    return select.members_with_ciks(driver.members(spark, d))


@query("prj02", "SELECT ticker, coalesce(substr(acceptance_dt, 1, 10), '') AS acceptance_dt, coalesce(period_of_report, '') AS period_of_report, section, round(neg, 10) AS neg, total_words FROM v_quarterly")
def prj02(spark, d):
    s, f, m = driver.volume(spark, d)
    return rounded(rank.display_rows(rank.filing_detail(s, f, m, m)))


@query("joi01", "SELECT ticker, accession, section, round(neg, 10) AS neg, total_words FROM v_quarterly")
def joi01(spark, d):
    return rounded(quarterly(spark, d).select("ticker", "accession", "section", "neg", "total_words"))


@query("joi02", "SELECT accession, acceptance_dt, section, round(neg, 10) AS neg, total_words FROM v_quarterly WHERE ticker = '7'")
def joi02(spark, d):
    return rounded(rank.filing_detail(*driver.volume(spark, d), "7").select("accession", "acceptance_dt", "section", "neg", "total_words"))


@query("joi03", "SELECT ticker, accession, section, round(neg, 10) AS neg FROM v_quarterly WHERE ticker IN (SELECT ticker FROM v_ranks WHERE decile_mdna IN (1, 10) OR decile_risk IN (1, 10))")
def joi03(spark, d):
    visible = volume_ranks(spark, d).where(F.col("decile_mdna").isin(1, 10) | F.col("decile_risk").isin(1, 10))
    return rounded(rank.filing_detail(*driver.volume(spark, d), visible).select("ticker", "accession", "section", "neg"))


@query("joi04", "SELECT c_name AS ticker, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_custkey END, CASE WHEN c_custkey % 2 = 0 THEN 1000000 + c_custkey END) AS cik, (c_custkey % 3 = 0 OR c_custkey % 2 = 0) AS resolved FROM customer")
def joi04(spark, d):
    customers, key = read(spark, d, "customer"), F.col("c_custkey")
    page = customers.select(F.col("c_name").alias("ticker"), F.when(key % 3 == 0, key).alias("cik"))
    return select.resolved_members(page, customers.where(key % 2 == 0).select(F.col("c_name").alias("ticker"), (key + 1_000_000).alias("cik")))


@query("joi05", "SELECT accession FROM v_filings WHERE accession NOT IN (SELECT accession FROM v_scores WHERE section = 'mdna')")
def joi05(spark, d):
    s, f, _ = driver.volume(spark, d)
    return f.join(s.where("section = 'mdna'").select("accession"), "accession", "left_anti").select("accession")


@query("joi06", "SELECT accession, section, category, CAST(sum(tf) AS BIGINT) AS hits FROM hits GROUP BY ALL")
def joi06(spark, d):
    found = score.lexicon_frequencies(driver.texts(spark, d), lex(spark))
    return found.select("accession", "section", F.explode("categories").alias("category"), "tf").groupBy("accession", "section", "category").agg(F.sum("tf").alias("hits"))


@query("joi07", "SELECT accession, section, tok, tf, df FROM (SELECT DISTINCT accession, section, tok, tf FROM hits) JOIN df USING (tok)")
def joi07(spark, d):
    texts = driver.texts(spark, d)
    df, _ = score.document_frequencies(texts)
    return score.lexicon_frequencies(texts, lex(spark)).join(df, "tok").select("accession", "section", "tok", "tf", "df")


@query("joi08", "SELECT accession, section, word_count, filing_date FROM long_records")
def joi08(spark, d):
    return diagnose.long_sections(records(spark, d)).join(driver.filings(spark, d).select("accession", "filing_date"), "accession", "left").select("accession", "section", "word_count", "filing_date")


@query("joi09", "SELECT section, count(*) AS labelled, count(*) FILTER (text <> '') AS found, count(*) FILTER (text <> '' AND label_start >= 0 AND start >= 0 AND abs(label_start - start) <= 200) AS start_ok, count(*) FILTER (text <> '' AND label_end >= 0 AND start >= 0 AND abs(label_end - (start + length(text))) <= 1000) AS end_ok FROM (SELECT section, text, CASE WHEN head <> '' THEN strpos(full_text, head) - 1 ELSE -1 END AS label_start, CASE WHEN tail <> '' THEN strpos(full_text, tail) - 1 ELSE -1 END AS label_end, CASE WHEN text <> '' THEN strpos(full_text, substr(text, 1, 200)) - 1 ELSE -1 END AS start FROM (SELECT 'risk_factors' AS section, coalesce(risk_factors, '') AS text, coalesce(full_text, '') AS full_text, coalesce(substr(risk_factors, 1 + CAST(accession::BIGINT % 3 AS INTEGER) * 150, 40), '') AS head, coalesce(right(risk_factors, 30), '') AS tail FROM sections UNION ALL SELECT 'mdna', coalesce(mdna, ''), coalesce(full_text, ''), coalesce(left(mdna, 25), ''), '') WHERE head <> '' OR tail <> '') GROUP BY section".replace(", '') WHERE", ", '' FROM sections) WHERE"))
def joi09(spark, d):
    """Sections against labels: the first characters of some, off by a little in others, and the ends of one kind."""
    rows = driver.sections(spark, d)
    shift = (1 + F.col("accession").cast("bigint") % 3 * 150).cast("int")
    labels = rows.select(F.lit(1).cast("bigint").alias("cik"), "accession", F.substring(F.col("risk_factors"), shift, F.lit(40)).alias("risk_factors_start_substring"), F.right("risk_factors", F.lit(30)).alias("risk_factors_end_substring"), F.left("mdna", F.lit(25)).alias("mdna_start_substring"), F.lit("").alias("mdna_end_substring"))
    return diagnose.validation_accuracy(labels, driver.texts(spark, d))


# --- aggregations --------------------------------------------------------------------------------------------------


@query("agg01", "SELECT accession, tok, tf FROM tf WHERE section = 'full'")
def agg01(spark, d):
    return score.term_frequencies(driver.texts(spark, d).where("section = 'full'")).select("accession", "tok", "tf")


@query("agg02", f"SELECT t.accession, t.section, t.total_words, {EMPTY_SCORES} FROM totals t LEFT JOIN proportional p USING (accession, section)")
def agg02(spark, d):
    return rounded(score.proportional_scores(driver.texts(spark, d), lex(spark)))


@query("agg03", f"SELECT t.accession, t.section, t.total_words, {EMPTY_SCORES} FROM totals t LEFT JOIN tfidf p USING (accession, section)")
def agg03(spark, d):
    texts = driver.texts(spark, d)
    return rounded(score.tfidf_scores(texts, lex(spark), *score.document_frequencies(texts, lexicon=lex(spark))))


@query("agg04", "SELECT tok, df, n_docs FROM df CROSS JOIN n_docs")
def agg04(spark, d):
    df, n_docs = score.document_frequencies(driver.texts(spark, d))
    return df.crossJoin(F.broadcast(n_docs))


@query("agg05", f"SELECT accession, section, weighting, total_words, {ROUNDED_MEASURES} FROM scores")
def agg05(spark, d):
    return scores(spark, d).select(*SCORE_COLUMNS)


@query("agg06", f"SELECT accession, section, weighting, total_words, {ROUNDED_MEASURES} FROM scores WHERE accession IN (SELECT accession FROM filings WHERE parse_status IN ('ok', 'partial', 'section_fail')) AND accession IN (SELECT accession FROM filings WHERE accession::BIGINT % 5 <> 0) AND ((section = 'full' AND accession IN (SELECT accession FROM records WHERE full_status = 'ok')) OR (accession, section) IN (SELECT (accession, section) FROM long_records WHERE status = 'ok'))")
def agg06(spark, d):
    """Unscored filings' usable texts, with the document frequencies of all texts."""
    texts, filings = driver.texts(spark, d), driver.filings(spark, d)
    done = filings.where("cast(accession as bigint) % 5 = 0").select("accession", F.lit(SCORER_VERSION).alias("scorer_version"))
    usable = score.eligible_keys(records(spark, d)).join(select.to_score(filings, done).select("accession"), "accession", "left_semi")
    return rounded(score.score_filings(texts, lex(spark), *score.document_frequencies(texts, lexicon=lex(spark)), only=usable)).select(*SCORE_COLUMNS)


@query("agg07", "SELECT section, weighting, count(*) AS n, CAST(floor(avg(total_words)) AS BIGINT) AS avg_total_words, " + ", ".join(f"round(avg({m}), 5) AS avg_{m}" for m in MEASURES) + ", (SELECT count(*) FROM scores) AS rows, (SELECT count(DISTINCT accession) FROM scores) AS distinct_filings FROM scores GROUP BY section, weighting")
def agg07(spark, d):
    s = scores(spark, d)
    return score.score_stats(s).crossJoin(F.broadcast(score.score_totals(s)))


@query("agg08", "SELECT ticker, name, sector, section, round(mean_neg, 8) AS mean_neg, filing_count FROM v_means")
def agg08(spark, d):
    return rounded(rank.section_means(rank.recent(quarterly(spark, d), min_words=VOLUME_WORDS)), 8)


@query("agg09", "SELECT ticker, name, sector, round(mean_neg_mdna, 8) AS mean_neg_mdna, round(mean_neg_risk, 8) AS mean_neg_risk, filing_count_mdna, filing_count_risk FROM v_wide")
def agg09(spark, d):
    return rounded(rank.pivoted(rank.section_means(rank.recent(quarterly(spark, d), min_words=VOLUME_WORDS))), 8)


DECILES_SQL = "WITH v AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 > 0 THEN floor(o_totalprice / 1000) END AS price FROM orders), e AS (SELECT list_distinct(quantile_cont(price, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])) AS e FROM v) "


def prices(spark, d):
    return read(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 10 > 0, F.floor(F.col("o_totalprice") / 1000).cast("double")).alias("price"))


@query("agg10", DECILES_SQL + "SELECT o_orderkey, CAST(CASE WHEN price IS NOT NULL AND len(e) > 1 THEN greatest(1, len(list_filter(e, lambda q: q < price))) END AS INTEGER) AS decile FROM v CROSS JOIN e")
def agg10(spark, d):
    return rank.with_deciles(prices(spark, d), {"price": "decile"}).select("o_orderkey", "decile")


@query("agg11", "SELECT CAST(i AS INTEGER) AS position, round(quantile_cont(price, [0, .1, .2, .3, .4, .5, .6, .7, .8, .9, 1])[i + 1], 6) AS boundary FROM (SELECT floor(o_totalprice / 1000) AS price FROM orders WHERE o_orderkey % 10 > 0), range(11) r(i) GROUP BY i")
def agg11(spark, d):
    return rounded(rank.decile_boundaries(prices(spark, d), "price"), 6)


def quantiles_sql(column: str) -> str:
    return f"CAST(coalesce(min({column}), 0) AS BIGINT) AS min_words, " + ", ".join(f"CAST(floor(coalesce(quantile_cont({column}, {p / 100}), 0)) AS BIGINT) AS p{p}_words" for p in diagnose.PERCENTS) + f", CAST(coalesce(max({column}), 0) AS BIGINT) AS max_words"


@query("agg12", f"SELECT cik, {quantiles_sql('full_words')} FROM full_words GROUP BY cik")
def agg12(spark, d):
    words = records(spark, d).select("cik", F.col("full.word_count").alias("word_count"))
    return words.groupBy("cik").agg(*diagnose.distribution())


@query("agg13", f"SELECT count(*) AS ok, CAST(count(*) FILTER (full_words < 5000 OR dense) AS BIGINT) AS suspicious, {quantiles_sql('full_words')}, (SELECT count(*) FROM records WHERE full_status <> 'ok') AS fail FROM (SELECT *, length(regexp_replace(full_text, '[\\x00-\\x7f]', '', 'g'))::DOUBLE / length(full_text) > 0.05 OR 1 - length(regexp_replace(full_text, '[^\\p{{L}}]', '', 'g'))::DOUBLE / length(full_text) > 0.5 AS dense FROM records WHERE full_status = 'ok')")
def agg13(spark, d):
    return diagnose.parse_summary(records(spark, d))


@query("agg14", f"SELECT l.section, status, n, ok_n, min_words, {', '.join(f'p{p}_words' for p in diagnose.PERCENTS)}, max_words FROM (SELECT section, status, count(*) AS n FROM long_records GROUP BY ALL) l LEFT JOIN (SELECT section, count(*) AS ok_n, {quantiles_sql('word_count')} FROM long_records WHERE status = 'ok' AND word_count > 0 GROUP BY section) w ON l.section = w.section")
def agg14(spark, d):
    return diagnose.section_summary(records(spark, d))


@query("agg14_years", "SELECT section, TRY_CAST(substr(filing_date, 1, 4) AS INTEGER) AS year, round(avg(CASE WHEN status = 'ok' THEN 1.0 ELSE 0.0 END), 3) AS ok_rate FROM long_records GROUP BY 1, 2")
def agg14_years(spark, d):
    return diagnose.section_rates(records(spark, d), driver.filings(spark, d))


@query("agg15", "SELECT coalesce(sector, '(unknown)') AS sector, count(*) AS n, (SELECT count(*) FROM members) AS members, (SELECT count(cik) FROM members) AS members_with_cik, (SELECT max(updated_at) FROM members) AS last_updated FROM members GROUP BY 1")
def agg15(spark, d):
    m = driver.members(spark, d)
    return diagnose.members_by_sector(m).crossJoin(F.broadcast(diagnose.membership_status(m)))


@query("agg16", "SELECT count(mean_neg_mdna) AS n_scored_mdna, count(mean_neg_risk) AS n_scored_risk FROM v_ranks")
def agg16(spark, d):
    return rank.scored_counts(volume_ranks(spark, d))


# --- windows, order, samples ---------------------------------------------------------------------------------------


@query("win01", "SELECT ticker, section, accession, CAST(rn AS INTEGER) AS rn FROM v_recent")
def win01(spark, d):
    return rank.recent(quarterly(spark, d), min_words=VOLUME_WORDS).select("ticker", "section", "accession", "rn")


@query("win02", "SELECT accession, section, CASE WHEN word_count > 0 AND previous > 0 AND greatest(word_count, previous) / least(word_count, previous) > 5 THEN CASE WHEN flags = '' THEN 'yoy_jump' ELSE flags || ',yoy_jump' END ELSE flags END AS flags FROM jumps")
def win02(spark, d):
    r = records(spark, d)
    return diagnose.with_jump_flags(diagnose.long_sections(r), driver.filings(spark, d)).select("accession", "section", F.array_join("suspicious_flags", ",").alias("flags"))


@query("win03", "SELECT cik, accession, previous_accession, word_count, previous_word_count, round(greatest(word_count, previous_word_count) / least(word_count, previous_word_count), 2) AS ratio FROM (SELECT cik, accession, full_words AS word_count, lag(accession) OVER w AS previous_accession, lag(full_words) OVER w AS previous_word_count FROM full_words WINDOW w AS (PARTITION BY cik ORDER BY filing_date, accession)) WHERE word_count > 0 AND previous_word_count > 0 AND greatest(word_count, previous_word_count) / least(word_count, previous_word_count) > 5 ORDER BY ratio DESC, accession LIMIT 20")
def win03(spark, d):
    full = records(spark, d).select("cik", "accession", F.col("full.word_count").alias("word_count")).join(driver.filings(spark, d).select("accession", "filing_date"), "accession")
    return diagnose.length_jumps(full)


@query("win04", "SELECT ticker, decile_mdna AS decile, CAST(row_number() OVER (PARTITION BY decile_mdna ORDER BY mean_neg_mdna DESC, ticker) AS INTEGER) AS rank FROM v_ranks WHERE decile_mdna IS NOT NULL")
def win04(spark, d):
    return rank.decile_rows(volume_ranks(spark, d), "mdna").select("ticker", "decile", "rank")


@query("srt01", "SELECT cik, accession FROM v_filings ORDER BY cik, accession LIMIT 100")
def srt01(spark, d):
    return select.limited(driver.volume(spark, d)[1].select("cik", "accession"), 100)


@query("srt02", "SELECT ticker, accession, section, acceptance_dt FROM v_quarterly ORDER BY ticker, acceptance_dt DESC, section, accession")
def srt02(spark, d):
    s, f, m = driver.volume(spark, d)
    return rank.filing_detail(s, f, m, m).select("ticker", "accession", "section", "acceptance_dt").orderBy(*rank.detail_order())


@query("srt03", "SELECT ticker, decile_mdna FROM v_ranks ORDER BY decile_mdna DESC NULLS LAST, ticker")
def srt03(spark, d):
    return volume_ranks(spark, d).orderBy(*rank.rank_order()).select("ticker", "decile_mdna")


@query("srt04", "SELECT accession, filing_date FROM filings ORDER BY filing_date, accession LIMIT 10")
def srt04(spark, d):
    return diagnose.oldest(driver.filings(spark, d).select("accession", "filing_date"), 10)


@query("srt05", "SELECT 'short' AS kind, accession, full_words AS word_count FROM (SELECT * FROM full_words ORDER BY full_words, accession LIMIT 10) UNION ALL SELECT 'long', accession, full_words FROM (SELECT * FROM full_words ORDER BY full_words DESC, accession LIMIT 10)")
def srt05(spark, d):
    full = records(spark, d).select("accession", F.col("full.word_count").alias("word_count"))
    return diagnose.extremes(full).select(F.lit("short").alias("kind"), "*").unionByName(diagnose.extremes(full, longest=True).select(F.lit("long").alias("kind"), "*"))


@query("srt07")
def srt07(spark, d):
    return diagnose.samples(records(spark, d), 20, suspicious=True, seed=3)


@query("srt08")
def srt08(spark, d):
    r, f = records(spark, d), driver.filings(spark, d)
    return diagnose.validation_set(diagnose.flagged_records(r, f), f, 40)


@query("set01", "SELECT accession, 'recent' AS block FROM v_filings WHERE accession::BIGINT % 2 = 0 UNION ALL SELECT accession, 'extra' FROM v_filings WHERE accession::BIGINT % 2 <> 0 OR accession::BIGINT % 3 = 0")
def set01(spark, d):
    """Two blocks that share some filings and together hold every one."""
    f = driver.volume(spark, d)[1].select("accession")
    return f.where("cast(accession as bigint) % 2 = 0").withColumn("block", F.lit("recent")).unionByName(f.where("cast(accession as bigint) % 2 <> 0 or cast(accession as bigint) % 3 = 0").withColumn("block", F.lit("extra")))


@query("set02", "SELECT cik, min(bucket) AS bucket FROM (SELECT cik, 0 AS bucket FROM v_filings WHERE accession::BIGINT % 2 = 0 UNION ALL SELECT cik, 1 FROM v_filings) GROUP BY cik")
def set02(spark, d):
    f = driver.volume(spark, d)[1]
    both = f.where("cast(accession as bigint) % 2 = 0").select("cik", F.lit(0).alias("bucket")).unionByName(f.select("cik", F.lit(1).alias("bucket")))
    return both.groupBy("cik").agg(F.min("bucket").alias("bucket"))


@query("set03", "SELECT DISTINCT accession, tok FROM tf WHERE section = 'full'")
def set03(spark, d):
    rows = score.tokenized(driver.texts(spark, d).where("section = 'full'"))
    return rows.select("accession", F.explode(F.array_distinct("tokens")).alias("tok")).distinct()


# --- ranking and report --------------------------------------------------------------------------------------------


@query("api01", RANK_SQL + "ranks")
def api01(spark, d):
    return rounded(ranks(spark, d), 8)


@query("api01_volume", RANK_SQL + "v_ranks")
def api01_volume(spark, d):
    return rounded(volume_ranks(spark, d), 8)


@query("api02", "SELECT accession, acceptance_dt, period_of_report, section, neg, total_words FROM quarterly WHERE ticker = 'SRC3'")
def api02(spark, d):
    proportional = rounded(score.proportional_scores(driver.texts(spark, d), lex(spark), keep_empty=False)).withColumn("weighting", F.lit("proportional"))
    return rank.filing_detail(proportional, driver.filings(spark, d), driver.members(spark, d), "SRC3").drop("ticker")


@query("api03", "SELECT decile_risk AS decile, CAST(row_number() OVER (PARTITION BY decile_risk ORDER BY mean_neg_risk DESC, ticker) AS INTEGER) AS rank, ticker, coalesce(name, '') AS name, coalesce(sector, '') AS sector, CASE sector " + " ".join(f"WHEN '{s}' THEN '{c}'" for s, c in names.COLOURS.items()) + f" ELSE '{names.OTHER_COLOUR}' END AS sector_colour, round(mean_neg_risk, 8) AS mean_neg, filing_count_risk AS filing_count FROM ranks WHERE decile_risk IS NOT NULL")
def api03(spark, d):
    return rounded(rank.decile_rows(ranks(spark, d), "risk"), 8)


SHOWN_SQL = "SELECT '{k}' AS section, decile_{k} AS decile, CAST(row_number() OVER (PARTITION BY decile_{k} ORDER BY mean_neg_{k} DESC, ticker) AS INTEGER) AS rank, ticker, coalesce(name, '') AS name, coalesce(sector, '') AS sector, CASE sector " + " ".join(f"WHEN '{s}' THEN '{c}'" for s, c in names.COLOURS.items()) + f" ELSE '{names.OTHER_COLOUR}' END AS sector_colour, round(mean_neg_{{k}}, 8) AS mean_neg, filing_count_{{k}} AS filing_count FROM ranks WHERE decile_{{k}} IN (1, 10)"


@query("api04", " UNION ALL ".join(SHOWN_SQL.format(k=k) for k in rank.SHORT.values()))
def api04(spark, d):
    """The rows that a report shows: deciles 10 and 1 of both sections."""
    return rounded(report.shown_rows(ranks(spark, d)), 8)
