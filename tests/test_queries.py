"""Every query against its SQL, and the entry."""

import html
import os
import re
import unicodedata

import duckdb
import pyarrow.parquet as pq
import pytest
import xxhash

import __spark_entry__ as entry
from lexforge.operators import diagnose
from lexforge.plans import registry
from lexforge.sources import driver

NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


def table(sf, name):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def plain_text(page):
    """A page's text by regular expressions: what is dropped first, then all tags."""
    page = re.sub(r"(?s)<!--.*?-->", "\0", page)
    page = re.sub(r"(?is)<(head|table|script|style|noscript)\b.*?</\1\s*>", "\0", page)
    parts = [html.unescape(p) for p in re.split(r"\0|<[^>]*>", page)]
    text = unicodedata.normalize("NFKC", " ".join(p for p in parts if p))
    text = "".join({"‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"', "–": "-", "—": "-", "−": "-", "…": "..."}.get(c, c) for c in text)
    return re.sub(r"\n{2,}", "\n\n", re.sub(r"[ \t]+", " ", text)).strip()


def drawn(rows, n, seed):
    """The first n by Spark's hash of accession and seed."""
    order = lambda r: (signed(xxhash.xxh64_intdigest(seed.to_bytes(4, "little"), xxhash.xxh64_intdigest(r["accession"].encode(), 42))), r["accession"])
    return sorted(rows, key=order)[:n]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def flagged(r):
    return bool(r["risk_factors"]["suspicious_flags"] or r["mdna"]["suspicious_flags"] or r["status"] in ("partial", "section_fail"))


def plain_samples(spark, sf):
    rows = [r for r in registry.records(spark, sf).collect() if r["status"] in ("ok", "partial", "section_fail") and flagged(r)]
    return [(r["cik"], r["accession"], r["status"]) for r in drawn(rows, 20, 3)]


def plain_validation(spark, sf, n=40):
    filings = {r["accession"]: r for r in driver.filings(spark, sf).collect()}
    rows = [r.asDict(recursive=True) for r in registry.records(spark, sf).collect()]
    used = {a for a, f in filings.items() if f["parse_status"] in ("ok", "partial", "section_fail")}
    jumps = set()
    for s in ("risk_factors", "mdna"):
        by = {}
        for r in sorted((r for r in rows if r["accession"] in used), key=lambda r: (filings[r["accession"]]["filing_date"] or "", r["accession"])):
            before, now = by.get(r["cik"]), r[s]["word_count"]
            if before and now and max(before, now) / min(before, now) > 5:
                jumps.add(r["accession"])
            by[r["cik"]] = now
    plain = [r for r in rows if r["status"] == "ok" and not r["risk_factors"]["suspicious_flags"] + r["mdna"]["suspicious_flags"] and r["accession"] not in jumps]
    over = [r for r in rows if "over_extracted" in (r["risk_factors"]["status"], r["mdna"]["status"])]
    oldest = sorted((filings[a] for a in used), key=lambda f: (f["filing_date"], f["accession"]))[: n // 4]
    buckets = [drawn([r for r in rows if r["accession"] in jumps], n // 4, 0), drawn(over, n // 4, 0), oldest, drawn(plain, n // 4, 0)]
    first = {}
    for i, bucket in enumerate(buckets):
        for r in bucket:
            first.setdefault((r["cik"], r["accession"]), i)
    return [(c, a, i, filings[a]["filing_date"] if a in used else None) for (c, a), i in sorted(first.items(), key=lambda x: (x[1], x[0][1]))][:n]


def plain_parse(spark, sf):
    out = []
    for r in table(sf, "pages"):
        i, words = r["page_id"], len(plain_text(r["html"]).split())
        bad = i % 7 == 0 or i % 11 == 0
        out.append((str(i), 0 if bad else words, "ok" if not bad and words >= 1000 else "parse_fail", bad))
    return out


#: What SQL can't express, by other means.
PLAIN = {
    "txt07": lambda spark, sf: [(r["page_id"], plain_text(r["html"])) for r in table(sf, "pages")],
    "txt08": lambda spark, sf: [(r["doc_id"], None if r["text"] is None else unicodedata.normalize("NFKC", r["text"])) for r in table(sf, "documents")],
    "src11": plain_parse,
    "srt07": plain_samples,
    "srt08": lambda spark, sf: [(a, c, i, day) for c, a, i, day in plain_validation(spark, sf)],
    "snk12": lambda spark, sf: [(c, a, day, "", "", "", "", "") for c, a, _, day in plain_validation(spark, sf)],
}


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, db, name):
    found = entry.queries()[name](spark, sf)
    rows = found.collect()
    if name not in entry.oracle_sql():
        assert rows and sorted(map(str, map(tuple, rows))) == sorted(map(str, PLAIN[name](spark, sf)))
        return
    want = db.sql(entry.oracle_sql()[name])
    columns = sorted(want.columns)
    assert columns == sorted(found.columns)
    pick = lambda row, names: str(tuple(row[names.index(c)] for c in columns))
    assert sorted(pick(r, found.columns) for r in rows) == sorted(pick(r, want.columns) for r in want.fetchall())


def times(df, function):
    """How often the plan calls the function."""
    return df._jdf.queryExecution().executedPlan().toString().count(f"{function}(")


@pytest.fixture
def whole_plans(spark):
    """Plans as strings with all of their columns and no broadcasts."""
    conf = {"spark.sql.maxPlanStringLength": "10000000", "spark.sql.debug.maxToStringFields": "1000", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_records_measure_texts_once(spark, sf, whole_plans):
    """One count of words for each text and, in the same row, one for the rule of references, which shares it."""
    df = entry.queries()["src16"](spark, sf)
    assert times(df, "split") == 5 and times(df, "regexp_replace") == 2 and times(df, "from_json") == 1


def test_records_shuffle_no_texts(spark, sf, whole_plans):
    moved = registry.records(spark, sf)._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")[1:]
    below = [m.splitlines()[1] for m in moved]
    assert len(below) == 3 and not [b for b in below if re.search(r"(, |\[)(x#\d+\.)?(text|mdna|risk_factors)(#\d+)?( AS text#\d+)?[,\]]", b)]


def test_flagged_records_follow_the_jumps_of_long_sections(spark):
    """With filings that don't count between others, without dates, and records without sections or flags."""
    size = lambda i: (i * i * 37) % 11 * 400
    section = lambda i: None if i % 9 == 4 else ("ok", size(i), None if i % 5 == 2 else ["length_low"] if i % 2 else [])
    kind = "struct<status:string,word_count:bigint,suspicious_flags:array<string>>"
    records = spark.createDataFrame([(i % 3 or None, f"a{i:02}", section(i), section(i + 3)) for i in range(40)], f"cik bigint, accession string, risk_factors {kind}, mdna {kind}")
    filings = spark.createDataFrame([(f"a{i:02}", None if i % 7 == 3 else f"20{i % 13:02}-01-01", [None, "ok", "partial", "parse_fail", "section_fail"][i % 5]) for i in range(40) if i != 5], "accession string, filing_date string, parse_status string")
    used = filings.where("parse_status in ('ok', 'partial', 'section_fail')")
    jumps = {(r["accession"], r["section"]): r["suspicious_flags"] for r in diagnose.with_jump_flags(diagnose.long_sections(records), used).collect()}
    want = {r["accession"]: [None if r[s] is None else jumps.get((r["accession"], s), r[s]["suspicious_flags"]) for s in ("risk_factors", "mdna")] for r in records.collect()}
    made = diagnose.flagged_records(records, filings)
    assert sorted(made.dtypes) == sorted(records.dtypes)
    assert {r["accession"]: [r[s] and r[s]["suspicious_flags"] for s in ("risk_factors", "mdna")] for r in made.collect()} == want
    assert any("yoy_jump" in (f or []) for v in want.values() for f in v)


@pytest.mark.parametrize("name", ["srt08", "snk12"])
def test_validation_set_reads_records_once(spark, sf, whole_plans, name):
    df = entry.queries()[name](spark, sf)
    assert times(df, "split") == 5 and "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["agg03", "agg06"])
def test_scores_count_tokens_once(spark, sf, whole_plans, name):
    """Document frequencies and scores share one count, and no text goes through a shuffle."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # reuse is then part of the plan from the start
    try:
        df = entry.queries()[name](spark, sf)
        assert times(df, "regexp_extract_all") == 1
        moved = df._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")[1:]
        assert not [m for m in moved if re.search(r"Project \[.*x#\d+\.text AS text#|Project \[.*, text#\d+\]", m.splitlines()[1])]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_section_summary_reads_records_once(spark, sf, whole_plans):
    assert times(entry.queries()["agg14"](spark, sf), "split") == 5


def test_section_summary_of_sections_without_words(spark):
    """A section none of whose records is ok and has words has no statistics; without words they aren't counted as ok."""
    kind = "struct<status:string,word_count:bigint,suspicious_flags:array<string>>"
    rows = [("2", 1, "a", ("ok", 10, []), ("missing", 5, [])), ("2", 1, "b", ("ok", 0, []), None), ("2", 1, "c", ("partial", 7, []), ("missing", 0, [])), ("1", 1, "d", ("ok", 99, []), ("ok", 99, []))]
    records = spark.createDataFrame(rows, f"section_extractor_version string, cik bigint, accession string, risk_factors {kind}, mdna {kind}")
    found = sorted(map(tuple, diagnose.section_summary(records).collect()))
    assert found == [("mdna", "missing", 3, *[None] * 7), ("risk_factors", "ok", 2, 1, *[10] * 6), ("risk_factors", "partial", 1, 1, *[10] * 6)]


@pytest.mark.parametrize("name", ["jsn01", "snk05", "txt15", "srt07"])
def test_queries_over_records_measure_texts_once(spark, sf, whole_plans, name):
    df = entry.queries()[name](spark, sf)
    assert times(df, "split") == 5 and times(df, "regexp_replace") == 2


def test_entry(spark):
    assert entry.entry(spark).count() > 0
