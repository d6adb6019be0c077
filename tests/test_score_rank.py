import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexforge.operators import diagnose, rank, score
from lexforge.schema import CATEGORIES, MEASURES

LEX = [("risk", "Negative"), ("loss", "Negative"), ("loss", "Litigious"), ("strong", "Positive")]


@pytest.fixture(scope="module")
def lexicon(spark):
    return spark.createDataFrame(LEX, "word string, category string")


def texts(spark, *rows):
    return spark.createDataFrame(list(rows), "accession string, section string, text string")


def test_proportional(spark, lexicon):
    t = texts(spark, ("a", "full", "risk Loss x risk y z"), ("b", "full", ""), ("c", "full", None))
    got = {r["accession"]: r for r in score.proportional_scores(t, lexicon).collect()}
    assert got["a"]["neg"] == 0.5 and got["a"]["lit"] == 1 / 6 and got["a"]["total_words"] == 6
    assert got["b"]["neg"] == 0.0 == got["c"]["pos"]
    assert {r["accession"] for r in score.score_filings(t, lexicon).collect()} == {"a"}


def test_tfidf(spark, lexicon):
    t = texts(spark, ("a", "full", "risk risk other"))
    df = spark.createDataFrame([("risk", 100), ("strong", 10_000)], "tok string, df bigint")
    n = spark.createDataFrame([(10_000,)], "n_docs bigint")
    r = score.tfidf_scores(t, lexicon, df, n).first()
    assert math.isclose(r["neg"], (1 + math.log10(2)) * 2 / 3) and r["pos"] == 0.0
    r = score.tfidf_scores(texts(spark, ("a", "full", "strong loss")), lexicon, df, n).first()
    assert [r[m] for m in MEASURES] == [0.0] * len(CATEGORIES)  # everywhere, or without a frequency


def test_frequencies(spark):
    t = texts(spark, ("a", "full", "risk strong filler filler"), ("b", "full", "strong filler"), ("b", "mdna", "risk"), ("c", "full", "12"))
    df, n = score.document_frequencies(t)
    assert {r["tok"]: r["df"] for r in df.collect()} == {"risk": 1, "strong": 2, "filler": 2} and n.first()[0] == 2


@pytest.mark.parametrize("values", [[1.0], [2.0] * 5, [1.0, 2.0], [1.0, 2.0, 3.0], [0.0] * 5 + [0.1, 0.2, 0.3, 0.4, 0.5], [None, 0.1, 0.2, 0.3], [], [random.Random(4).random() for _ in range(57)], [float("nan"), 1.0, 2.0]])
def test_deciles_as_qcut(spark, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = {r["i"]: r["d"] for r in rank.with_deciles(rows, {"v": "d"}).collect()}
    clean = [v for v in values if v is not None and v == v]
    want = dict.fromkeys(range(len(values)))
    if len(set(clean)) > 1:
        codes = pd.qcut(pd.Series([np.nan if v is None else v for v in values]), 10, labels=False, duplicates="drop")
        want = {i: None if pd.isna(c) else int(c) + 1 for i, c in enumerate(codes)}
    assert got == want


def world(spark, filings, scores, members):
    f = spark.createDataFrame(filings, "accession string, cik bigint, form_type string, acceptance_dt string, period_of_report string, stack string")
    s = spark.createDataFrame(scores, "accession string, section string, weighting string, neg double, total_words bigint")
    m = spark.createDataFrame(members, "ticker string, cik bigint, name string, sector string")
    return s, f, m


def test_ranking_rules(spark):
    filings = [(f"f{c}{i}", c, "10-Q", f"2020-0{i}-01", None, "sp500") for c in (1, 2, 3) for i in range(1, 7)] + [("k", 1, "10-K", "2021", None, "sp500"), ("am", 1, "10-Q/A", "2021", None, "sp500")]
    scores = [(f"f1{i}", "mdna", "proportional", float(i), 500) for i in range(1, 7)]
    scores += [("f16", "risk_factors", "proportional", 9.0, 10)]  # a stub: no slot
    scores += [(f"f2{i}", "mdna", "proportional", 1.0, 500) for i in (1, 2)] + [("f21", "risk_factors", "proportional", 1.0, 500)]
    scores += [("f31", "mdna", "proportional", 1.0, 500), ("k", "mdna", "proportional", 99.0, 500), ("am", "mdna", "proportional", 99.0, 500), ("f16", "mdna", "tfidf", 99.0, 500)]
    s, f, m = world(spark, filings, scores, [("A", 1, "a", "x"), ("A2", 1, "a2", None), ("B", 2, None, "x"), ("C", 3, "c", "x"), ("D", None, "d", "x")])
    got = {r["ticker"]: r for r in rank.compute_ranks(s, f, m).collect()}
    assert got.keys() == {"A", "A2", "B"}  # C has too few; share classes both rank; null names stay
    assert got["A"]["mean_neg_mdna"] == (3 + 4 + 5 + 6) / 4 and got["A"]["filing_count_mdna"] == 4
    assert got["A"]["filing_count_risk"] == 0 and got["A"]["mean_neg_risk"] is None and got["A"]["decile_risk"] is None
    assert got["B"]["filing_count_risk"] == 1 and got["B"]["mean_neg_risk"] is None
    assert (got["B"]["decile_mdna"], got["A"]["decile_mdna"]) == (1, 5)  # edges: 1.0, four between, 4.5
    detail = rank.filing_detail(s, f, m, "A").collect()
    assert len(detail) == 7 and any(r["total_words"] == 10 for r in detail)


def test_rank_of_nothing_and_partition_invariance(spark):
    s, f, m = world(spark, [], [], [])
    assert rank.compute_ranks(s, f, m).collect() == [] == rank.decile_boundaries(rank.compute_ranks(s, f, m), "mean_neg_mdna").collect()
    rng = random.Random(1)
    filings = [(f"{c}-{i}", c, "10-Q", f"20{10 + i}", None, "sp500") for c in range(30) for i in range(6)]
    scores = [(a, sec, "proportional", rng.random(), rng.randrange(100, 900)) for a, *_ in filings for sec in ("mdna", "risk_factors")]
    members = [(f"T{c}", c, f"n{c}", "x") for c in range(30)]
    got = []
    for parts in (1, 8):
        s, f, m = (x.repartition(parts) for x in world(spark, filings, scores, members))
        got.append(sorted(map(tuple, rank.compute_ranks(s, f, m).collect())))
    assert got[0] == got[1] and len(got[0]) == 30


def test_decile_rows_tie_by_ticker(spark):
    rows = spark.createDataFrame([("B", "n", "Energy", 1.0, 2, 10), ("A", None, None, 1.0, 2, 10), ("C", "n", "x", 2.0, 2, 10)], "ticker string, name string, sector string, mean_neg_mdna double, filing_count_mdna int, decile_mdna int")
    got = [(r["rank"], r["ticker"], r["name"]) for r in rank.decile_rows(rows, "mdna").orderBy("rank").collect()]
    assert got == [(1, "C", "n"), (2, "A", ""), (3, "B", "n")]


def test_jumps(spark):
    rows = spark.createDataFrame([(1, "a", "2020-01-01", 1000), (1, "b", "2020-04-01", 12_000), (1, "c", "2020-07-01", 0), (1, "d", "2020-10-01", 1000)], "cik bigint, accession string, filing_date string, word_count bigint")
    assert [(r["accession"], r["ratio"]) for r in diagnose.length_jumps(rows).collect()] == [("b", 12.0)]
    sections = rows.select("cik", "accession", F.lit("mdna").alias("section"), F.lit("ok").alias("status"), "word_count", F.array().cast("array<string>").alias("suspicious_flags"))
    got = {r["accession"]: r["suspicious_flags"] for r in diagnose.with_jump_flags(sections, rows).collect()}
    assert got == {"a": [], "b": ["yoy_jump"], "c": [], "d": []}


def test_validation(spark):
    labels = spark.createDataFrame([("1", "a", "Risk begins", "ends here", "", ""), ("1", "b", "zzz", "", "", "")], "cik string, accession string, risk_factors_start_substring string, risk_factors_end_substring string, mdna_start_substring string, mdna_end_substring string")
    full = "intro " * 10 + "Risk begins and ends here" + " tail" * 300
    t = spark.createDataFrame([("a", "full", full), ("a", "risk_factors", "Risk begins and ends here"), ("b", "full", "x")], "accession string, section string, text string")
    r = diagnose.validation_accuracy(labels, t).first()
    assert (r["section"], r["labelled"], r["found"], r["start_ok"], r["end_ok"]) == ("risk_factors", 2, 1, 1, 1)
