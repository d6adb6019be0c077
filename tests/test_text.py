import pytest
from pyspark.sql import functions as F

from lexforge.functions import html, names, sections
from lexforge.functions import text as fn


def one(spark, column, *values, kind="string"):
    return spark.createDataFrame([tuple(values)], ", ".join(f"c{i} {kind}" for i in range(len(values)))).select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(("text", "want"), [("Don't stop", ["don", "t", "stop"]), ("3 risks—2020", ["risks"]), ("", []), (None, []), ("Kelvin", ["elvin"])])
def test_tokens(spark, text, want):
    assert one(spark, fn.tokens(F.col("c0")), text) == want


@pytest.mark.parametrize("text", ["a b", " a b\u0085c ", " x\x1cy", "", "one"])
def test_words_as_python_splits(spark, text):
    assert one(spark, fn.word_count(F.col("c0")), text) == len(text.split())


@pytest.mark.parametrize("text", ["  a \t b\n\n\n c ", "\n \n", " x "])
def test_collapse(spark, text):
    assert one(spark, fn.collapse_space(F.col("c0")), text) == html.re.sub(r"\n{2,}", "\n\n", html.re.sub(r"[ \t]+", " ", text)).strip()


def test_punctuation(spark):
    assert one(spark, fn.fold_punctuation(F.col("c0")), "“a” ‘b’ – — − …  ") == "\"a\" 'b' - - - ...  "


def test_ratios(spark):
    assert one(spark, fn.non_letter_ratio(F.col("c0")), "") == 1.0
    assert one(spark, fn.non_ascii_ratio(F.col("c0")), "") == 0.0
    assert one(spark, fn.non_letter_ratio(F.col("c0")), "ab12") == 0.5
    assert one(spark, fn.non_ascii_ratio(F.col("c0")), "é1") == 0.5


CASES = [
    ("word " * 1200, 5000, 0, 1000, "ok", []),
    ("word " * 50, 5000, 0, 1000, "ok", ["length_low"]),
    ("It is incorporated herein by reference to the annual report", 5000, 0, 1000, "incorp_ref", ["incorp_ref_phrase"]),
    ("see our proxy", 5000, 100, 1000, "incorp_ref", ["incorp_ref_phrase"]),
    ("word " * 50, 5000, 100, 1000, "missing", ["below_hard_floor"]),
    ("word " * 50_001, 500_000, 0, 1000, "over_extracted", ["length_high"]),
    ("word " * 980, 1000, 0, 1000, "over_extracted", ["equal_to_full"]),
    ("word " * 980, 0, 0, 1000, "ok", ["length_low"]),
    ("", 100, 0, 0, "missing", []),
    (None, 100, 0, 0, "missing", []),
    ("   ", 100, 0, 0, "ok", []),
]


@pytest.mark.parametrize(("text", "full", "floor", "least", "status", "flags"), CASES)
def test_section_status(spark, text, full, floor, least, status, flags):
    r = one(spark, fn.section_record(F.col("c0"), F.lit(full), floor, least), text)
    assert (r["status"], r["suspicious_flags"]) == (status, flags)


@pytest.mark.parametrize(("full", "risk", "mdna", "want"), [("parse_fail", "ok", "ok", "parse_fail"), ("ok", "over_extracted", "ok", "section_fail"), ("ok", "ok", "ok", "ok"), ("ok", "ok", "missing", "partial"), ("ok", "incorp_ref", "ok", "partial"), ("ok", "missing", "missing", "section_fail")])
def test_filing_status(spark, full, risk, mdna, want):
    assert one(spark, fn.filing_status(*(F.col(f"c{i}") for i in range(3))), full, risk, mdna) == want


def test_names(spark):
    assert one(spark, names.ticker(F.col("c0")), " brk.b ") == "BRK-B"
    assert [one(spark, names.cik(F.col("c0")), v) for v in ("0000320193", " ", "x")] == [320193, None, None]
    assert [one(spark, names.cik_padded(F.col("c0")), v) for v in ("42", "12345678901")] == ["0000000042", "12345678901"]
    assert one(spark, names.document_url(F.col("c0").cast("bigint"), F.col("c1"), F.lit("a.htm")), "7", "0-1-2").endswith("/7/012/a.htm")
    assert [one(spark, names.acceptance(F.col("c0")), v) for v in ("2023-11-02T18:08:38.000Z", "2023-11-02T18:08:38+02:00", "?", "")] == ["2023-11-02T18:08:38Z", "2023-11-02T16:08:38Z", "?", ""]


HTML = """<html><head><title>no</title></head><body><ix:header><ix:hidden>no</ix:hidden></ix:header><script>no</script>
<p>The ofﬁce said “yes” <ix:nonFraction>12</ix:nonFraction><table><tr><td>no</td></tr></table><!-- no --> more<br>text</body></html>"""


def test_html(spark):
    text, error = one(spark, html.clean_html(F.col("c0")), HTML)
    assert error is None
    assert "no" not in text.split() and 'office said "yes"' in text and "12" in text and "more text" in text
    assert tuple(one(spark, html.clean_html(F.col("c0")), None)) == (None, None)
    assert one(spark, html.clean_html(F.col("c0")), "<![foo[x]]>")["error"]
    import gzip

    assert html.clean(gzip.compress(HTML.encode())) == text
    assert html.clean("<table>never closed <p>x") == ""


def test_cross_references_are_no_headings():
    """Items named within a line don't cut a section, one that is split over lines ends where the next heading begins."""
    text = "\n".join(["PART II", "Item 1A.", "Risk Factors", "We refer to Item 2 and see Item 7A for more.", "risk " * 30, "Item 6. Exhibits", "PART I", "Item", "2. not a heading", "Item 2. Discussion", "as told in Item 1A of Part II", "Item 3. Other"])
    got = sections.split(text, "10-Q")
    assert got["risk_factors"].startswith("Risk Factors") and "Item 7A for more" in got["risk_factors"] and got["risk_factors"].endswith("risk")
    assert got["mdna"].endswith("as told in Item 1A of Part II")


def test_sections():
    ten_k = "\n".join(["Item 1A. Risk Factors", "Item 7. MD&A", "Item 1A. Risk Factors", "risk " * 50, "Item 1B. None", "Item 7. Discussion", "talk " * 60, "Item 7A. Market", "x"])
    got = sections.split(ten_k, "10-K")
    assert got["risk_factors"].split() == ["Risk", "Factors", *["risk"] * 50] and got["mdna"].split() == ["Discussion", *["talk"] * 60]
    ten_q = "\n".join(["PART I", "Item 1. Statements", "Item 2. Discussion", "talk " * 9, "PART II", "Item 1A. Risk Factors", "none", "Item 2. Sales", "word " * 90])
    got = sections.split(ten_q, "10-Q")
    assert got["mdna"].count("talk") == 9 and got["risk_factors"].endswith("none")
    with pytest.raises(ValueError):
        sections.split("x", "8-K")
    assert sections.split(None, "10-K")["mdna"] == ""
