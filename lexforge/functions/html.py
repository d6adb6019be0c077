"""HTML of filings to plain text, as a pandas function over Python's own parser (there is no built-in one).

Dropped with all they hold: head, table, script, style, noscript and namespaced elements other than the inline-XBRL
wrappers of visible text. Text nodes are joined with a space, then NFKC, punctuation folding and white-space collapsing
follow. A dropped element that is never closed reaches to the end of the document; head also ends where body begins.
"""

from __future__ import annotations

import gzip
import re
import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..runtime import importable
from .text import FOLDED

DROPPED = {"head", "table", "script", "style", "noscript"}
WRAPPERS = {"ix:nonfraction", "ix:nonnumeric", "ix:continuation"}
VOID = set("area base br col embed hr img input link meta source track wbr".split())
PLAIN = str.maketrans(FOLDED | {"…": "..."})


class Texts(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.dropped: list[str] = []  # open elements that are dropped, outermost first

    def handle_starttag(self, tag, attrs):
        if tag == "body" and self.dropped == ["head"]:
            self.dropped = []
        if tag not in VOID and (tag in DROPPED or (":" in tag and tag not in WRAPPERS)):
            self.dropped.append(tag)

    def handle_startendtag(self, tag, attrs):
        pass  # holds no text

    def handle_endtag(self, tag):
        if tag in self.dropped:
            while self.dropped.pop() != tag:
                pass

    def handle_data(self, data):
        if not self.dropped:
            self.parts.append(data)


def normalize(text: str) -> str:
    text = unicodedata.normalize("NFKC", text).translate(PLAIN)
    return re.sub(r"\n{2,}", "\n\n", re.sub(r"[ \t]+", " ", text)).strip()


def clean(raw: str | bytes | None) -> str | None:
    if raw is None:
        return None
    if isinstance(raw, bytes):
        raw = (gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode("utf-8", "replace")
    parser = Texts()
    parser.feed(raw)
    parser.close()
    return normalize(" ".join(parser.parts))


def clean_or_error(raw: str | bytes | None) -> tuple[str | None, str | None]:
    """The plain text, or why there is none: a damaged archive, or markup that the parser gives up on."""
    try:
        return clean(raw), None
    except Exception as e:
        return None, f"{type(e).__name__}: {e}"


def clean_html(raw: Column) -> Column:
    """text and error of HTML as string or bytes, gzipped or not: one bad document is an error of its row, not of the job."""

    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if p is None else clean_or_error(p) for p in pages], columns=["text", "error"])

    importable()
    return F.pandas_udf(run, "text string, error string")(raw)


def nfkc(text: Column) -> Column:
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")

    importable()
    return F.pandas_udf(run, "string")(text)
