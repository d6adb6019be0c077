"""Sections of a filing by its headings.

Headings are `Item <number><letter>` at the start of a line; in quarterly reports Part I and Part II divide the items. Of
several headings of the wanted item the one with the longest body counts, which passes over tables of contents; a body ends
at the next heading. It is an approximation of the commercial-grade extractors that filings are usually cut with.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..runtime import importable

HEADING = re.compile(r"(?im)^[ \t]*(?:part[ \t]+(?P<part>i{1,3}|iv)\b[ .,:\-]*)?(?:item[ \t]+(?P<item>\d{1,2}[a-c]?)\b[ .:\-]*)?")
#: Part and item of risk factors and of the management discussion, by form.
WANTED = {"10-K": (("", "1a"), ("", "7")), "10-Q": (("ii", "1a"), ("i", "2"))}


def headings(text: str) -> list[tuple[int, int, str, str]]:
    """Start, start of the body, part so far and item of each heading."""
    out, part = [], ""
    for m in HEADING.finditer(text):
        part = (m["part"] or part).lower()
        if m["part"] or m["item"]:
            out.append((m.start(), m.end(), part, (m["item"] or "").lower()))
    return out


def split(text: str | None, form: str | None) -> dict[str, str]:
    if form not in WANTED:
        raise ValueError(f"no sections are known for the form {form!r}")
    found = headings(text or "")
    out = []
    for part, item in WANTED[form]:
        bodies = [text[start:stop].strip() for (_, start, p, i), stop in zip(found, [*(h[0] for h in found[1:]), len(text or "")], strict=False) if i == item and (not part or p in (part, ""))]
        out.append(max(bodies, key=len, default=""))
    return {"risk_factors": out[0], "mdna": out[1], "error": None}


def split_sections(text: Column, form: Column) -> Column:
    """risk_factors, mdna and error; a failure empties the row's sections and is told, it doesn't end the job."""

    def run(texts: pd.Series, forms: pd.Series) -> pd.DataFrame:
        rows = []
        for t, f in zip(texts, forms, strict=True):
            try:
                rows.append(split(t, f))
            except Exception as e:
                rows.append({"risk_factors": "", "mdna": "", "error": str(e)})
        return pd.DataFrame(rows, columns=["risk_factors", "mdna", "error"])

    importable()
    return F.pandas_udf(run, "risk_factors string, mdna string, error string")(text, form)
