"""License scans: base phrases and template-markup matching.

A template is text with markup: `<<opt>> ... <</opt>>` is optional, `<<var 0-20>>` stands for any words, of which there
are as many as the bounds say. It is compiled into an automaton over word tokens: the mandatory wording must match
exactly, word by word, with nothing between but what the markup allows. A label is found if any place of the text
takes the automaton from its start to its end.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after A-Z are lower-cased, in templates too. The base phrases are found by
words as well and never depend on the templates. Only texts that hold a run of a template's mandatory words go through its
automaton.

Score: 0 without a label, 1 with a label of a template, else 1 - 0.5 ** n_base.

Defined cases: null is an empty text; no words: n_words 0, n_base 0, positions null, labels "", score 0; texts of any
length are scanned whole; equal texts give equal results; columns of docs that have the name of a result are replaced.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ascii_lower, map_batches, replacing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrase and label of the base.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Label and template; short notices in the wording that projects use.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files <<opt>>the software<</opt>> to deal in the software without restriction <<var 0-60>> the above copyright notice and this permission notice <<opt>>including the next paragraph<</opt>> shall be included in all copies or substantial portions of the software"),
    ("mit", "<<opt>>released<</opt>> <<opt>>licensed<</opt>> under the <<opt>>terms of the<</opt>> mit license"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license <<opt>>you may obtain a copy of the license at <<var 0-10>><</opt>> unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "<<opt>>released<</opt>> <<opt>>licensed<</opt>> under the <<opt>>terms of the<</opt>> apache license version 2 0"),
    ("gpl-2.0", "under the <<opt>>terms of the<</opt>> gnu general public license <<opt>>as published by the free software foundation<</opt>> <<opt>>either<</opt>> version 2 <<opt>>of the license<</opt>> <<opt>>or at your option any later version<</opt>>"),
    ("gpl-3.0", "under the <<opt>>terms of the<</opt>> gnu general public license <<opt>>as published by the free software foundation<</opt>> <<opt>>either<</opt>> version 3 <<opt>>of the license<</opt>> <<opt>>or at your option any later version<</opt>>"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met <<var 0-80>> this software is provided by <<var 1-20>> as is and any express or implied warranties"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "spdx license identifier mit"),
    ("apache-2.0", "spdx license identifier apache 2 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("all-rights-reserved", "all rights reserved"),
]
#: The conditions of the BSD licences one by one, so that holders may have long names.
TEMPLATES.append(("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met <<var 0-1>> redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer <<var 0-1>> redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution <<opt>><<var 0-1>> all advertising materials mentioning features or use of this software must display the following acknowledgement this product includes software developed by <<var 1-30>><</opt>> <<opt>><<var 0-1>> neither the name of <<var 1-30>> may be used to endorse or promote products derived from this software without specific prior written permission<</opt>> this software is provided by <<var 1-30>> as is and any express or implied warranties"))
#: Creative Commons licences: the part of the label, then the words of the long form.
COMMONS = {"by": ["attribution"], "by-sa": ["attribution sharealike", "attribution share alike"], "by-nd": ["attribution noderivatives", "attribution no derivatives", "attribution noderivs"], "by-nc": ["attribution noncommercial", "attribution non commercial"], "by-nc-sa": ["attribution noncommercial sharealike", "attribution non commercial share alike"], "by-nc-nd": ["attribution noncommercial noderivatives", "attribution non commercial no derivatives", "attribution noncommercial noderivs"]}
for _part, _names in COMMONS.items():
    _short = _part.replace("-", " ")
    TEMPLATES += [(f"cc-{_part}", f"cc {_short} license"), (f"cc-{_part}", f"cc {_short} licence")]
    for _v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _n = _v.replace(".", " ")
        TEMPLATES += [(f"cc-{_part}-{_v}", t) for t in (f"cc {_short} {_n}", f"creativecommons org licenses {_short} {_n}", *(f"creative commons {x} {_n}" for x in _names))]
TEMPLATES += [("cc0-1.0", t) for t in ("cc0 1 0", "licensed under cc0", "creativecommons org publicdomain zero 1 0", "creative commons zero", "creative commons cc0")]
for _label, _name, _v in [("lgpl-2.0", "library", "2"), ("lgpl-2.1", "lesser", "2 1"), ("lgpl-3.0", "lesser", "3"), ("agpl-3.0", "affero", "3")]:
    TEMPLATES.append((_label, f"under the <<opt>>terms of the<</opt>> gnu {_name} general public license <<opt>>as published by the free software foundation<</opt>> <<opt>>either<</opt>> version {_v}"))
for _v in "12":
    TEMPLATES += [(f"epl-{_v}.0", f"eclipse public license <<opt>>v<</opt>> <<opt>>version<</opt>> {_v} 0"), (f"epl-{_v}.0", f"eclipse public license v{_v} 0")]
#: Labels whose SPDX identifier is the label; CC identifiers are short forms above.
TEMPLATES += [(_id, "spdx license identifier " + _id.replace("-", " ").replace(".", " ")) for _id in ("gpl-2.0", "gpl-3.0", "lgpl-2.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0", "mpl-1.1", "mpl-2.0", "epl-1.0", "epl-2.0", "isc", "cc0-1.0", "unlicense", "bsl-1.0", "zlib", "0bsd", "artistic-2.0", "cddl-1.0", "eupl-1.2", "ms-pl", "wtfpl")]
TEMPLATES += [("bsd", f"spdx license identifier bsd {_n} clause") for _n in "1234"]
MARK = re.compile(r"<<opt>>|<</opt>>|<<var (\d+)-(\d+)>>")


class Automaton:
    """A position automaton over words; states are sets of positions in a flat program.

    Instructions: ("word", w), ("any", least, most), ("jump", target): an optional part may be left out.
    """

    def __init__(self, template: str):
        self.code: list[tuple] = []
        opened: list[int] = []
        at = 0
        for m in [*MARK.finditer(template), None]:
            for w in WORD.findall(ascii_lower(template[at : m.start() if m else len(template)])):
                self.code.append(("word", w))
            if m is None:
                break
            at = m.end()
            if m[0] == "<<opt>>":
                opened.append(len(self.code))
                self.code.append(("jump", -1))
            elif m[0] == "<</opt>>":
                if not opened:
                    raise ValueError("an optional part is closed that isn't open")
                self.code[opened.pop()] = ("jump", len(self.code))
            else:
                if int(m[1]) > int(m[2]):
                    raise ValueError("bounds the wrong way round")
                self.code.append(("any", int(m[1]), int(m[2])))
        if opened:
            raise ValueError("an optional part isn't closed")
        self.end = len(self.code)
        self.start = self.closure({(0, 0)})
        if any(p == self.end for p, _ in self.start):
            raise ValueError("the template has no mandatory wording")
        #: Words with which a match can begin, None if any can.
        self.first = None if any(self.code[p][0] == "any" for p, _ in self.start) else {self.code[p][1] for p, _ in self.start if self.code[p][0] == "word"}
        run = self._needs()
        #: A word and a run of words that every match holds.
        self.rare, self.needs = max(run, key=len), phrase_pattern(run)
        #: The run's first two words, which many templates share.
        self.gate = tuple(run[:2])

    def closure(self, states: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        out, todo = set(), list(states)
        while todo:
            p, n = todo.pop()
            if (p, n) in out:
                continue
            out.add((p, n))
            if p < self.end:
                op = self.code[p]
                if op[0] == "jump":
                    todo += [(p + 1, 0), (op[1], 0)]
                elif op[0] == "any" and n >= op[1]:
                    todo.append((p + 1, 0))
        return frozenset((p, n) for p, n in out if p == self.end or self.code[p][0] != "jump")

    def step(self, states: frozenset, word: str) -> frozenset:
        out = set()
        for p, n in states:
            if p < self.end:
                op = self.code[p]
                if op[0] == "word":
                    if op[1] == word:
                        out.add((p + 1, 0))
                elif n < op[2]:
                    out.add((p, n + 1))
        return self.closure(out)

    def accepts_at(self, words: list[str], at: int) -> int | None:
        """The end of the shortest match that begins at a word, else None."""
        states = self.start
        for i in range(at, len(words) + 1):
            if any(p == self.end for p, _ in states):
                return i
            if not states or i == len(words):
                return None
            states = self.step(states, words[i])
        return None

    def find(self, words: list[str]) -> tuple[int, int] | None:
        """Start and end of the first place that the template takes."""
        for at, w in enumerate(words):
            if (self.first is None or w in self.first) and (end := self.accepts_at(words, at)) is not None:
                return at, end
        return None

    def _needs(self) -> list[str]:
        """The longest run of mandatory words, up to six of them."""
        best: list[str] = []
        run: list[str] = []
        skipped = -1
        for p, op in enumerate([*self.code, ("any", 0, 0)]):
            if op[0] == "jump":
                skipped = max(skipped, op[1])
            if op[0] == "word" and p >= skipped:
                run.append(op[1])
            else:
                best, run = max(best, run, key=len), []
        return best[:6]


def phrase_pattern(words: list[str]) -> re.Pattern:
    """A phrase's words where they stand consecutively; places may overlap."""
    return re.compile(rf"(?<![^\x00-\x2F\x3A-\x60\x7B-\x7F])(?=({GAP.join(map(re.escape, words))})(?![^\x00-\x2F\x3A-\x60\x7B-\x7F]))")


@functools.cache
def compiled() -> tuple[dict[str, re.Pattern], list[tuple[str, Automaton]]]:
    return {p: phrase_pattern(p.split()) for p in PHRASES}, [(label, Automaton(t)) for label, t in TEMPLATES]


@functools.cache
def gate_pattern(words: tuple[str, ...]) -> re.Pattern:
    return re.compile(GAP.join(map(re.escape, words)))


#: Bytes of words to "w", others to " ".
WORD_BYTES = bytes(ord("w" if b >= 0x80 or WORD.match(chr(b)) else " ") for b in range(256))


def count_words(text: str) -> int:
    """The number of the text's words: of its places where one begins."""
    return (b" " + text.encode("utf-8", "surrogatepass").translate(WORD_BYTES)).count(b" w")


def scan(text: str | None) -> dict:
    """What the docstring of the module says, and for each template label the words its first match spans."""
    text = ascii_lower(text or "")
    phrases, automata = compiled()
    places: list[int] = []
    base: set[str] = set()
    for phrase, pattern in phrases.items():
        # the last word of a phrase is rare enough to pass over most texts quickly
        if phrase.rsplit(" ", 1)[1] in text and (found := [m.start() for m in pattern.finditer(text)]):
            places += found
            base.add(PHRASES[phrase])
    words: list[str] | None = None
    spans = {}
    gates: dict[tuple[str, ...], bool] = {}
    for label, automaton in automata:
        if automaton.gate not in gates:
            gates[automaton.gate] = gate_pattern(automaton.gate).search(text) is not None
        if gates[automaton.gate] and automaton.rare in text and label not in spans and automaton.needs.search(text):
            words = words if words is not None else WORD.findall(text)
            if (span := automaton.find(words)) is not None:
                spans[label] = span
    index = [count_words(text[:p]) for p in ({min(places), max(places)} if places else ())]
    return {"n_words": count_words(text), "n_base": len(places), "first_word": min(index, default=None), "last_word": max(index, default=None), "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | spans.keys())), "score": 1.0 if spans else (1 - 0.5 ** len(places) if places else 0.0), "spans": [{"label": k, "first": a, "end": b} for k, (a, b) in sorted(spans.items())]}


SPANS = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64())]))
FIELDS = [("n_words", pa.int64(), "long"), ("n_base", pa.int64(), "long"), ("first_word", pa.int64(), "long"), ("last_word", pa.int64(), "long"), ("base_labels", pa.string(), "string"), ("labels", pa.string(), "string"), ("score", pa.float64(), "double"), ("spans", SPANS, "array<struct<label:string,first:long,end:long>>")]


def scan_texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of docs without the text, and what the scan found."""
    docs = replacing(docs, text, *(n for n, _, _ in FIELDS))
    at, kept = docs.columns.index(text), [(n, t) for n, t in docs.dtypes if n != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scan(t) for t in batch.column(at).to_pylist()]
            others = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays([*others, *(pa.array([f[n] for f in found], t) for n, t, _ in FIELDS)], names=[*(n for n, _ in kept), *(n for n, _, _ in FIELDS)])

    return map_batches(docs, run, ", ".join([*(f"`{n}` {t}" for n, t in kept), *(f"{n} {t}" for n, _, t in FIELDS)]))


def licenses_of_documents(docs: DataFrame) -> DataFrame:
    return scan_texts(docs.select("doc_id", "text")).drop("spans")


def template_regex(template: str) -> str:
    """A regular expression over a text's words, each with a space before it and one after the last."""
    out, at = "", 0
    for m in [*MARK.finditer(template), None]:
        out += "".join(f" {w}" for w in WORD.findall(ascii_lower(template[at : m.start() if m else len(template)])))
        if m:
            at = m.end()
            out += {"<<opt>>": "(?:", "<</opt>>": ")?"}.get(m[0]) or f"(?: [^ ]+){{{m[1]},{m[2]}}}"
    return out + " "


def oracle() -> str:
    """DuckDB SQL for licenses_of_documents."""
    quote = lambda t: "'" + t.replace("'", "''") + "'"
    at = lambda p: "list_filter(range(1, len(w) + 1), lambda i: " + " AND ".join(f"w[i + {k}] = {quote(x)}" for k, x in enumerate(p.split())) + ")"
    labels = sorted({label for label, _ in TEMPLATES})
    found = ", ".join("CASE WHEN " + " OR ".join(f"regexp_matches(s, {quote(template_regex(t))})" for k, t in TEMPLATES if k == label) + f" THEN {quote(label)} END" for label in labels)
    base = ", ".join(f"CASE WHEN len({at(p)}) > 0 THEN {quote(label)} END" for p, label in PHRASES.items())
    places = f"list_concat({', '.join(at(p) for p in PHRASES)})" if len(PHRASES) == 2 else "flatten([" + ", ".join(at(p) for p in PHRASES) + "])"
    joined = lambda x: f"array_to_string(list_sort(list_distinct({x})), ',')"
    return f"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
lines AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS s FROM words),
found AS (SELECT doc_id, len(w) AS n_words, {places} AS places, list_filter([{base}], lambda x: x IS NOT NULL) AS base, list_filter([{found}], lambda x: x IS NOT NULL) AS own FROM lines)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) - 1 AS BIGINT) AS first_word, CAST(list_max(places) - 1 AS BIGINT) AS last_word,
  {joined('base')} AS base_labels, {joined('list_concat(base, own)')} AS labels,
  CASE WHEN len(own) > 0 THEN 1.0 WHEN len(places) > 0 THEN 1 - power(0.5, len(places)) ELSE 0.0 END::DOUBLE AS score
FROM found"""
