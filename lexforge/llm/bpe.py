"""BPE encoding and decoding with a public word-level BPE vocabulary.

A batch's distinct words are encoded together: their symbols lie in one flat array, ranks of neighbouring pairs are
found by binary search over the sorted pair keys, and in each round every word merges all places of its lowest-rank
pair, from left to right. This gives what merging one pair at a time gives, since no merge ranks below one that makes
its parts; the loader checks that of the vocabulary.

Normalising and splitting follow the vocabulary file: special tokens first, in the raw text; then NFC, lower case by
single characters, words by its pattern, bytes as the byte-level alphabet, with `</w>` on a word's last symbol; the Unicode
tables are the fixed ones of the reference encoder, whatever versions of them Python has. As the file has no decoder,
decoding joins the tokens with spaces.

Defined cases: null is an empty text; an empty text has no tokens, the ids "" and the decoded text ""; lone surrogates
can't occur in Spark's strings; words and texts of any length are taken whole; equal texts give equal results; columns of
docs that have the name of a result are replaced.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, replacing

#: Words whose encoding a worker keeps; beyond this mean length it keeps none.
CACHE, LONG = 250_000, 64
FAR = np.int64(1 << 40)


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte: itself where it is a visible Latin-1 character, else the next unused one from 256."""
    own = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


#: Letters, numbers and white space of Latin text (U+0000 to U+024F in lower case), as classes of the re module, which is
#: faster than the regex module; a text with any other character is split by the latter.
LATIN_L, LATIN_N, LATIN_SPACE = "a-zªµºß-öø-ɏ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
NOT_LATIN = re.compile("[^\0-@[-¿×ß-ɏ]")


def latin(pattern: str) -> str:
    """The pattern of words with its Unicode classes spelt out for Latin text."""
    return pattern.replace(r"[\p{L}]", f"[{LATIN_L}]").replace(r"[\p{N}]", f"[{LATIN_N}]").replace(r"\p{White_Space}", LATIN_SPACE).replace(r"\p{L}", LATIN_L).replace(r"\p{N}", LATIN_N)


#: Where the Unicode versions of the vocabulary's reference encoder differ from those of Python's own tables.
#: It has the classes of Unicode 16, the lower case of 17 and, for composition, no mark that came after version 9.
#: Letters and numbers up to version 16 that an older table lacks, then those that came later.
LETTERS_ADDED = "1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B 1138E 11390-113B5 113B7 113D1 113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF 1E5D0-1E5ED 1E5F0"
NUMBERS_ADDED = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"
LETTERS_LATER = "558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
NUMBERS_LATER = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"
#: Capital letters (first, last) and the first of their small ones.
CAPITALS = [(0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB)]
#: Marks that the reference neither moves nor composes.
UNMOVED = "7FD 898-89F 8CA-8D3 9FE C3C D3B-D3C EBA 1715 1ABF-1ACE 1DF6-1DFA A82C 10D24-10D27 10EAB-10EAC 10EFD-10EFF 10F46-10F50 10F82-10F85 11070 1133B 1145E 11839-1183A 11930 1193D-1193E 11943 119E0 11A34 11A47 11A99 11D42 11D44-11D45 11D97 11F41-11F42 16FF0-16FF1 1E08F 1E130-1E136 1E2AE 1E2EC-1E2EF 1E4EC-1E4EF"


def class_of(ranges: str) -> str:
    """Hexadecimal ranges as the inside of a character class."""
    return "".join("-".join(f"\\U{int(x, 16):08X}" for x in r.split("-")) for r in ranges.split())


CAPITAL = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b, _ in CAPITALS) + "]")
SMALL = {c: c - a + to for a, b, to in CAPITALS for c in range(a, b + 1)}
FIXED_MARK = re.compile(f"([{class_of(UNMOVED)}])")


def composed(text: str) -> str:
    """NFC, in which marks of UNMOVED are letters of their own."""
    if FIXED_MARK.search(text):
        return "".join([unicodedata.normalize("NFC", part) for part in FIXED_MARK.split(text)])
    return unicodedata.normalize("NFC", text)


def lowered(text: str) -> str:
    """Lower case, character by character."""
    text = text.replace("Σ", "σ").lower()
    return text.translate(SMALL) if CAPITAL.search(text) else text


def general(pattern: str) -> str:
    """The pattern of words with its Unicode classes as the reference has them, for the regex module."""
    letters, numbers = rf"\p{{L}}{class_of(LETTERS_ADDED)}", rf"\p{{N}}{class_of(NUMBERS_ADDED)}"
    later = class_of(LETTERS_LATER) + class_of(NUMBERS_LATER)
    out = pattern.replace(r"[\p{L}]", f"[[{letters}]--[{later}]]").replace(r"[\p{N}]", f"[[{numbers}]--[{later}]]")
    other = r"[^\s\p{L}\p{N}]"
    if other not in out:
        raise ValueError("the vocabulary's pattern of words is not the known one")
    return "(?V1)" + out.replace(other, rf"(?:[^\p{{White_Space}}{letters}{numbers}]|[{later}])")


class WordBpe:
    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        vocab: dict[str, int] = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        end = model["end_of_word_suffix"]
        self.tokens = [""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        alphabet = byte_alphabet()
        self.inner = np.array([vocab[c] for c in alphabet], np.int64)
        self.final = np.array([vocab[c + end] for c in alphabet], np.int64)
        self.size = len(self.tokens)
        pairs = [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
        born = {int(i): -1 for i in [*self.inner, *self.final]}
        for rank, (a, b, made) in enumerate(pairs):
            if made in born or a not in born or b not in born:
                raise ValueError("a merge ranks below one that makes its parts")
            born[made] = rank
        keys = np.array([a * self.size + b for a, b, _ in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([m for _, _, m in pairs], np.int64)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        words = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(general(words))
        self.latin_words = re.compile(latin(words.replace(r"\s", r"\p{White_Space}")))
        self.numerals = [str(i) for i in range(self.size)]
        self.forget()

    def forget(self) -> None:
        """The words met lately get numbers from 0; by these, ids and tokens of each, joined with spaces."""
        self.number: dict[str, int] = defaultdict(itertools.count().__next__)
        self.ids_of: list[str] = []
        self.tokens_of: list[str] = []

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], FAR)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word, which is a non-empty string."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.array([len(d) for d in data])
        flat = np.frombuffer(b"".join(data), np.uint8)
        sym, word = self.inner[flat], np.repeat(np.arange(len(words), dtype=np.int32), size)
        last = np.cumsum(size) - 1
        sym[last] = self.final[flat[last]]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = np.full(len(sym), FAR)
        inside = word[:-1] == word[1:]
        rank[:-1][inside] = self.rank_of(sym[:-1][inside], sym[1:][inside])
        while len(sym):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, first)
            count = np.diff(np.append(first, len(word)))
            open_ = np.repeat(least < FAR, count)
            if not open_.all():  # words that have no pair left
                done.append((word[~open_], sym[~open_]))
                sym, word, rank = sym[open_], word[open_], rank[open_]
                if not len(sym):
                    break
                least, count = least[least < FAR], count[least < FAR]
            hit = np.flatnonzero(rank == np.repeat(least, count))
            # of places that overlap, every second one from the left of their run
            run = np.append(True, np.diff(hit) > 1)
            nth = np.arange(len(hit)) - np.repeat(np.flatnonzero(run), np.diff(np.append(np.flatnonzero(run), len(hit))))
            hit = hit[nth % 2 == 0]
            sym[hit] = self.made[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[hit + 1] = False
            place = (np.cumsum(keep) - 1)[hit]
            sym, word, rank = sym[keep], word[keep], rank[keep]
            touched = np.zeros(len(sym), bool)
            touched[place] = touched[np.maximum(place - 1, 0)] = True
            stale = np.flatnonzero(touched)
            rank[stale] = FAR
            stale = stale[stale < len(sym) - 1]
            stale = stale[word[stale] == word[stale + 1]]
            rank[stale] = self.rank_of(sym[stale], sym[stale + 1])
        words_, syms = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (np.zeros(0, int), np.zeros(0, int))
        order = np.argsort(words_, kind="stable")
        ids, ends = syms[order].tolist(), np.cumsum(np.bincount(words_, minlength=len(words))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def pieces(self, text: str) -> list[str]:
        """The text's words in order; a special token stands as itself after a NUL."""
        if "<|" not in text:
            return self._words(text)
        out = []
        for i, part in enumerate(self.cut.split(text)):
            out += ["\0" + part] if i % 2 else self._words(part)
        return out

    def _words(self, text: str) -> list[str]:
        text = text.lower() if text.isascii() else lowered(composed(text))
        return (self.words if NOT_LATIN.search(text) else self.latin_words).findall(text)

    def encoded(self, texts: list[str | None]) -> Iterator[tuple[str, str]]:
        """Each text's ids and its tokens, joined with spaces."""
        if len(self.number) > CACHE:
            self.forget()
        number, ids_of, tokens_of = self.number, self.ids_of, self.tokens_of
        split = [[number[w] for w in self.pieces(t or "")] for t in texts]
        new = list(itertools.islice(reversed(number), len(number) - len(ids_of)))[::-1]
        numerals, tokens = self.numerals, self.tokens
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            for w, ids in zip(part, self.encode_words(part), strict=True):
                if w[0] == "\0" and w[1:] in self.special:
                    ids = [self.special[w[1:]]]
                ids_of.append(" ".join([numerals[i] for i in ids]))
                tokens_of.append(" ".join([tokens[i] for i in ids]))
        for words in split:
            yield " ".join([ids_of[i] for i in words]), " ".join([tokens_of[i] for i in words])
        if sum(map(len, new)) > LONG * len(new):  # texts of very long words don't fill the memory
            self.forget()

    def encode(self, text: str | None) -> list[int]:
        return [int(i) for ids, _ in self.encoded([text]) for i in ids.split()]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.tokens[i] for i in ids])


@functools.cache
def tokenizer(path: str) -> WordBpe:
    with open(path, encoding="utf-8") as f:
        return WordBpe(f.read())


@functools.cache
def from_spec(spec: str) -> WordBpe:
    return WordBpe(spec)


def word_bpe_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_texts(docs: DataFrame, path: str | None = None, text: str = "text", ids: bool = True) -> DataFrame:
    """All columns of docs, then n_tokens, token_ids (if ids), ids_sha256, decoded (if ids) and decoded_sha256.

    path: the vocabulary file, read by the driver alone (a few MB, which are broadcast).
    """
    with open(path or word_bpe_path(), encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    extra = [("n_tokens", pa.int64(), "long")] + [("token_ids", pa.list_(pa.int32()), "array<int>")] * ids + [("ids_sha256", pa.string(), "string")] + [("decoded", pa.string(), "string")] * ids + [("decoded_sha256", pa.string(), "string")]
    docs = replacing(docs, text, *(n for n, _, _ in extra))
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = from_spec(spec.value)
        for batch in batches:
            got: dict[str, list] = {n: [] for n, _, _ in extra}
            for ids_text, decoded in bpe.encoded(batch.column(at).to_pylist()):
                got["n_tokens"].append(ids_text.count(" ") + 1 if ids_text else 0)
                got["ids_sha256"].append(hashlib.sha256(ids_text.encode()).hexdigest())
                got["decoded_sha256"].append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
                if ids:
                    got["token_ids"].append(np.array(ids_text.split(), np.int32) if ids_text else [])
                    got["decoded"].append(decoded)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(got[n], t) for n, t, _ in extra)], names=[*batch.schema.names, *(n for n, _, _ in extra)])

    schema = ", ".join([*(f"`{n}` {t}" for n, t in docs.dtypes), *(f"{n} {t}" for n, _, t in extra)])
    return map_batches(docs, run, schema)


def tokens_of_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    return encode_texts(docs.select("doc_id", "text"), path, ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
