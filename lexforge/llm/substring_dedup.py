"""Substring deduplication over sliding sentence spans.

A text is cut into units: sentences by the stops and line ends of all scripts, those of over LONG words once more between
words where a hash of the two words before says so, hence at the same places in every copy (letters of scripts without
spaces count as half a word each and may be split between). White space belongs to the unit before it, so the units joined
are the text. From each unit on, the shortest run of at least SENTENCES units and WORDS words is hashed to 64 bits, and so is
the one back from each unit that ends none of these: every passage of that many is covered to its ends, however short its
sentences are. A text that has no such run, as it is a single unit or too short, is one run.

All runs of all documents are grouped by hash; the first place of a run is the one with the smallest doc_id, then position.
Every unit that a run covers whose place is not the first is removed. Among N different runs a run meets an unlike one of
equal hash by chance with a probability of N / 2 ** 64 (5e-8 for 1e12 runs); none of them is compared by text.

Runs are made in one pass over the texts and written to the shared folder. Hot runs (boilerplate in a third of all documents)
are no obstacle: the first document is a partially aggregated minimum, runs are joined back with AQE splitting skewed keys,
and what reaches the per-document step is bounded by the document's own units. A run's later places within its own
document need no join.

Defined cases: null stays null and an empty text stays empty; a text that is removed whole becomes empty; rows with equal
doc_id are one document (none loses to another; of equal texts both are cut alike, unlike ones each by their own places); a
null doc_id is not deduplicated; runs that overlap themselves within one document count as repeats; a column of docs that
has the name of a result is replaced.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, replacing, written

#: Least units and words of a run.
SENTENCES, WORDS = 2, 15
#: Bits of a run's start and of its size within its place, and of the text's tag beside them.
PLACE, TAG = 24, 15
#: Sentences of over LONG words are split after one in SPLIT word pairs.
LONG, SPLIT = 15, 8
#: Ends of sentences in all scripts. Full-width, Ethiopic, Tibetan and similar stops need no space after them.
CLOSING = r"[\"')\]}»”’」』】）〉》]*"
SPACED_STOPS, STOPS, LINES = r".!?…‼-⁉", r"。．！？｡︒﹒﹖﹗।॥۔؟։።፧፨။၊។៕᙮᠃᠉᭞᭟꓿꘎꛳།༎𑁇𑁈", r"\n\r\v\f\x1c-\x1e\x85\u2028\u2029"
#: One class first, so that the search passes quickly over all else.
UNIT_END = re.compile(rf"[{SPACED_STOPS}{STOPS}{LINES}](?:(?<=[{SPACED_STOPS}])[{SPACED_STOPS}]*{CLOSING}\s+|(?<=[{STOPS}])[{STOPS}]*{CLOSING}\s*|(?<=[{LINES}])\s*)")
#: Letters of scripts that are written without spaces between words.
UNSPACED = "\u0e00-\u0eff\u0f40-\u0fbc\u1000-\u109f\u1780-\u17d3\u1950-\u19df\u1a20-\u1aad\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\ua9e0-\ua9fe\uaa60-\uaa7f\uf900-\ufaff\uff66-\uff9f\U0001b000-\U0001b16f\U00020000-\U0003ffff"
LETTER = re.compile(f"[{UNSPACED}]")
TOKEN = re.compile(f"\\s*(?:[{UNSPACED}]|[^\\s{UNSPACED}]+)\\s*")
#: The same in texts that have none of those letters.
SPACED = re.compile(r"\s*\S+\s*")


def n_words(text: str) -> int:
    """Words between white space; two letters of a script without it are one."""
    return len(text.split()) + (0 if text.isascii() or LETTER.search(text) is None else len(LETTER.findall(text)) // 2)


@functools.lru_cache(65_536)
def seed(word: str) -> int:
    return xxhash.xxh32_intdigest(word.encode("utf-8", "surrogatepass"))


def units(text: str) -> list[str]:
    """Sentences of any script, long ones in parts; together they are the text."""
    ends = [m.end() for m in UNIT_END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    out = []
    spaced = text.isascii() or LETTER.search(text) is None
    for a, b in zip([0, *ends], ends, strict=False):
        piece = text[a:b]
        words = piece.split() if spaced and b - a > 2 * LONG else ()
        if len(words) > LONG or (not spaced and b - a > LONG and n_words(piece) > LONG):
            tokens = (SPACED if spaced else TOKEN).findall(piece)
            seeds = [seed(w) for w in words or [t.strip() for t in tokens]]
            start = 0
            for i, (x, y) in enumerate(pairwise(seeds), 2):
                if (3 * x + y) % SPLIT == 0:
                    out.append("".join(tokens[start:i]))
                    start = i
            piece = "".join(tokens[start:])
        if piece:
            out.append(piece)
    return out


def passages(pieces: list[str], size: int = SENTENCES, words: int = WORDS) -> list[tuple[int, bytes]]:
    """Place (start << PLACE | size) and hash of the shortest runs of at least size units and so many words from each unit on,
    and back from each that ends none of these; of the whole text if it has none."""
    bare = [p.strip() for p in pieces]
    total = list(accumulate(map(n_words, bare), initial=0))
    n = len(bare)
    ahead = [bisect_left(total, total[i] + words, min(i + size, n + 1)) for i in range(n)]
    found = {(i, j) for i, j in enumerate(ahead) if j <= n}
    # where a run from a unit on ends, those that end with it need none of their own
    found |= {(i, j) for j in set(range(size, n + 1)).difference(ahead) if (i := min(j - size, bisect_right(total, total[j] - words, 0, j) - 1)) >= 0}
    if not found and total[n]:
        found = {(0, n)}
    line = "\n".join(bare)
    at = list(accumulate((len(b) + 1 for b in bare), initial=0))
    return [(i << PLACE | j - i, xxhash.xxh3_64_intdigest(line[at[i] : at[j] - 1].encode("utf-8", "surrogatepass"))) for i, j in sorted(found)]


def all_runs(docs: DataFrame, text: str = "text", size: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """doc_id, place (with the text's tag), h and again (not the first place of its hash in the text) of every run."""
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", tag_of(text).alias("tag"), text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags, texts = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_pylist()
            for at in range(0, len(texts), 200):  # runs of a few documents at a time
                owner, places, hashes, again = [], [], [], []
                for k, t in enumerate(texts[at : at + 200], at):
                    seen: set[int] = set()
                    for place, h in passages(units(t), size, words) if t else ():
                        owner.append(k)
                        places.append(place)
                        hashes.append(h)
                        again.append(h in seen)
                        seen.add(h)
                if owner:
                    tagged = np.array(places, np.int64) | tags[owner] << 2 * PLACE
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(owner)), pa.array(tagged), pa.array(np.array(hashes, np.uint64).view(np.int64)), pa.array(again)], names=["doc_id", "place", "h", "again"])

    return map_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, place long, h long, again boolean")


def tag_of(text: str) -> Column:
    """What tells the texts of one doc_id apart."""
    return F.xxhash64(text).bitwiseAND(F.lit((1 << TAG) - 1))


def repeated_places(runs: DataFrame) -> DataFrame:
    """doc_id, tag and the sorted places (start << PLACE | size) of its runs that aren't the first of their kind."""
    new = runs.where("not again").select("doc_id", "place", "h")
    first = new.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("h", "first")
    later = new.join(first, "h").where(F.col("doc_id") != F.col("first")).select("doc_id", "place")
    every = later.unionByName(runs.where("again").select("doc_id", "place"))
    place = F.col("place").bitwiseAND(F.lit((1 << 2 * PLACE) - 1))
    return every.groupBy("doc_id", F.shiftright("place", 2 * PLACE).alias("tag")).agg(F.array_sort(F.collect_set(place)).alias("starts"))


def remove_repeats(docs: DataFrame, text: str = "text", size: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """All columns of docs with covered units removed from the texts, then removed, the positions of these units."""
    docs = replacing(docs, text, "removed")
    columns = docs.columns
    places = repeated_places(written(all_runs(docs, text, size, words))).select(F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"), F.col("starts").alias("__starts"))
    joined = docs.join(places, (F.col("doc_id") == F.col("__id")) & (tag_of(text) == F.col("__tag")), "left").select(*columns, "__starts")
    at, last = columns.index(text), len(columns)
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column(last)
            cut = {int(k): starts[int(k)].as_py() for k in np.flatnonzero(starts.is_valid())}
            gone = [[]] * batch.num_rows
            out = list(batch.columns[:last])
            if cut:
                texts = out[at].to_pylist()
                for k, places in cut.items():
                    pieces = units(texts[k])
                    covered = {j for p in places for j in range(p >> PLACE, (p >> PLACE) + (p & (1 << PLACE) - 1))}
                    texts[k] = "".join([p for j, p in enumerate(pieces) if j not in covered])
                    gone[k] = sorted(covered)
                out[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*out, pa.array(gone, pa.list_(pa.int32()))], names=[*batch.schema.names[:last], "removed"])

    return map_batches(joined, run, f"{schema}, removed array<int>")


def deduplicated_documents(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs.select("doc_id", "text")).withColumn("removed", F.array_join("removed", ","))
