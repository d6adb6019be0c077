"""Benchmark decontamination by q-gram lemma filtering.

Texts and benchmark items are folded to symbols: letters in lower case and digits, each run of other characters one
separator. A region of a text that is within k edits of an item shares at least n - q + 1 - k * q of the item's q-grams
(n symbols), on diagonals (text position minus item position) that differ by at most k. So shared q-grams are counted in
diagonal bands of width 2 * (k + 1) that overlap by half; bands that reach the bound are retained and verified by banded
alignment of the whole item against the region. Items take k = EDITS * n edits, and fewer where the bound would fall
below 1; the q-grams of an item of fewer than 2 * Q symbols are its exact match. Items of fewer than Q symbols have no q-gram:
they are found word by word, exactly, as whole words.

Every position of every text is looked up: a hash table of bytes says which q-grams an item can have, the rest are found
by binary search. Hits are expanded and counted in pieces of SLICE postings, whatever the text and however common a q-gram
is. The benchmark is dealt into blocks of at most BLOCK_SYMBOLS characters by the executors, which build their indexes; the
driver holds one block's index at a time, to broadcast it, and each block is one pass over the documents.

Defined cases: null and empty texts hold nothing; null items, and items without a letter or digit, aren't searched; repeated
rows each give their matches, repeated rows of the benchmark count once, equal items with several ids each match; ids of items may have any type and be null; an empty
benchmark matches nothing; of several regions that match an item the one with fewest edits, then the first, is reported;
columns of docs that have the name of a result don't matter to matches() and stay in clean().
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..runtime import importable
from .common import map_batches, written

Q, EDITS, BLOCK_SYMBOLS = 8, 0.08, 4_000_000
#: Positions looked at together, and characters of texts that are folded together (or one text).
SLICE, TEXTS = 1 << 17, 1 << 19
MIX = np.uint64(0x9E3779B97F4A7C15)
#: Diagonals are counted from so far to the left, which is more than the symbols of any item.
FAR_LEFT, LOW = 1 << 32, (1 << 40) - 1


def symbol_of(char: str) -> int:
    """0 separates, letters and digits have 1 to 255 (rare ones share)."""
    low = ord(char.lower()[0])
    return (low if low <= 127 else (low * 40503 >> 3) % 255 + 1) if char.isalnum() else 0


#: The symbols of the BMP.
TABLE = np.array([symbol_of(chr(i)) for i in range(1 << 16)], np.uint8)


def fold(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' symbols in one array, each ended by a separator, where each symbol came from, and the texts' ends."""
    flat = np.frombuffer("".join([(t or "") + "\n" for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = TABLE[np.minimum(flat, 65535)]
    if len(far := np.flatnonzero(flat > 65535)):
        chars, which = np.unique(flat[far], return_inverse=True)
        symbols[far] = np.array([symbol_of(chr(c)) for c in chars.tolist()], np.uint8)[which]
    keep = symbols != 0
    keep[1:] |= symbols[:-1] != 0
    ends = np.cumsum([len(t or "") + 1 for t in texts])
    keep[ends - 1] = True
    origin = np.flatnonzero(keep)
    return symbols[origin], origin, np.searchsorted(origin, ends, side="left")


def grams(symbols: np.ndarray) -> np.ndarray:
    """The q-gram that begins at each position, as a number; a view, with no copy."""
    n = max(0, len(symbols) - Q + 1)
    return np.ndarray((n,), "<u8", np.ascontiguousarray(symbols), 0, (1,))


class Index:
    """The q-grams of some items, which are kept as symbols."""

    def __init__(self, items: list[tuple[object, str]]):
        self.ids, self.items = [], []
        short: list[tuple[object, np.ndarray]] = []
        for i, text in items:
            symbols, _, _ = fold([text])
            symbols = np.trim_zeros(symbols)
            if len(symbols) >= Q:
                self.ids.append(i)
                self.items.append(symbols)
            elif len(symbols):
                short.append((i, symbols))
        #: How many of the items have q-grams; the short ones follow them.
        self.long = len(self.items)
        self.ids += [i for i, _ in short]
        #: Of each short item its code, by the item's size, in order.
        self.short = {size: sorted((int.from_bytes(s.tobytes(), "little"), self.long + k) for k, (_, s) in enumerate(short) if len(s) == size) for size in {len(s) for _, s in short}}
        n = np.array([len(s) for s in self.items], np.int64)
        self.length = n
        self.edits = np.clip((n * EDITS).astype(np.int64), 0, (n - Q) // Q)
        self.least = n - Q + 1 - self.edits * Q
        codes = np.concatenate([grams(s) for s in self.items]) if self.items else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(n)), np.maximum(n - Q + 1, 0))
        place = np.concatenate([np.arange(k - Q + 1) for k in n]) if len(n) else np.zeros(0, np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.first = np.unique(codes[order], return_index=True)
        self.count = np.diff(np.append(self.first, len(codes)))
        self.item, self.place = item[order].astype(np.int32), place[order].astype(np.int32)
        self.shift = np.uint64(64 - max(16, min(26, int(np.ceil(np.log2(max(1, len(self.codes)) * 64))))))
        self.seen = np.zeros(1 << (64 - int(self.shift)), bool)
        self.seen[(self.codes * MIX) >> self.shift] = True

    def hits(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text position, item and item position of every shared q-gram."""
        codes = grams(symbols)
        where, which = [], []
        for at in range(0, len(codes), SLICE):
            part = codes[at : at + SLICE].copy()
            maybe = np.flatnonzero(self.seen[(part * MIX) >> self.shift])
            found = np.minimum(np.searchsorted(self.codes, part[maybe]), len(self.codes) - 1)
            good = self.codes[found] == part[maybe]
            where.append(maybe[good] + at)
            which.append(found[good])
        if not where:
            return (np.zeros(0, np.int64),) * 3
        where, which = np.concatenate(where), np.concatenate(which)
        return where, which, self.count[which]

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """Text number, item number, edits, start and end (characters of the text) of each match; whole texts, some at a time."""
        out, at, size = [], 0, 0
        for k, t in enumerate(texts):
            size += len(t or "")
            if size >= TEXTS or k == len(texts) - 1:
                out += [(d + at, *rest) for d, *rest in self._search(texts[at : k + 1])]
                at, size = k + 1, 0
        return out

    def _search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        if not self.ids:
            return []
        symbols, origin, ends = fold(texts)
        base = np.cumsum([0, *(len(t or "") + 1 for t in texts)])
        found = {(d, i): (e, a, b) for d, i, e, a, b in self.whole_words(symbols, ends)}
        if self.long:
            item, low = self.bands(symbols)
            if len(item):
                found |= self.verified(item, low, symbols, ends)
        out = []
        starts = np.append(0, ends)
        for (doc, it), (edits, a, b) in sorted(found.items()):
            a, b = max(a, int(starts[doc])), min(b, int(ends[doc]))
            out.append((doc, it, edits, int(origin[a] - base[doc]), int(origin[b - 1] - base[doc]) + 1))
        return out

    def whole_words(self, symbols: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """The first place in each text of each short item, between separators."""
        out: dict[tuple[int, int], tuple] = {}
        for size, known in self.short.items():
            codes = np.array([c for c, _ in known], np.uint64)
            # a place begins after a separator and ends before one; every text ends with one
            start = np.flatnonzero(np.append(True, symbols[:-1] == 0))
            start = start[start + size < len(symbols)]
            start = start[symbols[start + size] == 0]
            for at in range(0, len(start), SLICE):
                part = start[at : at + SLICE]
                code = np.zeros(len(part), np.uint64)
                for k in range(size):
                    code |= symbols[part + k].astype(np.uint64) << np.uint64(8 * k)
                left, right = np.searchsorted(codes, code, "left"), np.searchsorted(codes, code, "right")
                for j in np.flatnonzero(right > left).tolist():
                    a = int(part[j])
                    doc = int(np.searchsorted(ends, a, side="right"))
                    for k in range(int(left[j]), int(right[j])):
                        out.setdefault((doc, known[k][1]), (doc, known[k][1], 0, a, a + size))
        return list(out.values())

    def bands(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Item and lowest diagonal of every band whose count of shared q-grams reaches the item's bound.

        Hits are counted in the order of the text. A band of an item is complete, and leaves, once the text is further than the
        item is long, so what is held depends on the items and not on the text.
        """
        where, which, count = self.hits(symbols)
        total = np.append(0, np.cumsum(count))
        cells, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        found: list[np.ndarray] = []
        keys: list[np.ndarray] = []
        numbers: list[np.ndarray] = []
        held = 0
        for at in range(0, int(total[-1]), SLICE):  # so many postings at a time, also within one q-gram's
            end = min(at + SLICE, int(total[-1]))
            a, b = int(np.searchsorted(total, at, side="right")) - 1, int(np.searchsorted(total, end, side="left"))
            edges = np.clip(total[a : b + 1], at, end)
            hit = np.repeat(np.arange(a, b), np.diff(edges))
            posting = np.arange(at, end) + (self.first[which[a:b]] - total[a:b])[hit - a]
            item = self.item[posting].astype(np.int64)
            diagonal = where[hit] - self.place[posting] + FAR_LEFT
            key, number = np.unique(item << 40 | (diagonal // (self.edits[item] + 1)), return_counts=True)
            keys.append(key)
            numbers.append(number)
            held += len(key)
            last = end == total[-1]
            if held > 4 * SLICE or last:
                cells, inverse = np.unique(np.concatenate([cells, *keys]), return_inverse=True)
                counts = np.bincount(inverse, weights=np.concatenate([counts, *numbers]), minlength=len(cells)).astype(np.int64)
                keys, numbers, held = [], [], 0
                # bands are two neighbouring cells of half their width; one that begins in the empty cell before counts as well
                follow = np.zeros(len(cells), np.int64)
                joined = np.flatnonzero(cells[1:] == cells[:-1] + 1)
                follow[joined] = counts[joined + 1]
                item = cells >> 40
                stays = ((cells & LOW) + 2) * (self.edits[item] + 1) - FAR_LEFT >= where[b - 1] - self.length[item]
                done = np.ones(len(cells), bool) if last else ~stays
                found.append(cells[done & (counts + follow >= self.least[item])])
                cells, counts = cells[~done], counts[~done]
        good = np.concatenate(found) if found else cells
        return good >> 40, (good & LOW) * (self.edits[good >> 40] + 1) - FAR_LEFT

    def verified(self, item: np.ndarray, low: np.ndarray, symbols: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
        """Text and item, with edits, start and end, of the regions that banded alignment confirms: the item whole, the region's
        ends free."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        k, size = self.edits[item], self.length[item]
        doc = self.text_at(low + k + size // 2, ends, len(symbols))
        # a verbatim copy needs no alignment, nor do the other regions of its item and text
        for j, (i, lo) in enumerate(zip(item.tolist(), low.tolist(), strict=True)):
            d = int(doc[j])
            a, b = max(lo - int(k[j]), int(ends[d - 1]) if d else 0), min(lo + 3 * int(k[j]) + 2 + int(size[j]), int(ends[d]))
            if (d, i) in best:
                continue
            at = symbols[a:b].tobytes().find(self.items[i].tobytes())
            if at >= 0:
                best[d, i] = (0, a + at, a + at + int(size[j]))
        open_ = np.array([(int(d), int(i)) not in best for d, i in zip(doc, item, strict=True)], bool)
        item, low = item[open_], low[open_]
        order = np.argsort(self.length[item], kind="stable")
        for at in range(0, len(order), 256):
            part = order[at : at + 256]
            self._align(item[part], low[part], symbols, ends, best)
        return best

    @staticmethod
    def text_at(position: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
        return np.minimum(np.searchsorted(ends, np.clip(position, 0, size - 1), side="right"), len(ends) - 1)

    def _align(self, item: np.ndarray, low: np.ndarray, symbols: np.ndarray, ends: np.ndarray, best: dict) -> None:
        k = self.edits[item]
        width = int(2 * (k.max() + 1) + 2 * k.max() + 1)  # diagonals low - k to low + 2 * (k + 1) + k
        n, far = len(item), 1 << 20
        base = low - k  # text position of the first column in row 0
        cost = np.zeros((n, width), np.int32)
        start = base[:, None] + np.arange(width)
        size = self.length[item]
        final, final_start, final_end = np.full(n, far), np.zeros(n, np.int64), np.zeros(n, np.int64)
        pad = np.zeros((n, int(size.max())), np.uint8)
        for j, i in enumerate(item):
            pad[j, : size[j]] = self.items[i]
        # a region stays within the text that most of it lies in
        doc = self.text_at(low + k + size // 2, ends, len(symbols))
        first, last = np.append(0, ends)[doc], ends[doc]
        ramp = np.arange(width)
        outside = (start < first[:, None]) | (start > last[:, None])
        cost[outside] = far
        for r in range(int(size.max())):
            # column c of row r is text position base + r + c
            pos = base[:, None] + r + ramp
            char = symbols[np.clip(pos, 0, len(symbols) - 1)]
            inside = (pos >= first[:, None]) & (pos < last[:, None])
            diag = cost + np.where((char == pad[:, r : r + 1]) & inside, 0, 1) + np.where(inside, 0, far)
            up = np.empty_like(cost)  # an item symbol that the text lacks
            up[:, :-1], up[:, -1] = cost[:, 1:] + 1, far
            take = up < diag
            new = np.where(take, up, diag)
            origin = np.where(take, np.concatenate([start[:, 1:], start[:, -1:]], 1), start)
            # text symbols that the item lacks: least of new[j] + (c - j) over j <= c
            slide = new - ramp
            run = np.minimum.accumulate(slide, 1)
            source = np.maximum.accumulate(np.where(slide == run, ramp, 0), 1)
            cost, start = np.minimum(run + ramp, far), np.take_along_axis(origin, source, 1)
            over = np.flatnonzero(size == r + 1)
            if len(over):
                c = cost[over].argmin(1)
                final[over], final_start[over] = cost[over, c], start[over, c]
                final_end[over] = base[over] + r + 1 + c
        for j in np.flatnonzero(final <= k):
            key, value = (int(doc[j]), int(item[j])), (int(final[j]), int(final_start[j]), int(final_end[j]))
            if key not in best or value < best[key]:
                best[key] = value


def indexes(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> Iterator[Index]:
    """Indexes of blocks of about BLOCK_SYMBOLS characters (a longer item is more), built by the executors, one at a time here."""
    rows = benchmark.where(F.col(text).isNotNull()).select(F.col(item).alias("item"), F.col(text).alias("text")).distinct()
    size = rows.agg(F.sum(F.length("text"))).first()[0]
    if not size:
        return
    blocks = -(-2 * size // BLOCK_SYMBOLS) if size > BLOCK_SYMBOLS else 1
    # an item is of the block that its hash gives; on the average a block has half of what it may have
    dealt = rows.select("item", "text", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)).alias("block"))
    if blocks == 1:
        yield Index([(r["item"], r["text"]) for r in dealt.collect()])
        return

    def build(key: tuple, group: pa.Table) -> pa.Table:
        return pa.table({"block": [key[0].as_py()], "index": [pickle.dumps(Index(list(zip(group["item"].to_pylist(), group["text"].to_pylist(), strict=True))))]}, pa.schema([("block", pa.int64()), ("index", pa.binary())]))

    importable(benchmark.sparkSession)
    made = written(dealt.groupBy("block").applyInArrow(build, "block long, index binary"))
    for block in sorted(r[0] for r in made.select("block").collect()):
        yield pickle.loads(made.where(F.col("block") == block).first()["index"])


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, item_id, edits, start_char and end_char of every item found in a text."""
    rows, out = docs.select(key, text), None
    kind = next(f.dataType for f in benchmark.schema if f.name == "item_id")
    schema = f"`{key}` {rows.dtypes[0][1]}, item_id {kind.simpleString()}, edits int, start_char long, end_char long"
    id_type = to_arrow_type(kind)
    for index in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = shared.value.search(batch.column(1).to_pylist())
                doc, item, edits, a, b = zip(*found, strict=True) if found else ([],) * 5
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc, pa.int64())), pa.array([shared.value.ids[i] for i in item], id_type), pa.array(edits, pa.int32()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=[key, "item_id", "edits", "start_char", "end_char"])

        part = map_batches(rows, run, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text holds no item."""
    at, schema = docs.columns.index(text), ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    for index in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[m[0] for m in shared.value.search(batch.column(at).to_pylist())]] = False
                yield batch.filter(pa.array(keep))

        docs = map_batches(docs, run, schema)
    return docs
