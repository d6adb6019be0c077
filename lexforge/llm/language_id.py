"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built over a bounded sample of labelled text. A text is parsed greedily
against each automaton: a phrase is the longest stretch that occurs in the sample, a symbol that the sample
lacks is a phrase of its own. Phrases are normalised as phrases * log2(sample length) / text length, an estimate of the cross
entropy in bits per symbol; the language with the fewest normalised phrases wins, ties going to the first name.

Texts are folded to symbols: letters lower-cased, each run of other characters one separator. All blocks of BLOCK symbols
of a batch are parsed side by side in numpy, so that a long text takes no longer than many short ones. A block is first parsed
as if a phrase began there; then, from the state in which the block before it ends, until both parses are in one state, from
which on they are the same. The counts are those of one parse of the whole text.

Defined cases: null, empty and letterless texts give `und` with score 0; without any labelled text every document is
`und`; repeated rows give repeated results; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_batches, training_sample

#: Bounds of the training sample: whole texts and characters for each language; symbols in a block of the parse.
SAMPLE_TEXTS, SAMPLE_CHARS, BLOCK = 60, 24_000, 4096
#: Every so many symbols the states of the two parses are compared.
COMPARE = 64
#: Characters of texts that are parsed together (or one text).
TOGETHER = 1 << 20
#: Steepness of the score over the difference in bits per symbol.
STEEP = 4.0
UND = "und"


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is its root."""
    goto: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(goto)
        goto.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in goto[p]:
            goto[p][c] = new
            p = link[p]
        if p >= 0:
            q = goto[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(goto)
                goto.append(dict(goto[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and goto[p].get(c) == q:
                    goto[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return goto


def folded(texts: list[str]) -> str:
    """The texts in lower case, ended by line feeds. Case folding that would change the number of characters is left out."""
    low = [t.lower() for t in texts]
    return "".join((a if len(a) == len(b) else b) + "\n" for a, b in zip(low, texts, strict=True))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Model:
    """Automata of all languages in one transition table of which only the transitions that exist are stored.

    A state's transitions lie at its base + symbol; owner says whose place it is. Elsewhere a phrase ends and the next one
    starts at the symbol: at the root's transition, or at the root if the language lacks the letter.
    """

    def __init__(self, samples: dict[str, list[str]]):
        self.languages = sorted(samples)
        letters: dict[str, int] = {}
        for texts in samples.values():
            for ch in folded(texts):
                if ch.isalpha():
                    letters[ch] = letters.get(ch, 0) + 1
        #: 0 is the separator, 1 a letter that no sample has; frequent letters have small symbols.
        self.letters = {ch: i + 2 for i, ch in enumerate(sorted(letters, key=lambda ch: (-letters[ch], ch)))}
        self.width = len(self.letters) + 2
        self.lut = np.array([self.letters.get(chr(i), 1 if chr(i).isalpha() else 0) for i in range(0x110000)], np.int32)
        flats, gotos, offsets, self.bits = [], [], [], []
        for language in self.languages:
            flat, ends = self.symbols(samples[language])
            offsets.append(sum(map(len, gotos)))
            gotos.append(automaton(flat[: int(ends[-1])].tolist() if len(ends) else []))
            self.bits.append(np.log2(max(2, len(flat))))
        rows = [(offset + state, row, offset) for goto, offset in zip(gotos, offsets, strict=True) for state, row in enumerate(goto)]
        base = self._places([row for _, row, _ in rows])
        size = int(base.max(initial=0)) + self.width
        self.base, self.owner, self.next = base, np.full(size, -1, np.int32), np.zeros(size, np.int32)
        for state, row, offset in rows:
            for c, q in row.items():
                self.owner[base[state] + c] = state
                self.next[base[state] + c] = offset + q
        self.roots = np.array(offsets, np.int32)
        #: The root's transitions on every symbol.
        self.starts = np.array([[o + goto[0].get(c, 0) for c in range(self.width)] for goto, o in zip(gotos, offsets, strict=True)], np.int32).reshape(len(gotos), self.width)

    def _places(self, rows: list[dict[int, int]]) -> np.ndarray:
        """A base for each row at which its symbols meet no other row's."""
        base = np.zeros(len(rows), np.int32)
        taken = bytearray(self.width + sum(map(len, rows)) * 2)
        reached: dict[int, int] = {}  # of rows of a size, the place up to which others of it were tried
        for i in sorted(range(len(rows)), key=lambda i: -len(rows[i])):
            symbols = list(rows[i])
            if not symbols:
                continue
            least = min(symbols)
            place = max(reached.get(len(symbols), 0), least)
            while True:
                if place + self.width >= len(taken):
                    taken.extend(bytes(len(taken)))
                place = taken.index(0, place)
                if place + self.width < len(taken) and not any([taken[place - least + c] for c in symbols]):
                    break
                place += place + self.width < len(taken)
            reached[len(symbols)] = place
            base[i] = place - least
            for c in symbols:
                taken[place - least + c] = 1
        return base

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' symbols in one array, without repeated separators, and each text's end in it."""
        flat = self.lut[code_points(folded(texts))]
        keep = flat != 0  # a separator stays after a letter alone, also at the start of a text
        keep[1:] |= flat[:-1] != 0
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        if len(ends):
            keep[ends - 1] = True  # each text ends with a separator
        return flat[keep], np.cumsum(keep)[ends - 1] if len(ends) else ends

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases of each text for each language, its symbols and its letters."""
        flat, ends = self.symbols(texts)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        lengths = ends - starts
        blocks = -(-lengths // BLOCK)
        owner = np.repeat(np.arange(len(texts)), blocks)
        at = starts[owner] + BLOCK * (np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
        size = np.minimum(BLOCK, ends[owner] - at)
        n, m = len(self.languages), len(at)
        # a lane is a block for one language; lanes of longer blocks come first
        order = np.argsort(-size, kind="stable")
        lane_at, lane_size, language = np.repeat(at[order], n), np.repeat(size[order], n), np.tile(np.arange(n), m)
        later = np.repeat(at[order] > starts[owner[order]], n)
        state, count, marks = self.parse(flat, lane_at, lane_size, language, self.roots[language], later)
        place = np.empty(m, np.int64)
        place[order] = np.arange(m)
        lane = lambda block: (place[block][:, None] * n + np.arange(n)).ravel()
        follows = np.flatnonzero(owner[1:] == owner[:-1]) + 1
        while len(follows):  # blocks whose predecessor's end isn't the state they were begun in, or was changed
            mine = lane(follows)
            mine = mine[np.argsort(-lane_size[mine], kind="stable")]
            before = lane(follows - 1)
            given = dict(zip(lane(follows).tolist(), state[before].tolist(), strict=True))
            entry = np.array([given[i] for i in mine.tolist()], state.dtype)
            changed = self.amend(flat, lane_at, lane_size, language, mine, entry, state, count, marks)
            again = np.unique(order[changed // n] + 1)
            follows = again[np.isin(again, np.flatnonzero(owner[1:] == owner[:-1]) + 1)]
        total = np.zeros((n, len(texts)), np.int64)
        for i in range(n):
            total[i] = np.bincount(owner[order], weights=count[i::n], minlength=len(texts))
        letters = np.add.reduceat(flat > 0, starts, dtype=np.int64) if len(texts) else starts
        return total, lengths, letters

    def step(self, state: np.ndarray, symbol: np.ndarray, language: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next states, and where a phrase begins."""
        place = self.base[state] + symbol
        stays = self.owner[place] == state
        # at a root, a letter starts a phrase whether the language has it or not
        return np.where(stays, self.next[place], self.starts[language, symbol]), ~stays | (state == self.roots[language])

    def parse(self, flat: np.ndarray, at: np.ndarray, size: np.ndarray, language: np.ndarray, state: np.ndarray, later: np.ndarray) -> tuple[np.ndarray, np.ndarray, dict]:
        """End state and phrases of lanes in descending order of size; and each COMPARE symbols, of the lanes marked later, the
        states and the phrases so far."""
        state, count, marks = state.copy(), np.zeros(len(at), np.int64), {}
        watched = np.flatnonzero(later)
        for t in range(int(size[0]) if len(size) else 0):
            a = int(np.searchsorted(-size, -t, side="left"))
            state[:a], begun = self.step(state[:a], flat[at[:a] + t], language[:a])
            count[:a] += begun
            if (t + 1) % COMPARE == 0 and len(watched):
                w = watched[: np.searchsorted(watched, a)]
                marks[t + 1] = dict(zip(w.tolist(), zip(state[w].tolist(), count[w].tolist(), strict=True), strict=True))
        return state, count, marks

    def amend(self, flat: np.ndarray, at: np.ndarray, size: np.ndarray, language: np.ndarray, lanes: np.ndarray, entry: np.ndarray, state: np.ndarray, count: np.ndarray, marks: dict) -> np.ndarray:
        """Parse lanes once more from their entry states until they meet their former parse; state, count and marks become those of
        the new one. Returns the lanes whose end state changed."""
        now, new = entry.copy(), np.zeros(len(lanes), np.int64)
        old_state = state[lanes].copy()
        open_, done = np.ones(len(lanes), bool), 0
        while open_.any():
            idx = np.flatnonzero(open_)
            for t in range(done, done + COMPARE):
                live = idx[size[lanes[idx]] > t]
                if not len(live):
                    break
                now[live], begun = self.step(now[live], flat[at[lanes[live]] + t], language[lanes[live]])
                new[live] += begun
            done += COMPARE
            known = marks.get(done, {})
            for k in idx.tolist():
                lane = int(lanes[k])
                if size[lane] <= done - COMPARE or size[lane] < done or lane not in known:
                    if size[lane] <= done:
                        state[lane], count[lane] = now[k], new[k]
                        open_[k] = False
                    continue
                met_state, met_count = known[lane]
                if met_state == now[k]:
                    count[lane] += new[k] - met_count
                    for later in marks:  # further marks of the lane count from the new beginning as well
                        if later >= done and lane in marks[later]:
                            marks[later][lane] = (marks[later][lane][0], marks[later][lane][1] + int(new[k]) - met_count)
                    open_[k] = False
                else:
                    known[lane] = (int(now[k]), int(new[k]))
                    if size[lane] == done:
                        state[lane], count[lane] = now[k], new[k]
                        open_[k] = False
        return lanes[state[lanes] != old_state]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; whole texts, about TOGETHER characters at a time."""
        langs, scores, at, size = [], [], 0, 0
        for k, t in enumerate(texts):
            size += len(t or "")
            if size >= TOGETHER or k == len(texts) - 1:
                some = self._predict(texts[at : k + 1])
                langs += some[0]
                scores += some[1]
                at, size = k + 1, 0
        return langs, scores

    def _predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not texts or not self.languages:
            return [UND] * len(texts), [0.0] * len(texts)
        total, lengths, letters = self.phrases([t or "" for t in texts])
        rate = total * np.array(self.bits)[:, None] / np.maximum(lengths, 1)
        best = rate.argmin(0)
        score = 1 / np.exp(-STEEP * (rate - rate.min(0))).sum(0)
        return [self.languages[b] if k else UND for b, k in zip(best, letters, strict=True)], [float(s) if k else 0.0 for s, k in zip(score, letters, strict=True)]


def train(labelled: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id") -> Model:
    """Automata from a bounded sample (SAMPLE_TEXTS, SAMPLE_CHARS for each language) of the labelled rows."""
    return Model({str(k): v for k, v in training_sample(labelled, label, labelled, text, key, SAMPLE_TEXTS, SAMPLE_CHARS, 7).items()})


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep, lang_pred and score of every row."""
    rows = docs.select(*keep, F.col(text).alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = shared.value.predict(batch.column(batch.num_columns - 1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])

    kept = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-1])
    return map_batches(rows, run, f"{kept}, lang_pred string, score double")


def language_of_documents(docs: DataFrame) -> DataFrame:
    """Learn from the rows that aren't held out and have a language; predict every row."""
    model = train(docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
