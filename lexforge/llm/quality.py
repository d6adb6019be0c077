"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded (WIDTH numbers each); FILTERS learned filters of KERNEL bytes move over the text in steps of STRIDE;
their rectified outputs are max-pooled within chunks of CHUNK bytes which overlap by half and cover the whole document;
the largest and the mean chunk feature over the document go through one hidden layer into a single probability.

The network is fitted by Adam on a bounded sample of labelled rows (SAMPLE_TEXTS and SAMPLE_CHARS for each label), the
same at every size. Scores use the text alone.

Defined cases: null and empty texts are scored as an empty text (one chunk of padding); texts of any length are read
whole, in slices of bounded memory; repeated rows get equal scores; without labels of both kinds every score is 0.5;
documents without a label row, and label rows without a document, don't matter; a document with several label rows
counts as label 1 if their mean is at least 0.5; a column of docs that has the name of the score is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_batches, replacing, training_sample

WIDTH, FILTERS, KERNEL, STRIDE, CHUNK, HIDDEN = 6, 24, 8, 4, 256, 16
HALF, PER_HALF = CHUNK // 2, CHUNK // 2 // STRIDE
#: Bounds of the training sample and the training itself.
SAMPLE_TEXTS, SAMPLE_CHARS, EPOCHS, BATCH, RATE = 1000, 1_500_000, 14, 16, 4e-3
#: Bytes that are convolved at once.
SLICE = 1 << 18


def padded(text: str | None) -> bytes:
    """UTF-8, filled with zero bytes to whole half chunks, at least STRIDE of them."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return data + bytes(STRIDE + (-len(data) - STRIDE) % HALF)


def layout(data: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All documents' bytes, each one's first half chunk, and which half chunks are a document's last."""
    ends = np.cumsum([len(d) // HALF for d in data])
    last = np.zeros(ends[-1], bool)
    last[ends - 1] = True
    return np.frombuffer(b"".join(data), np.uint8), np.append(0, ends[:-1]), last


class Network:
    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)
        f4 = np.float32
        self.p = {
            "emb": rng.normal(0, 0.5, (256, WIDTH)).astype(f4),
            "w": rng.normal(0, 1 / np.sqrt(KERNEL * WIDTH * 0.25), (KERNEL * WIDTH, FILTERS)).astype(f4),
            "b": np.zeros(FILTERS, f4),
            "u": rng.normal(0, 1 / np.sqrt(2 * FILTERS), (2 * FILTERS, HIDDEN)).astype(f4),
            "c": np.zeros(HIDDEN, f4),
            "v": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(f4),
            "d": np.zeros(1, f4),
        }

    def halves(self, data: np.ndarray, last: np.ndarray, where: bool = False):
        """Each half chunk's largest output of each filter, before bias and rectifier; where: also the window it is at.

        A document's very last window would reach into the next one; it holds padding alone and is left out.
        """
        p, cut = self.p, STRIDE * WIDTH
        w = np.hstack([p["w"][:cut], p["w"][cut:]])
        tops, spots = [], []
        for at in range(0, len(data), SLICE):
            part = data[at : at + SLICE + STRIDE]
            if len(part) <= SLICE:  # the last slice: beyond it there are zeros
                part = np.concatenate([part[: len(data) - at], np.zeros(STRIDE, np.uint8)])
            y = p["emb"][part].reshape(-1, cut) @ w
            out = (y[:-1, :FILTERS] + y[1:, FILTERS:]).reshape(-1, PER_HALF, FILTERS)
            out[last[at // HALF : at // HALF + len(out)], -1] = -np.inf
            if where:
                spot = out.argmax(1)
                spots.append(spot)
                tops.append(np.take_along_axis(out, spot[:, None], 1)[:, 0])
            else:
                tops.append(out.max(1))
        return (np.concatenate(tops), np.concatenate(spots)) if where else np.concatenate(tops)

    def features(self, tops: np.ndarray, starts: np.ndarray, last: np.ndarray):
        """Largest and mean chunk feature of each document; a chunk is a half and the next one, the last half stands alone."""
        r = np.maximum(tops + self.p["b"], 0)
        other = np.vstack([r[1:], r[-1:]])
        second = (other > r) & ~last[:, None]
        chunk = np.where(second, other, r)
        n = np.diff(np.append(starts, len(r)))[:, None].astype(np.float32)
        return r, second, np.maximum.reduceat(r, starts), np.add.reduceat(chunk, starts) / n, n

    def head(self, x: np.ndarray):
        h = np.maximum(x @ self.p["u"] + self.p["c"], 0)
        return h, 1 / (1 + np.exp(-np.clip(h @ self.p["v"] + self.p["d"], -30, 30)))

    def score(self, texts: list[str | None]) -> list[float]:
        if not texts:
            return []
        out, group, size = [], [], 0
        for t in texts:
            group.append(padded(t))
            size += len(group[-1])
            if size >= 8 * SLICE:
                out.append(self._score(group))
                group, size = [], 0
        if group:
            out.append(self._score(group))
        return np.concatenate(out).astype(float).tolist()

    def _score(self, data: list[bytes]) -> np.ndarray:
        flat, starts, last = layout(data)
        _, _, top, mean, _ = self.features(self.halves(flat, last), starts, last)
        return self.head(np.hstack([top, mean]))[1]

    def gradients(self, data: list[bytes], y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        flat, starts, last = layout(data)
        tops, spots = self.halves(flat, last, where=True)
        r, second, top, mean, n = self.features(tops, starts, last)
        x = np.hstack([top, mean])
        h, prob = self.head(x)
        g = ((prob - y) * weight / len(y)).astype(np.float32)
        out = {"v": h.T @ g, "d": g.sum(keepdims=True)}
        gh = np.outer(g, p["v"]) * (h > 0)
        out |= {"u": x.T @ gh, "c": gh.sum(0)}
        gx = gh @ p["u"].T
        owner = np.repeat(np.arange(len(data)), n[:, 0].astype(int))
        gc = (gx[:, FILTERS:] / n)[owner]
        gr = np.where(second, 0, gc)
        gr[1:] += np.where(second, gc, 0)[:-1]
        is_top = r == top[owner]
        ties = np.add.reduceat(is_top.astype(np.float32), starts)
        gr += np.where(is_top, (gx[:, :FILTERS] / ties)[owner], 0)
        gr = gr * (tops + p["b"] > 0)
        out["b"] = gr.sum(0)
        full = np.concatenate([flat, np.zeros(KERNEL, np.uint8)])
        base = np.arange(len(tops))[:, None] * HALF + spots * STRIDE  # half, filter
        gw, ge = np.zeros_like(p["w"]), np.zeros_like(p["emb"])
        for f in range(FILTERS):
            rows = np.flatnonzero(gr[:, f])
            if len(rows):
                window = full[base[rows, f][:, None] + np.arange(KERNEL)]
                gw[:, f] = gr[rows, f] @ p["emb"][window].reshape(len(rows), -1)
                for j in range(KERNEL):
                    s = np.bincount(window[:, j], weights=gr[rows, f], minlength=256).astype(np.float32)
                    ge += s[:, None] * p["w"][j * WIDTH : (j + 1) * WIDTH, f]
        return out | {"w": gw, "emb": ge}


def fit(samples: dict[int, list[str]], share: float | None = None, seed: int = 11) -> Network | None:
    """Adam over shuffled batches; None without both labels. share: of label 1 among all labelled rows, which the weights restore."""
    if not samples.get(0) or not samples.get(1):
        return None
    net, rng = Network(seed), np.random.default_rng(seed)
    data = [padded(t) for k in (0, 1) for t in samples[k]]
    y = np.array([k for k in (0, 1) for _ in samples[k]], np.float32)
    n = len(y)
    share = y.mean() if share is None else min(max(share, 0.02), 0.98)
    weight = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean())).astype(np.float32)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s = {k: np.zeros_like(v) for k, v in net.p.items()}
    steps, total = 0, EPOCHS * -(-n // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            ids = order[at : at + BATCH]
            steps += 1
            rate = RATE * (1 - 0.9 * steps / total)
            for k, g in net.gradients([data[i] for i in ids], y[ids], weight[ids]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                net.p[k] -= (rate * (m[k] / (1 - 0.9**steps)) / (np.sqrt(s[k] / (1 - 0.999**steps)) + 1e-8)).astype(np.float32)
    return net


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Network | None:
    """Fit on a bounded sample of the documents that have a label."""
    marks = labels.where(F.col(label).isNotNull()).groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("__label"))
    share = marks.agg(F.avg("__label")).first()[0]
    return fit(training_sample(marks, "__label", docs, "text", "doc_id", SAMPLE_TEXTS, SAMPLE_CHARS, 5), share)


def classify(docs: DataFrame, net: Network | None, text: str = "text", score: str = "score") -> DataFrame:
    """All columns of docs and the score, a probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    docs = replacing(docs, text, score)
    at, schema = docs.columns.index(text), ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            got = shared.value.score(texts) if shared.value else [0.5] * len(texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.float64())], names=[*batch.schema.names, score])

    return map_batches(docs, run, f"{schema}, `{score}` double")


def quality_of_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labelled rows that aren't held out; score every row."""
    net = train(docs.where(~held_out(F.col("doc_id"))), labels.where(~held_out(F.col("doc_id"))))
    scored = classify(docs.select("doc_id", "text"), net)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
