"""SimHash near-duplicates by a generalised pigeonhole index.

Fingerprints: 64 bits over XXH64 (seed 42) of all 3-word shingles; a bit is set if more than half of the shingles have it.
Two fingerprints link if at most RADIUS bits differ.

Search: bits are grouped into PARTS partitions so that correlated bits share one; with thresholds t that sum to
RADIUS - PARTS + 1 over the partitions, two linked fingerprints differ by at most t in some partition (a partition with
t = -1 isn't probed). Dynamic programming chooses the thresholds with the least cost, from candidate counts estimated by
the bit frequencies of all fingerprints. Each distinct fingerprint is indexed once in each partition, by its bits there,
and probes that index with all patterns within t; of the two fingerprints of a pair only one probes, the one whose bit is 0
at the lowest differing place. Candidates are verified on all 64 bits. Nothing is capped.

Equal fingerprints are one node of the graph; components come from large-star and small-star rounds. Exact copies never
become pairs, and a fingerprint has at most as many links as there are others within RADIUS bits (43,744), whatever the input.
The rows of a fingerprint that very many have aren't gathered: its component comes to them as a broadcast of bounded size.
Tables of fingerprints and of their probes grow with the input and are never broadcast, whatever their files' sizes suggest.

Defined cases: null and empty texts, and texts of white space, have fingerprint zero, which links like any other;
texts with one or two words are hashed whole; a null doc_id is a document that names no component; rows with equal ids
stay rows; no documents give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, join_on_counted, map_batches, not_broadcast, written
from .components import connected_components

BITS, RADIUS, SHINGLE, SEED, PARTS = 64, 3, 3, 42, 2
#: What a probe costs, in verified candidates.
PROBE_COST = 4.0


def fingerprint(text: str | None) -> int:
    """The unsigned fingerprint; words are runs of bytes but 0x20 and 0x09 to 0x0D after A-Z are lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = max(1, len(words) - SHINGLE + 1)
    if not words:
        return 0
    if n == 1:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 65_280):  # slices bound the memory of a long text
        part = [line[a:b] for a, b in zip(starts[at : at + 65_280], ends[SHINGLE - 1 :][at : at + 65_280].tolist(), strict=True)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(SEED)), np.uint64, len(part))
        bits = np.zeros((-(-len(part) // 255) * 255, BITS), np.uint8)
        bits[: len(part)] = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        # bytes are added eight at a time; 255 of them can't overflow
        sums = bits.view(np.uint64).reshape(-1, 255, BITS // 8).sum(1)
        counts += sums.view(np.uint8).reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n).view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns keep and fp, the fingerprint as a signed long."""
    rows = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(batch.num_columns - 1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps.view(np.int64))], names=[*keep, "fp"])

    return map_batches(rows, run, ", ".join([*(f"`{n}` {t}" for n, t in rows.dtypes[:-1]), "fp long"]))


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """The number of fingerprints and how many of them have both bits, for every two bits (4,096 counts, whatever the input)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            x = np.unpackbits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += (x.T @ x).round().astype(np.int64)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS + 1)), pa.array(np.append(total.ravel(), n))], names=["cell", "n"])

    cells = {r[0]: r[1] for r in map_batches(fps.select("fp"), run, "cell long, n long").groupBy("cell").agg(F.sum("n")).collect()}
    return cells.get(BITS * BITS, 0), np.array([cells.get(i, 0) for i in range(BITS * BITS)], float).reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int = PARTS) -> list[list[int]]:
    """Bits in partitions of equal size; each takes the bit that correlates most with what it holds until it is full."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    left, out = set(range(BITS)), []
    for k in range(parts):
        size = len(left) // (parts - k)
        order = sorted(left)
        seed = max(order, key=lambda i: (corr[i, order].sum(), -i))
        group = [seed]
        left.remove(seed)
        while len(group) < size:
            nxt = max(sorted(left), key=lambda i: (corr[i, group].mean(), -i))
            group.append(nxt)
            left.remove(nxt)
        out.append(sorted(group))
    return out


def estimated_cost(n: int, both: np.ndarray, bits: list[int], t: int) -> float:
    """Cost of probing a partition within t: its probes, and the pairs that differ by at most t there, from bit frequencies."""
    if t < 0:
        return 0.0
    p = both.diagonal()[bits] / max(n, 1)
    distance = np.zeros(len(bits) + 1)
    distance[0] = 1
    for d in 2 * p * (1 - p):
        distance[1:] = distance[1:] * (1 - d) + distance[:-1] * d
        distance[0] *= 1 - d
    probes = sum(math.comb(len(bits), k) for k in range(t + 1)) / 2
    return n * probes * PROBE_COST + n * n / 2 * distance[: t + 1].sum()


def allocate(n: int, both: np.ndarray, groups: list[list[int]], radius: int = RADIUS) -> list[int]:
    """The thresholds, each at least -1 and with the sum that the pigeonhole needs, of least estimated cost."""
    need = radius - len(groups) + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in groups:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for t in range(-1, radius + 1):
                c = cost + estimated_cost(n, both, group, t)
                if total + t not in nxt or c < nxt[total + t][0]:
                    nxt[total + t] = (c, [*chosen, t])
        best = nxt
    return best[need][1]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def bits_mask(bits) -> int:
    return signed(sum(1 << b for b in bits))


def flipped(part: int, key: Column):
    return lambda x: F.struct(F.lit(part).alias("part"), key.bitwiseXOR(x["m"]).alias("key"))


def links(fps: DataFrame, radius: int = RADIUS, parts: int = PARTS) -> DataFrame:
    """Pairs a, b of distinct fingerprints that differ in 1 to radius bits, each at least once; fps has distinct ones in fp."""
    n, both = bit_statistics(fps)
    groups = group_bits(n, both, parts)
    plan = [(k, group, t) for k, (group, t) in enumerate(zip(groups, allocate(n, both, groups, radius), strict=True)) if t >= 0]
    index, probes = [], []
    for k, group, t in plan:
        key: Column = F.col("fp").bitwiseAND(F.lit(bits_mask(group)))
        flips = [(bits_mask(c), bits_mask(c[:1])) for size in range(1, t + 1) for c in combinations(group, size)]
        index.append(F.struct(F.lit(k).alias("part"), key.alias("key")))
        probes.append(F.array(F.struct(F.lit(k).alias("part"), key.alias("key"))))
        if flips:
            masks = F.array(*(F.struct(F.lit(m).alias("m"), F.lit(low).alias("low")) for m, low in flips))
            own = F.filter(masks, lambda x: F.col("fp").bitwiseAND(x["low"]) == 0)
            probes.append(F.transform(own, flipped(k, key)))
    left = fps.select(F.col("fp").alias("a"), F.explode(F.array(*index)).alias("at")).select("a", "at.part", "at.key")
    right = fps.select(F.col("fp").alias("b"), F.explode(F.concat(*probes)).alias("at")).select("b", "at.part", "at.key")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).between(1, radius)
    return left.join(not_broadcast(right), ["part", "key"]).where(near).select("a", "b")


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable) of every row."""
    rows = checkpointed(fingerprints(docs, text))
    least = least_of_components(rows, "doc_id").withColumnRenamed("least", "component_id")
    return join_on_counted(rows, least, ["fp"]).select("doc_id", "fp", "component_id")


def least_of_components(rows: DataFrame, key: str) -> DataFrame:
    """Each fingerprint fp, how many rows have it, and the least key of the rows of its component."""
    nodes = written(rows.groupBy("fp").agg(F.min(key).alias("first"), F.count("*").alias("n")))
    found = connected_components(links(nodes.select("fp")))
    inside = found.withColumnRenamed("node", "fp").join(not_broadcast(nodes), "fp")
    least = inside.groupBy("component").agg(F.min("first").alias("least"))
    linked = found.join(least, "component").select(F.col("node").alias("fp"), "least")
    return written(nodes.join(linked, "fp", "left").select("fp", "n", F.coalesce("least", "first").alias("least")))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def groups_of_documents(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs.select("doc_id", "text")).select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """One row of each component, all its columns kept: that of its smallest doc_id, of repeated ids that of the smallest text hash, of equal rows any one. Rows without a doc_id stay."""
    hashed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    rows = checkpointed(fingerprints(hashed, "text", ("doc_id", "h")).select("fp", F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "h")).alias("at")))
    stay = least_of_components(rows, "at").select(F.col("least.doc_id").alias("doc_id"), F.col("least.h").alias("__h")).distinct()
    kept = docs.withColumn("__h", F.xxhash64("text")).join(not_broadcast(stay), ["doc_id", "__h"], "left_semi").dropDuplicates(["doc_id", "__h"])
    return kept.select(docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
