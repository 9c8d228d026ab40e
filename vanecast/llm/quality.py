"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network in numpy.

Random indexing gives every word a sparse ternary index vector, drawn from its hash, and adds
up the index vectors of the words around each of its occurrences in the whole corpus.  Words
are hashed to a fixed number of rows, so partition sums have one size whatever the corpus,
are merged by row range, and the merged table has a bound that lets it go to every task.
A document is pooled to the mean and spread of its words' vectors and a few shape figures; a
network with one hidden layer is trained on a bounded sample of labelled rows, and its
logits are divided by a temperature fitted on rows it was not trained on.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.llm.kernels import Words, batches, find_tokens, mix, text_bytes

ROWS = 1 << 14  # word rows of the table
WIDTH = 32  # length of a vector: ROWS * WIDTH * 4 bytes = 2 MB go to every task
SLICES = 64
REACH = 2  # words on either side that count as context
ENTRIES = 2  # non-zero entries of an index vector
COUNT_BYTES = 2 << 20  # text whose contexts are counted at once
POOL_BYTES = 1 << 17  # text pooled at once: each token takes a vector, so the arrays are a hundred times as large

# letters and digits are one kind of token, other visible bytes another; case is kept
KINDS = np.full(256, 2, np.uint8)
KINDS[[*range(0x00, 0x21), 0x7F]] = 0
KINDS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1


def _tokens(column, size: int):
    raw, offsets = text_bytes(column)
    for a, b in batches(offsets, size):
        yield a, b, find_tokens(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], KINDS)


def _rows(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(ROWS)).astype(np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the non-zero entries of every row's index vector."""
    bits = mix(np.arange(ROWS * ENTRIES, dtype=np.uint64) + np.uint64(1)).reshape(ROWS, ENTRIES)
    return (bits % np.uint64(WIDTH)).astype(np.int64), np.where(bits >> np.uint64(63), 1.0, -1.0)


def word_table(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Context vectors of all words of all texts (ROWS x WIDTH, unit length or zero)."""

    def add_up(stream):
        place, sign = index_vectors()
        total = np.zeros(ROWS * WIDTH)
        for batch in stream:
            for _, _, words in _tokens(batch.column(0), COUNT_BYTES):
                row, owner = _rows(words.hash), words.owner()
                for step in range(1, REACH + 1):
                    near = owner[step:] == owner[:-step]
                    left, right = row[:-step][near], row[step:][near]
                    for k in range(ENTRIES):
                        total += np.bincount(left * WIDTH + place[right, k], sign[right, k], ROWS * WIDTH)
                        total += np.bincount(right * WIDTH + place[left, k], sign[left, k], ROWS * WIDTH)
        parts = total.astype("<i8").reshape(SLICES, -1)
        if parts.any():
            used = [i for i in range(SLICES) if parts[i].any()]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([_small(parts[i]) for i in used], pa.binary())], names=["slice", "sums"])

    def merge(part: pa.Table) -> pa.Table:
        sums = sum(_wide(x.as_py()) for x in part.column("sums"))
        return pa.table({"slice": part.column("slice")[:1], "sums": pa.array([sums.astype("<i8").tobytes()], pa.binary())})

    parts = docs.select(F.col(text_column).alias("text")).mapInArrow(add_up, "slice long, sums binary")
    merged = parts.groupBy("slice").applyInArrow(merge, "slice long, sums binary").toArrow()
    table = np.zeros((SLICES, ROWS * WIDTH // SLICES))
    for i, sums in zip(merged.column("slice").to_pylist(), merged.column("sums").to_pylist(), strict=True):
        table[i] = np.frombuffer(sums, "<i8")
    table = table.reshape(ROWS, WIDTH)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return np.divide(table, norm, out=np.zeros_like(table), where=norm > 0).astype(np.float32)


def _small(sums: np.ndarray) -> bytes:
    """Sums in the narrowest integer type that holds them."""
    for kind in ("<i1", "<i2", "<i4", "<i8"):
        if np.abs(sums).max() <= np.iinfo(kind).max:
            return kind[1:].encode() + sums.astype(kind).tobytes()
    raise OverflowError


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<" + data[:2].decode(), offset=2).astype(np.int64)


def pooled(words: Words, table: np.ndarray) -> np.ndarray:
    """Per text: mean and spread of its words' vectors, length, repetition, share of signs."""
    n = len(words.first) - 1
    out = np.zeros((n, 2 * WIDTH + 5), np.float32)
    counts = words.counts
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    row, size, first = _rows(words.hash), counts[full, None], words.first[:-1][full]
    vectors = table[row]
    mean = np.add.reduceat(vectors, first, axis=0, dtype=np.float64) / size
    square = np.add.reduceat(np.square(vectors, out=vectors), first, axis=0, dtype=np.float64) / size
    out[full, :WIDTH] = mean
    out[full, WIDTH : 2 * WIDTH] = np.sqrt(np.maximum(square - mean**2, 0))
    again = np.zeros(len(row), bool)
    again[1:] = words.hash[1:] == words.hash[:-1]
    again[first] = False
    length = words.end - words.start
    sums = np.add.reduceat(np.column_stack([again, length, length > 20]).astype(float), first, axis=0) / size
    out[full, 2 * WIDTH] = np.log1p(counts[full])
    out[full, 2 * WIDTH + 1 : 2 * WIDTH + 4] = sums
    out[full, 2 * WIDTH + 4] = np.linalg.norm(mean, axis=1)
    return out


class Network(NamedTuple):
    """Standardisation, two layers, temperature."""

    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.centre) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def constant_network(width: int, share: float) -> Network:
    """Scores every row with the share of positive labels."""
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))), 1.0)


def train_network(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, rate: float = 0.01, ridge: float = 1e-4, seed: int = 7) -> Network:
    """Two layers by Adam on mini-batches; a fifth of the rows fits only the temperature."""
    if len(set(y.tolist())) < 2 or len(y) < 10:
        return constant_network(x.shape[1], float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    aside, own = order[: len(y) // 5], order[len(y) // 5 :]
    centre, scale = x[own].mean(0), x[own].std(0) + 1e-3
    z = (x - centre) / scale
    share = np.clip(y[own].mean(), 0.01, 0.99)
    weights = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), np.zeros(hidden), np.array(np.log(share / (1 - share)))]
    mean, square, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    size = max(16, min(256, len(own) // 20))
    for epoch in range(epochs):
        rng.shuffle(own)
        pace = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
        for at in range(0, len(own), size):
            rows, step = own[at : at + size], step + 1
            h = np.tanh(z[rows] @ weights[0] + weights[1])
            slope = (1 / (1 + np.exp(-np.clip(h @ weights[2] + weights[3], -30, 30))) - y[rows]) / len(rows)
            back = slope[:, None] * weights[2] * (1 - h**2)
            grads = [z[rows].T @ back + ridge * weights[0], back.sum(0), h.T @ slope + ridge * weights[2], slope.sum()]
            for i, g in enumerate(grads):
                mean[i] = 0.9 * mean[i] + 0.1 * g
                square[i] = 0.999 * square[i] + 0.001 * g**2
                weights[i] = weights[i] - pace * mean[i] / (1 - 0.9**step) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(centre, scale, weights[0], weights[1], weights[2], float(weights[3]), 1.0)
    return net._replace(temperature=fit_temperature(net.logits(x[aside]), y[aside]))


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the smallest log loss on rows set aside (a grid, then a finer one)."""
    if len(y) < 2:
        return 1.0

    def loss(t: float) -> float:
        z = logits / t
        return float(np.mean(np.logaddexp(0, z) - y * z))

    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 41))
    best = min(grid, key=loss)
    return float(min(best * np.exp(np.linspace(-0.1, 0.1, 41)), key=loss))


class Quality(NamedTuple):
    table: np.ndarray
    network: Network


def _pool_stream(stream, table: np.ndarray, keep: int):
    """(kept columns, pooled vectors) per batch; the text comes last."""
    for batch in stream:
        out = np.zeros((batch.num_rows, 2 * WIDTH + 5), np.float32)
        for a, b, words in _tokens(batch.column(keep), POOL_BYTES):
            out[a:b] = pooled(words, table)
        yield batch.columns[:keep], out


def fit_quality(docs: DataFrame, labelled: DataFrame, sample_rows: int = 20_000, id_column: str = "doc_id", text_column: str = "text") -> Quality:
    """Word vectors from every text of ``docs``; the network from at most about ``sample_rows``
    rows of ``labelled`` (id, text, quality 0 or 1), drawn by a hash.

    Rows without a label are left out.  With one label only, or fewer than ten rows, every
    score is the share of good rows (0.5 without rows).
    """
    table = word_table(docs, text_column)
    known = labelled.filter(F.col("quality").isin(0, 1))
    n = known.count()
    draw = F.pmod(F.xxhash64(F.lit("quality"), F.col(id_column)), F.lit(1_000_000)) / 1_000_000
    sample = known.filter(draw < min(1.0, sample_rows / max(n, 1))).select(F.col("quality").cast("double").alias("y"), F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    spread = docs.sparkSession.sparkContext.broadcast(table)

    def pool(stream):
        for columns, x in _pool_stream(stream, spread.value, 2):
            yield pa.RecordBatch.from_arrays([*columns, pa.array([v.tobytes() for v in x], pa.binary())], names=["y", "id", "x"])

    rows = sample.mapInArrow(pool, "y double, id long, x binary").toArrow().sort_by([("id", "ascending"), ("y", "ascending")])
    y = rows.column("y").to_numpy()
    x = np.array([np.frombuffer(v, np.float32) for v in rows.column("x").to_pylist()], float).reshape(len(y), 2 * WIDTH + 5)
    return Quality(table, train_network(x, y) if len(y) else constant_network(2 * WIDTH + 5, 0.5))


def score_quality(docs: DataFrame, model: Quality, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id and ``score``, the calibrated probability of good quality.

    Whole texts are read.  Missing and empty texts pool to zeros and get the network's score
    for them.  Repeated rows stay repeated, missing ids stay missing, other columns are not read.
    """
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(stream):
        table, network = spread.value
        for columns, x in _pool_stream(stream, table, 1):
            yield pa.RecordBatch.from_arrays([*columns, pa.array(network.score(x.astype(float)))], names=["id", "score"])

    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return plain.mapInArrow(run, "id long, score double").withColumnRenamed("id", id_column)


def keep_quality(docs: DataFrame, model: Quality, least: float = 0.7, text_column: str = "text") -> DataFrame:
    """Rows of ``docs`` with a score of ``least`` or more, all columns as they are."""
    spread = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_column)

    def run(stream):
        table, network = spread.value
        for batch in stream:
            x = np.zeros((batch.num_rows, 2 * WIDTH + 5), np.float32)
            for a, b, words in _tokens(batch.column(at), POOL_BYTES):
                x[a:b] = pooled(words, table)
            yield batch.filter(pa.array(network.score(x.astype(float)) >= least))

    return docs.mapInArrow(run, docs.schema)
