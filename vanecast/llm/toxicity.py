"""Toxic spans with a linear-chain conditional random field.

Token labels: a word of a toxic training document is labelled toxic if it stands in
significantly more contexts (neighbouring words) of toxic than of clean documents - one-sided
binomial test, corrected for the number of words tested.  Contexts instead of documents are
counted, so copies of one document do not turn all its words into signs.  A two-state chain
over the words of each line is then fitted by maximum likelihood to these token labels, with
the log-odds of a word and of its neighbours as features; long lines are several chains.  Forward-backward gives each word
its marginal; a document's score is a calibrated function of their sum and maximum, and
runs of words with a marginal of at least one half are the offending spans.

Fitting uses a bounded sample of labelled rows; scoring reads every whole text.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanecast.llm.kernels import LOWER, NOT_ALNUM, Words, batches, find_words, mix, text_bytes

LINE_FEED = 0x0A
CLIP = 30.0
CHAIN = 256  # words that share a chain at most


class Toxicity(NamedTuple):
    """Lexicon (sorted word hashes, their log-odds), chain weights, calibration."""

    words: np.ndarray
    odds: np.ndarray
    chain: np.ndarray  # bias, own, previous, next, transitions 0->1, 1->0, 1->1
    calibration: np.ndarray  # intercept, log(1 + sum of marginals), logit of the largest


# -- chains --------------------------------------------------------------------------


class Chains(NamedTuple):
    """First word and length of each chain, the longest first."""

    start: np.ndarray
    length: np.ndarray


def lines_of(raw: np.ndarray, offsets: np.ndarray, words: Words) -> Chains:
    """A chain runs over the words of one line of one text; a line of more than CHAIN words is several."""
    feeds = np.flatnonzero(raw == LINE_FEED)
    first = np.unique(np.concatenate([words.first[:-1], np.searchsorted(words.start, feeds)]))
    first = first[first < len(words.start)]
    length = np.diff(first, append=len(words.start))
    pieces = -(-length // CHAIN)
    inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(first, pieces) + inner * CHAIN
    length = np.diff(first, append=len(words.start))
    order = np.argsort(-length, kind="stable")
    return Chains(first[order], length[order])


def features(words: Words, chains: Chains, lexicon: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """Log-odds of each word, of the one before and the one after it in its line."""
    out = np.zeros((3, len(words.hash)))
    if len(lexicon) and len(words.hash):
        at = np.minimum(np.searchsorted(lexicon, words.hash), len(lexicon) - 1)
        out[0] = np.where(lexicon[at] == words.hash, odds[at], 0.0)
        out[1, 1:] = out[0, :-1]
        out[2, :-1] = out[0, 1:]
        out[1, chains.start] = 0.0
        out[2, chains.start + chains.length - 1] = 0.0
    return out


def forward_backward(gain: np.ndarray, chains: Chains, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Filtered P(1), backward share of state 1, and marginal P(1) per word.

    ``gain`` is exp(score of state 1 - score of state 0); ``move[i, j]`` weighs i -> j.
    All lines advance together, one word per step.
    """
    n = len(gain)
    ahead, behind = np.zeros(n), np.full(n, 0.5)
    if not n:
        return ahead, behind, ahead
    steps = int(chains.length[0])
    active = np.searchsorted(-chains.length, -np.arange(steps), "left")  # lines longer than t
    at = chains.start
    ahead[at] = gain[at] / (1.0 + gain[at])
    for t in range(1, steps):
        at = chains.start[: active[t]] + t
        a = ahead[at - 1]
        one = gain[at] * (a * move[1, 1] + (1 - a) * move[0, 1])
        ahead[at] = one / (one + a * move[1, 0] + (1 - a) * move[0, 0])
    for t in range(steps - 2, -1, -1):
        at = chains.start[: active[t + 1]] + t
        b = behind[at + 1]
        on = gain[at + 1] * b
        one = move[1, 1] * on + move[1, 0] * (1 - b)
        behind[at] = one / (one + move[0, 1] * on + move[0, 0] * (1 - b))
    top = ahead * behind
    return ahead, behind, top / (top + (1 - ahead) * (1 - behind))


def _weights(chain: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gain = np.exp(np.clip(chain[0] + chain[1] * x[0] + chain[2] * x[1] + chain[3] * x[2], -CLIP, CLIP))
    return gain, np.exp(np.array([[0.0, chain[4]], [chain[5], chain[6]]]))


def fit_chain(x: np.ndarray, y: np.ndarray, chains: Chains, rounds: int = 80, rate: float = 0.25, ridge: float = 1e-3) -> np.ndarray:
    """Maximum likelihood by Adam; the gradient is observed minus expected feature counts."""
    theta = np.array([-4.0, 1.0, 0.0, 0.0, -1.0, 0.0, 0.0])
    mean, square = np.zeros(7), np.zeros(7)
    inner = np.ones(len(y), bool)
    inner[chains.start] = False  # words with one before them in the line
    at = np.flatnonzero(inner)
    before, here = y[at - 1], y[at]
    seen = np.array([((1 - before) * here).sum(), (before * (1 - here)).sum(), (before * here).sum()])
    for k in range(1, rounds + 1):
        gain, move = _weights(theta, x)
        ahead, behind, p = forward_backward(gain, chains, move)
        a, b, g = ahead[at - 1], behind[at], gain[at]
        pair = np.stack([(1 - a) * move[0, 0] * (1 - b), (1 - a) * move[0, 1] * g * b, a * move[1, 0] * (1 - b), a * move[1, 1] * g * b])
        pair /= pair.sum(0)
        rest = y - p
        slope = np.array([rest.sum(), (x[0] * rest).sum(), (x[1] * rest).sum(), (x[2] * rest).sum(), *(seen - pair[1:].sum(1))])
        slope = slope / max(len(y), 1) - ridge * theta / max(len(y), 1)
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        theta = theta + rate * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.999**k)) + 1e-8)
    return theta


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method, with an intercept in front."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -CLIP, CLIP)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return w


# -- documents -----------------------------------------------------------------------


def _tagged(column, model: Toxicity):
    """Per sub-batch of texts: first row, bytes, offsets, words and their marginals."""
    raw, offsets = text_bytes(column)
    for a, b in batches(offsets):
        low, own = LOWER[raw[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
        words = find_words(low, own, NOT_ALNUM)
        chains = lines_of(low, own, words)
        gain, move = _weights(model.chain, features(words, chains, model.words, model.odds))
        yield a, b, low, own, words, forward_backward(gain, chains, move)[2]


def _summary(words: Words, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and maximum of the marginals of each text."""
    n = len(words.first) - 1
    sums = np.concatenate([[0.0], np.cumsum(p)])
    total = sums[words.first[1:]] - sums[words.first[:-1]]
    most = np.zeros(n)
    full = np.flatnonzero(words.counts)
    if len(full):
        most[full] = np.maximum.reduceat(p, words.first[:-1][full])
    return np.maximum(total, 0.0), most


def _signals(total: np.ndarray, most: np.ndarray) -> np.ndarray:
    most = np.clip(most, 1e-6, 1 - 1e-6)
    return np.column_stack([np.log1p(total), np.log(most / (1 - most))])


def _contexts(toxic_docs: DataFrame) -> DataFrame:
    """Distinct (word, neighbours) of labelled texts with the label."""

    def contexts(stream):
        for batch in stream:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            raw, offsets = text_bytes(batch.column(1))
            for a, b in batches(offsets):
                words = find_words(LOWER[raw[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a], NOT_ALNUM)
                h = words.hash
                if not len(h):
                    continue
                before, after = np.roll(h, 1), np.roll(h, -1)
                full = words.first[:-1][words.counts > 0]
                before[full] = 0
                after[np.append(full[1:], len(h)) - 1] = 0
                around = mix(before * np.uint64(3) + mix(after))
                rows = np.unique(np.rec.fromarrays([h, around, label[a:b][words.owner()]], names="w,c,y"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["w"].view(np.int64)), pa.array(rows["c"].view(np.int64)), pa.array(rows["y"].astype(np.int64))], names=["word", "context", "toxic"]
                )

    return toxic_docs.select("toxic", "text").mapInArrow(contexts, "word long, context long, toxic long")


def _log_tail(hits: np.ndarray, total: np.ndarray, share: float) -> np.ndarray:
    """Chernoff bound on log P(Binomial(total, share) >= hits), 0 where hits is not above the mean."""
    q = hits / total
    with np.errstate(divide="ignore", invalid="ignore"):
        rest = np.where(q < 1, (1 - q) * np.log((1 - q) / (1 - share)), 0.0)
        bound = -total * (q * np.log(q / share) + rest)
    return np.where(q > share, bound, 0.0)


def fit_toxicity(labelled: DataFrame, sample_rows: int = 16_000, chain_rows: int = 2_000, id_column: str = "doc_id") -> Toxicity:
    """Fit on at most about ``sample_rows`` rows of ``labelled`` (id, text, toxic 0 or 1), drawn by a hash.

    The chain itself is fitted on about ``chain_rows`` of them, toxic and clean ones in equal
    parts.  Rows without a label are left out.  Without rows of both labels the lexicon is
    empty and every score is the share of toxic rows (0.0 without rows).
    """
    known = labelled.filter(F.col("toxic").isin(0, 1)).select(F.col(id_column).alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("toxic").cast("long").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    clean, bad = sizes.get(0, 0), sizes.get(1, 0)
    none = np.zeros(0, np.uint64)
    if not clean or not bad:
        share = bad / max(clean + bad, 1)
        sure = math.log(min(max(share, 1e-6), 1 - 1e-6) / (1 - min(max(share, 1e-6), 1 - 1e-6)))
        return Toxicity(none, np.zeros(0), np.array([-CLIP, 0, 0, 0, 0, 0, 0.0]), np.array([sure, 0.0, 0.0]))
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "id"), F.lit(1_000_000)) / 1_000_000
    sample = known.filter(draw < min(1.0, sample_rows / (clean + bad))).persist()
    counts = _contexts(sample).distinct().groupBy("word").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    total = counts.agg(F.sum("bad"), F.sum("n"), F.count("*")).first()
    share = min(max(total[0] / total[1], 1e-9), 1 - 1e-9)
    # signs of toxicity only; few words reach three contexts with such a share
    rows = counts.filter((F.col("bad") >= 3) & (F.col("bad") > F.col("n") * (2 * share / (1 + share)))).toPandas()
    hits, n = rows["bad"].to_numpy(float), rows["n"].to_numpy(float)
    keep = _log_tail(hits, n, share) < -math.log(max(total[2], 2)) - 1.0 if len(rows) else np.zeros(0, bool)
    words = rows["word"].to_numpy(np.int64).view(np.uint64)[keep] if len(rows) else none
    odds = np.log((hits[keep] + 0.5) / (total[0] + 1)) - np.log((n[keep] - hits[keep] + 0.5) / (total[1] - total[0] + 1)) if len(rows) else np.zeros(0)
    order = np.argsort(words)
    words, odds = words[order], odds[order]
    drawn = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    rate = [min(1.0, chain_rows / 2 / max(drawn.get(k, 0), 1)) for k in (0, 1)]
    again = F.pmod(F.xxhash64(F.lit("chain"), "id"), F.lit(1_000_000)) / 1_000_000
    half = sample.filter(again < F.when(F.col("toxic") == 1, rate[1]).otherwise(rate[0])).select("toxic", "text").toArrow()
    sample.unpersist()
    return _fit(half, words, odds, bad / (clean + bad), rate[1] * drawn.get(1, 0) / max(rate[0] * drawn.get(0, 0), 1e-9))


def _fit(rows: pa.Table, lexicon: np.ndarray, odds: np.ndarray, share: float, drawn: float) -> Toxicity:
    """Chain and calibration from a table (toxic, text); ``drawn``: toxic rows per clean row in it."""
    label = rows.column("toxic").to_numpy()
    raw, offsets = text_bytes(rows.column("text"))
    low = LOWER[raw]
    words = find_words(low, offsets, NOT_ALNUM)
    chains = lines_of(low, offsets, words)
    x = features(words, chains, lexicon, odds)
    y = ((x[0] > 0) & (label[words.owner()] == 1)).astype(float)
    chain = fit_chain(x, y, chains)
    gain, move = _weights(chain, x)
    signals = _signals(*_summary(words, forward_backward(gain, chains, move)[2]))
    calibration = fit_logistic(signals, label.astype(float)) if len(set(label.tolist())) == 2 else np.zeros(3)
    # the sample holds more toxic rows than the corpus; the intercept takes that back
    calibration[0] += math.log(share / (1 - share)) - math.log(max(drawn, 1e-9))
    return Toxicity(lexicon, odds, chain, calibration)


def score_toxicity(docs: DataFrame, model: Toxicity, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document: id, ``score`` and ``spans`` (first and last character + 1, largest marginal).

    Words are runs of letters and digits of the lower-cased text, chains run over lines.
    Missing and empty texts have no words: their score is that of a text without any sign.
    Repeated rows stay repeated, missing ids stay missing, other columns are not read.
    """
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])

    def run(stream):
        for batch in stream:
            score, spans = np.zeros(batch.num_rows), [[] for _ in range(batch.num_rows)]
            for a, b, low, own, words, p in _tagged(batch.column(1), model):
                total, most = _summary(words, p)
                score[a:b] = 1 / (1 + np.exp(-np.clip(model.calibration[0] + _signals(total, most) @ model.calibration[1:], -CLIP, CLIP)))
                hits = np.flatnonzero(p >= 0.5)
                rows = np.searchsorted(words.first, hits, "right") - 1
                row, last = -1, -2
                for w, i in zip(hits.tolist(), rows.tolist(), strict=True):
                    mine = spans[a + i]
                    s, e = (int(x) - int(own[i]) for x in (words.start[w], words.end[w]))
                    if mine and row == i and w == last + 1:
                        mine[-1]["end"], mine[-1]["p"] = e, max(mine[-1]["p"], float(p[w]))
                    else:
                        mine.append({"start": s, "end": e, "p": float(p[w])})
                    row, last = i, w
                for i in set(rows.tolist()):
                    text = low[own[i] : own[i + 1]].tobytes()
                    if not text.isascii():
                        for one in spans[a + i]:
                            one["start"], one["end"] = (len(text[:x].decode(errors="ignore")) for x in (one["start"], one["end"]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(spans, pa.list_(kind))], names=["id", "score", "spans"])

    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return plain.mapInArrow(run, "id long, score double, spans array<struct<start: long, end: long, p: double>>").withColumnRenamed("id", id_column)


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(folds))
