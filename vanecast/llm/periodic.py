"""Periodic runs of words in each text, and texts without their repetitions.

Enhanced suffix array and branching-tandem test.  The words of a batch of texts, each word
told apart by its text, are sorted into one suffix array by prefix doubling, so no window of
two texts is ever equal.  For each LCP interval of depth d, every suffix i outside the
largest child is tested for ``ISA[i + d]`` and ``ISA[i - d]`` in the same interval: such a pair
shares d words and then parts, which is a square of period d that cannot move to the right.
Every run ends in exactly one such square.  The square is rotated to the left as far as the
words agree, by the ranks of the doubling rounds, and equal stretches merge into the run of
the smallest period.  Intervals are numpy arrays of bounds; no tree is built.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.llm.kernels import batches, find_words, text_bytes

BATCH_BYTES = 1 << 20  # texts sorted together; a longer text is sorted alone and whole
CHUNK = 1 << 21  # suffixes tested at a time
WORK = 16  # steps of pointer jumping per place before the plain stack takes over
ROUND = 64  # steps that a round counts for besides its places


class Suffixes(NamedTuple):
    """Suffix array of a string of codes, its inverse, neighbours' common prefixes and all ranks by 2**k codes."""

    sa: np.ndarray
    isa: np.ndarray
    lcp: np.ndarray  # lcp[k] of sa[k - 1] and sa[k]; -1 at 0
    ranks: list[np.ndarray]  # one code longer than the string: an end that equals nothing


def _ended(rank: np.ndarray) -> np.ndarray:
    return np.append(rank, -1).astype(np.int32)


def sort_suffixes(codes: np.ndarray) -> Suffixes:
    """Prefix doubling; each round sorts only the suffixes that are not alone yet."""
    n = len(codes)
    sa = np.argsort(codes, kind="stable")
    new = np.ones(n, bool)
    new[1:] = codes[sa[1:]] != codes[sa[:-1]]
    parted = np.where(new, -1, 0)  # the last k at which sa[k - 1] and sa[k] still agree in 2**k codes
    start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = start
    ranks, step, level = [_ended(rank)], 1, 0
    while True:
        # places in groups of two and more
        open_ = ~new
        open_[:-1] |= ~new[1:]
        places = np.flatnonzero(open_)
        if not len(places):
            break
        here = sa[places]
        after = here + step
        key = (rank[here] << 32) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        key = key[order]
        sa[places] = here[order]
        differs = np.ones(len(places), bool)
        differs[1:] = key[1:] != key[:-1]
        new[places] = differs
        start = np.maximum.accumulate(np.where(differs, places, 0))
        rank = rank.copy()
        rank[sa[places]] = start
        step, level = 2 * step, level + 1
        parted[places[~differs]] = level
        ranks.append(_ended(rank))
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    for k in range(level, -1, -1):  # the highest power each pair agrees in first, then the rest of the bits
        at = np.flatnonzero(parted >= k)
        a, b = sa[at - 1] + lcp[at], sa[at] + lcp[at]
        lcp[at] += (ranks[k][a] == ranks[k][b]).astype(np.int64) << k
    if n:
        lcp[0] = -1
    return Suffixes(sa, isa, lcp, ranks)


def _stack_before(values: np.ndarray) -> np.ndarray:
    out, stack, low = [], [], values.tolist()
    for k, v in enumerate(low):
        while stack and low[stack[-1]] >= v:
            stack.pop()
        out.append(stack[-1] if stack else -1)
        stack.append(k)
    return np.array(out, np.int64)


def smaller_before(values: np.ndarray) -> np.ndarray:
    """The nearest place before each positive value at which the value is smaller, -1 without any."""
    found = np.arange(len(values)) - 1
    active, work = np.flatnonzero(values > 0), 0
    while work < WORK * len(values):
        active = active[found[active] >= 0]
        active = active[values[found[active]] >= values[active]]
        if not len(active):
            return found
        found[active] = found[found[active]]
        work += len(active) + ROUND
    return _stack_before(values)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers start[i] .. start[i] + size[i] - 1 in turn."""
    before = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat(start - before, size)


def _common_before(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many codes agree right before a and before b."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        step = 1 << k
        i, j = a - length - step, b - length - step
        fits = i >= 0
        length += np.where(fits & (ranks[k][np.where(fits, i, 0)] == ranks[k][np.where(fits, j, 0)]) & (i != j), step, 0)
    return length


def find_runs(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs of at least ``least`` codes and two periods, by start, then period."""
    none = np.zeros(0, np.int64)
    n = len(codes)
    if n < 2:
        return none, none, none
    sa, isa, lcp, ranks = sort_suffixes(codes)
    first = ranks[0]
    left = smaller_before(lcp)
    right = n - 1 - smaller_before(lcp[::-1])[::-1]  # first place after with a smaller value
    inner = np.flatnonzero(lcp > 0)
    if not len(inner):
        return none, none, none
    # places of one interval side by side; each begins a child, one more begins at the left bound
    order = np.argsort(left[inner] * (n + 1) + right[inner], kind="stable")
    at = inner[order]
    lo, hi = left[at], right[at]
    head = np.ones(len(at), bool)
    head[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    tail = np.append(head[1:], True)
    interval = np.cumsum(head) - 1
    begin = np.concatenate([lo[head], at])
    end = np.concatenate([at[head], np.where(tail, hi, np.append(at[1:], 0))])
    which = np.concatenate([np.arange(interval[-1] + 1), interval])
    size = end - begin
    by_size = np.lexsort((-size, which))
    largest = np.ones(len(by_size), bool)
    largest[1:] = which[by_size][1:] != which[by_size][:-1]
    small = by_size[~largest]
    low, high, depth = lo[head], hi[head], lcp[at[head]]
    squares = []
    cuts = np.searchsorted(np.cumsum(size[small]), np.arange(0, size[small].sum(), CHUNK), "left")
    for a, b in zip(cuts, [*cuts[1:], len(small)], strict=True):
        part = small[a:b]
        i = sa[_ranges(begin[part], size[part])]
        own = np.repeat(which[part], size[part])
        d, l, h = depth[own], low[own], high[own]
        for j, other in ((i, i + d), (i - d, i - d)):  # the square starts at j; the other half's suffix is looked up
            inside = (other >= 0) & (other < n)
            place = isa[np.where(inside, other, 0)]
            inside &= (place >= l) & (place < h)
            j_in, d_in = j[inside], d[inside]
            branching = first[j_in + d_in] != first[np.minimum(j_in + 2 * d_in, n)]
            squares.append(np.stack([j_in[branching], d_in[branching]]))
    j, period = np.concatenate(squares, axis=1)
    start = j - _common_before(ranks, j, j + period)
    length = j + 2 * period - start
    keep = length >= np.maximum(least, 2 * period)
    start, length, period = start[keep], length[keep], period[keep]
    # one stretch found with several periods is the run of the smallest
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    lead = np.ones(len(start), bool)
    lead[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[lead], length[lead], period[lead]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def text_runs(raw: np.ndarray, offsets: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(words, start, length, period) of each text in turn."""
    words = find_words(raw, offsets)
    _, code = np.unique(words.hash, return_inverse=True)
    # equal words of different texts are different codes
    start, length, period = find_runs((words.owner() << 32) + code, least)
    bounds = np.searchsorted(start, words.first)
    for k, n in enumerate(words.counts.tolist()):
        part = slice(bounds[k], bounds[k + 1])
        yield n, start[part] - words.first[k], length[part], period[part]


def kept_words(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words no run repeats: all but those after the first period of a run."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, start + period, 1)
    np.subtract.at(edge, start + length, 1)
    return np.cumsum(edge[:-1]) == 0


def periodic_runs(docs: DataFrame, least: int = 12, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``runs`` and ``collapsed``.

    ``runs`` are (start, length, period) in words from 0, by start, then period: maximal
    stretches of at least ``least`` words and two periods with that smallest period.
    ``collapsed`` joins by one space the words that no run holds after its first period.
    Words are runs of non-space characters, unchanged.  Missing and empty texts have no
    words, no runs and an empty text; of runs that overlap, all are returned.  Repeated rows
    stay repeated and missing ids missing; other columns are not read.
    """
    schema = "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def scan(stream):
        for batch in stream:
            column = batch.column(1)
            raw, offsets = text_bytes(column)
            counts, runs, texts = [], [], []
            for a, b in batches(offsets, BATCH_BYTES):
                part = raw[offsets[a] : offsets[b]]
                found = text_runs(part, offsets[a : b + 1] - offsets[a], least)
                for k, (n, start, length, period) in enumerate(found, a):
                    words = raw[offsets[k] : offsets[k + 1]].tobytes().split()
                    if len(start):
                        words = compress(words, kept_words(n, start, length, period))
                    counts.append(n)
                    runs.append([{"start": s, "length": e, "period": q} for s, e, q in zip(start.tolist(), length.tolist(), period.tolist(), strict=True)])
                    texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(texts, pa.string())],
                names=["id", "n_words", "runs", "collapsed"],
            )

    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    return plain.mapInArrow(scan, schema).withColumnRenamed("id", id_column)
