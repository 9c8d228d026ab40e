"""Word kernels over Arrow string buffers: numpy on whole batches of texts, no Python object per word.

A *word* is a maximal run of bytes outside a separator table.  Separators are ASCII, so
cutting the UTF-8 bytes is the same as cutting the characters.  Hashes are 64 bits wide:
equal words always hash equally, and different ones collide with a chance of about 2**-64.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# white space: space, tab, line feed, vertical tab, form feed, carriage return
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# everything in ASCII but digits and lower-case letters
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

CHUNK = 1 << 17  # bytes hashed at a time; bounds the temporary arrays, never the text
PIECE_BYTES = 1 << 20  # text read at a time; a word takes some 30 times its bytes in arrays
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_U = np.uint64


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _inverse(base: np.uint64) -> np.uint64:
    return _U(pow(int(base), -1, 1 << 64))


_POWERS = _powers(_BASE, CHUNK + 1)
_INVERSES = _powers(_inverse(_BASE), CHUNK + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of ``x`` over all 64 (the finalizer of splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offset of each text (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


class Words(NamedTuple):
    """Words of a batch of texts in order: byte span, hash, and the first word of each text."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # length texts + 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def find_words(raw: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACE) -> Words:
    """Byte spans and hashes of all words of all texts; no word crosses a text border."""
    return find_tokens(raw, offsets, (~separators).astype(np.uint8))


def find_tokens(raw: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> Words:
    """Maximal runs of bytes of one kind other than 0, such as letters or punctuation."""
    n = len(raw)
    if n == 0:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    kind = kinds[raw]
    change = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    change[offsets] = True
    inside = kind > 0
    start, end = np.flatnonzero(change[:-1] & inside), np.flatnonzero(change[1:] & inside) + 1
    return Words(start, end, hash_spans(raw, start, end), np.searchsorted(start, offsets))


def hash_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte span; spans must be in order and must not overlap."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        base = start[at]
        stop = max(at + 1, int(np.searchsorted(end, base + CHUNK, "right")))
        if end[stop - 1] - base > CHUNK:  # one word longer than a chunk
            out[at] = _long_hash(raw[start[at] : end[at]])
            at += 1
            continue
        s, e = start[at:stop] - base, end[at:stop] - base
        width = int(e[-1])
        sums = np.zeros(width + 1, np.uint64)
        np.cumsum((raw[base : base + width].astype(np.uint64) + _U(1)) * _POWERS[:width], out=sums[1:])
        out[at:stop] = mix((sums[e] - sums[s]) * _INVERSES[s])
        at = stop
    return out


def _long_hash(word: np.ndarray) -> np.uint64:
    total, scale = _U(0), _U(1)
    with np.errstate(over="ignore"):
        for i in range(0, len(word), CHUNK):
            part = word[i : i + CHUNK].astype(np.uint64) + _U(1)
            total += scale * np.sum(part * _POWERS[: len(part)], dtype=np.uint64)
            scale *= _POWERS[CHUNK]
    return mix(np.array([total]))[0]


def window_hash(words: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words; position i covers words i .. i+width-1."""
    n = max(0, len(words) - width + 1)
    out = np.zeros(n, np.uint64)
    for j in range(width):
        out *= _U(0xD6E8FEB86659FD93)
        out += words[j : j + n] ^ _U(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return mix(out)


def window_starts(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a run of ``width`` words lies in one text, and the text of each."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[:-1][owner] + inner, owner


def batches(offsets: np.ndarray, size: int = PIECE_BYTES):
    """Ranges of consecutive texts of at most ``size`` bytes together (a longer text stands alone)."""
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, min(stop, n)
        at = min(stop, n)


class Ranges:
    """Hashes of arbitrary runs of words from one running sum; equal runs hash equally wherever they stand."""

    STEP = _U(0xC2B2AE3D27D4EB4F)
    _tables = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __init__(self, hashes: np.ndarray, seed: int = 0):
        n = len(hashes)
        if len(Ranges._tables[0]) <= n:
            Ranges._tables = _powers(self.STEP, n + 1), _powers(_inverse(self.STEP), n + 1)
        self.powers, self.inverses = Ranges._tables
        own = mix(hashes ^ _U(seed)) if seed else hashes
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(own * self.powers[:n], out=self.sums[1:])

    def plain(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Polynomial of the words a .. b-1; still to be mixed."""
        return (self.sums[b] - self.sums[a]) * self.inverses[a]

    def join(self, a: np.ndarray, i: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Polynomial of the words a .. b-1 without word i."""
        return self.plain(a, i) + self.powers[i - a] * self.plain(i + 1, b)
