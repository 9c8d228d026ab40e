"""Benchmark decontamination: random-walk embedding, bit-sampling, exact edit verification.

The random-walk (CGK) embedding reads a sequence of words from left to right: at step j it
emits the word under its pointer and moves on or stays by a random bit of (j, word).  Two
sequences a few edits apart are read in step again soon after an edit, so edit distance
becomes Hamming distance between the emitted sequences.  A repeat samples some of the steps;
windows that agree in all sampled words are candidates.  Every position of a document starts
a window; on the benchmark's side a window starts at every word of an item that leaves
enough words to the item's end, so one clean stretch of a leaked passage is enough.  A
window is used only if all words it samples lie inside the item.

Repeats are added until the recall estimated on the items themselves, changed by as many
random edits as the bound allows, reaches the target; unchanged passages are always found.
Candidates are aligned with the item and its exact edit distance in words decides.
"""

from __future__ import annotations

import random
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.llm.kernels import LOWER, NOT_ALNUM, batches, find_words, mix, text_bytes

SHARE = 0.2  # edits allowed per word of an item
TARGET = 0.99  # recall of items with that many edits
STEPS = (16, 8, 4, 2, 1)  # lengths of a walk; an item takes the longest within its words
SAMPLED = 6  # steps that a repeat samples from a walk, all of a shorter one
MAX_REPEATS = 12
CHUNK_KEYS = 1_000_000  # index entries that go to every task at once: 24 MB
FILTER_BITS = 20
_U = np.uint64


class Item(NamedTuple):
    id: int
    words: np.ndarray

    @property
    def bound(self) -> int:
        return int(len(self.words) * SHARE)

    @property
    def steps(self) -> int:
        return next((s for s in STEPS if s <= len(self.words)), 1)


def _plan(repeat: int) -> dict[int, set[int]]:
    """The steps a repeat samples from walks of every length, spread over the whole walk."""
    out = {}
    for steps in STEPS:
        rng = random.Random(1000 * repeat + steps)
        borders = [k * steps // SAMPLED for k in range(SAMPLED + 1)]
        out[steps] = {rng.randrange(a, b) for a, b in zip(borders, borders[1:], strict=False) if a < b}
    return out


def walk_keys(hashes: np.ndarray, repeat: int, wanted: set[int]) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """Per length of walk, the key of the window that starts at each word; and the last words read."""
    n, most, plan = len(hashes), max(wanted), _plan(repeat)
    words = np.concatenate([hashes, np.zeros(most, np.uint64)])
    bits = mix(words + _U(0x632BE59BD9B4E019 * (repeat + 1) & (1 << 64) - 1))
    at = np.arange(n)
    last = at
    keys = {s: np.full(n, s, np.uint64) for s in wanted}
    for j in range(most):
        users = [s for s in wanted if j in plan[s]]
        if users:
            word, last = words[at], at
            for s in users:
                keys[s] *= _U(0xD1342543DE82EF95)
                keys[s] += word
        at = at + ((bits[at] >> _U(j)) & _U(1)).astype(np.int64)
    return {s: mix(k) for s, k in keys.items()}, last


class Index(NamedTuple):
    """Windows of the items: per repeat sorted keys with item number and offset, and a bit filter."""

    items: list[Item]
    wanted: set[int]
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _entries(item: Item, repeat: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and offsets of the windows of an item whose sampled words all lie inside it."""
    keys, last = walk_keys(item.words, repeat, {item.steps})
    offsets = np.flatnonzero(last < len(item.words))
    return keys[item.steps][offsets], offsets


def build_index(items: list[Item], repeats: int) -> Index:
    tables = []
    for repeat in range(repeats):
        entries = [_entries(x, repeat) for x in items]
        number = np.repeat(np.arange(len(items)), [len(k) for k, _ in entries])
        key, offset = (np.concatenate(x) for x in zip(*entries, strict=True))
        order = np.argsort(key, kind="stable")
        present = np.zeros(1 << FILTER_BITS, bool)
        present[(key >> _U(64 - FILTER_BITS)).astype(np.int64)] = True
        tables.append((key[order], number[order], offset[order], present))
    return Index(items, {x.steps for x in items}, tables)


def candidates(hashes: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, item number, offset) of all windows that agree with one of an item in some repeat."""
    places, numbers, offsets = [], [], []
    for repeat, (key, number, offset, present) in enumerate(index.tables):
        for keys in walk_keys(hashes, repeat, index.wanted)[0].values():
            at = np.flatnonzero(present[(keys >> _U(64 - FILTER_BITS)).astype(np.int64)])
            low, high = (np.searchsorted(key, keys[at], side) for side in ("left", "right"))
            count = high - low
            inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            hit = np.repeat(low, count) + inner
            places.append(np.repeat(at, count))
            numbers.append(number[hit])
            offsets.append(offset[hit])
    return np.concatenate(places), np.concatenate(numbers), np.concatenate(offsets)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Smallest edit distance of ``item`` to any stretch of ``text``, and where that stretch ends."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, word in enumerate(item):
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (text != word))
        new[0] = k + 1
        row = np.minimum.accumulate(new - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


def estimated_recall(items: list[Item], repeats: int, trials: int = 200, seed: int = 11) -> list[float]:
    """Share of items with as many random edits as their bound that 1, 2, ... repeats find."""
    rng = random.Random(seed)
    found = np.zeros(repeats)
    for _ in range(trials):
        item = rng.choice(items)
        words = item.words.tolist()
        for _ in range(item.bound):
            at, new, kind = rng.randrange(len(words)), rng.getrandbits(63), rng.randrange(3)
            words[at : at + (kind != 1)] = [new] if kind else []
            words = words or [new]
        copy = np.array(words, np.uint64)
        for repeat in range(repeats):
            own = walk_keys(copy, repeat, {item.steps})[0][item.steps]
            if np.isin(_entries(item, repeat)[0], own).any():
                found[repeat:] += 1
                break
    return (found / trials).tolist()


def repeats_for(items: list[Item], target: float = TARGET, most: int = MAX_REPEATS) -> int:
    recalls = estimated_recall(items, most)
    return next((k + 1 for k, r in enumerate(recalls) if r >= target), most)


class Match(NamedTuple):
    number: int
    distance: int
    start: int
    end: int


def find_matches(hashes: np.ndarray, first: np.ndarray, index: Index) -> list[list[Match]]:
    """Per text the best match of every item found in it."""
    out: list[list[Match]] = [[] for _ in range(len(first) - 1)]
    place, number, offset = candidates(hashes, index)
    row = np.searchsorted(first, place, "right") - 1
    found = np.unique(np.column_stack([row, number, place - first[row] - offset]), axis=0) if len(place) else np.zeros((0, 3), np.int64)
    at = 0
    best: dict[tuple[int, int], Match] = {}
    while at < len(found):
        r, k, start = (int(x) for x in found[at])
        item = index.items[k]
        stop = start
        while at < len(found) and found[at, 0] == r and found[at, 1] == k and found[at, 2] <= stop + item.bound:
            stop = int(found[at, 2])
            at += 1
        text = hashes[first[r] : first[r + 1]]
        a, b = max(0, start - item.bound), min(len(text), stop + len(item.words) + item.bound)
        part = text[a:b]
        # an edit takes at most one of the item's words away
        if np.isin(item.words, part).sum() < len(item.words) - item.bound:
            continue
        distance, end = align(item.words, part)
        if distance <= item.bound:
            length = align(item.words[::-1], part[:end][::-1])[1]
            one = Match(k, distance, a + end - length, a + end)
            old = best.get((r, k))
            if old is None or (one.distance, one.start) < (old.distance, old.start):
                best[r, k] = one
    for (r, _), one in best.items():
        out[r].append(one)
    return out


def _item_words(texts: list[str | None]) -> list[np.ndarray]:
    raw, offsets = text_bytes(pa.array(texts, pa.string()))
    words = find_words(LOWER[raw], offsets, NOT_ALNUM)
    return [words.hash[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    target: float = TARGET,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """One row per document and item that it holds: id, item id, ``distance``, ``first_word``, ``last_word``.

    Words are runs of letters and digits after lower-casing A-Z.  An item is held if a
    stretch of the whole text is within floor(SHARE * words) edits of it; the best stretch is
    given, the earliest of equals.  Items or texts that are missing or without words match
    nothing.  Repeated documents or items give a row each; missing ids stay missing.  Other
    columns are not read.  Items go to all tasks in chunks of a bounded size, one pass over
    the documents per chunk.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    items = benchmark.select(F.col(item_column).cast("long").alias("item"), F.col("text").alias("text"))
    out = spark.createDataFrame([], "id long, item long, distance int, first_word long, last_word long")
    chunk: list[Item] = []
    size = 0

    def scan(own: list[Item]) -> DataFrame:
        repeats = repeats_for(own, target)
        sent = spark.sparkContext.broadcast(build_index(own, repeats))

        def run(stream):
            index = sent.value
            for batch in stream:
                raw, offsets = text_bytes(batch.column(1))
                rows = []
                for a, b in batches(offsets):
                    words = find_words(LOWER[raw[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a], NOT_ALNUM)
                    for i, matches in enumerate(find_matches(words.hash, words.first, index)):
                        rows += [(batch.column(0)[a + i].as_py(), index.items[m.number].id, m.distance, m.start, m.end - 1) for m in matches]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["id", "item", "distance", "first_word", "last_word"])

        return plain.mapInArrow(run, out.schema)

    def texts():
        waiting = []
        for row in items.toLocalIterator():
            waiting.append(row)
            if len(waiting) == 1000:
                yield waiting
                waiting = []
        yield waiting

    for some in texts():
        for row, words in zip(some, _item_words([r["text"] for r in some]), strict=True):
            if len(words):
                chunk.append(Item(row["item"], words))
                size += len(words)
                if size * MAX_REPEATS >= CHUNK_KEYS:
                    out = out.unionByName(scan(chunk))
                    chunk, size = [], 0
    if chunk:
        out = out.unionByName(scan(chunk))
    return out.withColumnsRenamed({"id": id_column, "item": item_column})


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; documents without an id stay."""
    held = contaminated(docs, benchmark, id_column=id_column, **options).select(id_column).distinct()
    return docs.join(held, id_column, "left_anti")
