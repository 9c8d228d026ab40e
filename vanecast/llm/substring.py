"""Substring dedup: words covered by a window of words that also starts in an earlier document go.

Count-min prefilter, then exact grouping.  Pass 1 turns every block of documents into a
partition sketch of its window counts (``blocks.py``); the merged sketches overestimate the
counts, so a window whose cell is counted once cannot repeat.  Pass 2 gives out only windows
estimated to repeat, one row per block and distinct window with the smallest id that has it,
and groups them exactly by 128 bits of hash.  Pass 3 marks and removes the words.

Documents are shuffled once; a window in a third of all documents is one row per block.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vanecast.llm.blocks import FULL, Deal, deal_rows, look_up, read_flags, repeated_cells
from vanecast.llm.kernels import batches, find_words, text_bytes, window_hash, window_starts

LAST = (1 << 63) - 1  # stands for a missing id: later than every other


def _windows(part: pa.Table, width: int, second: bool = False):
    """Per window of a block: 64-bit hash, a second one if asked, and the row it lies in."""
    raw, offsets = text_bytes(part.column("text"))
    hashes, seconds, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in batches(offsets):
        words = find_words(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        at, owner = window_starts(words.first, width)
        hashes.append(window_hash(words.hash, width)[at])
        if second:
            seconds.append(window_hash(words.hash, width, 2)[at])
        rows.append(owner + a)
    return np.concatenate(hashes), np.concatenate(seconds), np.concatenate(rows)


def _ids(part: pa.Table) -> np.ndarray:
    return part.column("id").to_numpy()


def _repeating(width: int, how: Deal):
    """Pass 2: the block's windows that may repeat, with the smallest id of the block."""

    def give(part: pa.Table, flags: pa.Table) -> pa.Table:
        if not part.num_rows or not flags.num_rows:
            return pa.table({"h1": pa.array([], pa.int64()), "h2": pa.array([], pa.int64()), "block": pa.array([], pa.int64()), "id": pa.array([], pa.int64())})
        h1, h2, rows = _windows(part, width, second=True)
        total = look_up(how.cells(h1), *read_flags(flags, how))
        h1, h2, ids, total = (x[total > 1] for x in (h1, h2, _ids(part)[rows], total))
        # all places of a cell in this block: no other block has the window
        _, where, own = np.unique(how.cells(h1), return_inverse=True, return_counts=True)
        away = (total > own[where]) | (total == FULL)
        h1, h2, ids = h1[away], h2[away], ids[away]
        order = np.lexsort((ids, h2, h1))
        h1, h2, ids = h1[order], h2[order], ids[order]
        lead = np.ones(len(h1), bool)
        lead[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        block = np.full(lead.sum(), part.column("block")[0].as_py(), np.int64)
        return pa.table({"h1": h1[lead].view(np.int64), "h2": h2[lead].view(np.int64), "block": block, "id": ids[lead]})

    return give


def _strip(width: int):
    """Pass 3: remove the covered words of each document of a block."""

    def strip(part: pa.Table, earlier: pa.Table) -> pa.Table:
        h1, h2, rows = _windows(part, width, second=True)
        ids = _ids(part)
        least = ids[rows]
        # the smallest id inside the block
        order = np.lexsort((least, h2, h1))
        lead = np.ones(len(order), bool)
        a, b = order[1:], order[:-1]
        lead[1:] = (h1[a] != h1[b]) | (h2[a] != h2[b])
        group = np.cumsum(lead) - 1
        first = least[order][lead]
        least[order] = first[group]
        if earlier.num_rows:  # and in other blocks
            e1 = earlier.column("h1").to_numpy().view(np.uint64)
            by = np.argsort(e1, kind="stable")
            e1, g = e1[by], earlier.column("first").to_numpy()[by]
            at = np.minimum(np.searchsorted(e1, h1), len(e1) - 1)
            hit = e1[at] == h1
            least[hit] = np.minimum(least[hit], g[at[hit]])
        drop = least < ids[rows]
        by_row = np.searchsorted(rows, np.arange(part.num_rows + 1))
        total, removed, texts = [], [], []
        column = part.column("text")
        for i in range(part.num_rows):
            words = (column[i].as_py() or "").encode().split()
            marks = drop[by_row[i] : by_row[i + 1]]
            total.append(len(words))
            if marks.any():
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.flatnonzero(marks)
                edge[at] += 1
                np.subtract.at(edge, at + width, 1)
                keep = np.cumsum(edge[:-1]) == 0
                words = list(compress(words, keep))
            removed.append(total[-1] - len(words))
            texts.append(b" ".join(words).decode())
        return pa.table({"id": ids, "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "text": pa.array(texts, pa.string())})

    return strip


def substring_dedup(docs: DataFrame, width: int = 13, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``text`` (kept words joined by one space).

    A word goes if a run of ``width`` words that covers it also starts in a document with a
    smaller id; runs are judged on the input.  Words are runs of non-space characters.
    Missing and empty texts give 0 words and an empty text; texts shorter than ``width`` are
    kept.  Rows with equal ids count as one document and do not shorten each other; a
    missing id counts as later than all others and stays missing.  Other columns are not read.
    """
    plain = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    blocks, how = deal_rows(plain, "id", "text", keys_per_byte=8)
    flags = repeated_cells(blocks, lambda part: _windows(part, width)[0], how)
    found = (
        blocks.groupBy("block")
        .cogroup(flags.groupBy("block"))
        .applyInArrow(_repeating(width, how), "h1 long, h2 long, block long, id long")
    )
    first = F.min("id").over(Window.partitionBy("h1", "h2"))
    earlier = found.withColumn("first", first).filter("first < id").select("block", "h1", "first")
    kept = (
        blocks.groupBy("block")
        .cogroup(earlier.groupBy("block"))
        .applyInArrow(_strip(width), "id long, n_words long, n_removed long, text string")
    )
    return kept.select(F.when(F.col("id") != LAST, F.col("id")).alias(id_column), "n_words", "n_removed", "text")
