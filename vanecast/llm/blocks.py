"""Counting keys over all documents without shuffling the keys.

Documents are dealt by a hash of their id, or of id and text, to *blocks* of a few megabytes.  A block's keys
(64-bit hashes of windows, shingles, variants ...) become a partition sketch: the sorted
cells of one row of a count-min sketch with their counts, delta-coded in byte planes, cut
into slices by cell range.  Per slice one task adds up the sketches of all blocks and tells
each block which of its own cells reached a count.  A cell's count is never below the count
of a key in it, so nothing that repeats is lost; what a chance collision lets through is
sorted out by the exact step that follows.  Cells, slices and blocks all grow with the
input; no sketch as a whole is ever in one task or broadcast.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.session import materialize

BLOCK_BYTES = 8 << 20  # text per block
MIN_BLOCKS = 64  # an even deal on small inputs
ROW_BYTES = 64  # that a row takes besides its text
SLICE_CELLS = 1 << 25  # cells added up in one task: 64 MB of counters
MIN_SLICES = 64
MIN_CELLS = 1 << 20
FULL = 65_535  # a count stops here

SKETCH = "slice long, block long, cells binary, counts binary"
FLAGGED = "block long, slice long, cells binary, counts binary"


class Deal:
    """How many blocks, cells and slices an input of ``size`` bytes takes."""

    def __init__(self, size: int, keys_per_byte: float = 1.0):
        self.blocks = max(MIN_BLOCKS, -(-size // BLOCK_BYTES))
        self.cell_bits = max(MIN_CELLS, int(size * keys_per_byte)).bit_length()
        self.slices = max(MIN_SLICES, (1 << self.cell_bits) // SLICE_CELLS)

    def cells(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(64 - self.cell_bits)

    @property
    def slice_width(self) -> int:
        return -(-(1 << self.cell_bits) // self.slices)


def deal(docs: DataFrame, id_column: str, text_column: str, keys_per_byte: float = 1.0) -> tuple[DataFrame, Deal]:
    """``docs`` with its ``block``; one pass adds up the bytes of all texts."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_column)))).first()[0] or 0
    how = Deal(size, keys_per_byte)
    return docs.withColumn("block", F.pmod(F.xxhash64(F.col(id_column)), F.lit(how.blocks))), how


def deal_rows(docs: DataFrame, id_column: str, text_column: str, keys_per_byte: float = 1.0) -> tuple[DataFrame, Deal]:
    """``docs`` with its ``block``, dealt by id and text, so that rows of a repeated or missing id part.

    Rows that are equal in both and together exceed a block are dealt one by one; only they
    are written out, so that every pass finds a row in the same block.
    """
    key = F.xxhash64(F.col(id_column), F.col(text_column))
    size = F.octet_length(F.col(text_column))
    sums = docs.groupBy(key.alias("key")).agg(F.sum(size).alias("size"), F.count("*").alias("rows"))
    heavy = F.col("size") + F.col("rows") * ROW_BYTES > BLOCK_BYTES  # at most one key for each block of the input
    total = sums.agg(F.sum("size").alias("size"), F.collect_list(F.when(heavy, F.col("key"))).alias("keys")).first()
    how = Deal(total["size"] or 0, keys_per_byte)
    if not total["keys"]:
        return docs.withColumn("block", F.pmod(key, F.lit(how.blocks))), how
    hot = F.array_contains(F.lit(total["keys"]).cast("array<bigint>"), key)
    even = docs.filter(~hot).withColumn("block", F.pmod(key, F.lit(how.blocks)))
    split = docs.filter(hot).withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(how.blocks)))
    return even.unionByName(materialize(split, "split")), how


def pack(values: np.ndarray) -> bytes:
    """Sorted distinct numbers as byte planes of their differences (zero planes compress away)."""
    steps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)
    used = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([used]) + np.ascontiguousarray(planes[:, :used].T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    used = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(used, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :used] = planes.T
    return np.cumsum(wide.reshape(-1).view("<u8"), dtype=np.uint64)


def sketch_rows(block: int, cells: np.ndarray, how: Deal) -> pa.Table:
    """A block's sketch, one row per slice; ``cells`` may repeat and need no order."""
    cells, counts = np.unique(cells, return_counts=True)
    counts = np.minimum(counts, FULL).astype("<u2")
    width = np.uint64(how.slice_width)
    parts = (cells // width).astype(np.int64)
    borders = np.flatnonzero(np.diff(parts, prepend=-1, append=-1 if len(parts) else -1))
    out = {"slice": [], "block": [], "cells": [], "counts": []}
    for a, b in zip(borders[:-1], borders[1:], strict=True):
        out["slice"].append(int(parts[a]))
        out["block"].append(block)
        out["cells"].append(pack(cells[a:b] - np.uint64(parts[a]) * width))
        out["counts"].append(np.ascontiguousarray(counts[a:b].view(np.uint8).reshape(-1, 2).T).tobytes())
    return pa.table(out, pa.schema([("slice", pa.int64()), ("block", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary())]))


def _counts(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(2, -1).T).reshape(-1).view("<u2")


def add_up(how: Deal, least: int) -> Callable[[pa.Table], pa.Table]:
    """Merge the sketches of one slice; each block gets back its cells whose total reaches ``least``."""
    width = how.slice_width

    def merge(part: pa.Table) -> pa.Table:
        total = np.zeros(width, np.uint16)
        rows = [(b, unpack(c), _counts(n)) for b, c, n in zip(*(part.column(x).to_pylist() for x in ("block", "cells", "counts")), strict=True)]
        for _, cells, counts in rows:
            room = FULL - total[cells]
            total[cells] += np.minimum(counts, room).astype(np.uint16)
        index = part.column("slice")[0].as_py()
        out = {"block": [], "slice": [], "cells": [], "counts": []}
        for block, cells, _ in rows:
            seen = total[cells]
            keep = seen >= least
            if keep.any():
                out["block"].append(block)
                out["slice"].append(index)
                out["cells"].append(pack(cells[keep]))
                out["counts"].append(np.ascontiguousarray(seen[keep].astype("<u2").view(np.uint8).reshape(-1, 2).T).tobytes())
        return pa.table(out, pa.schema([("block", pa.int64()), ("slice", pa.int64()), ("cells", pa.binary()), ("counts", pa.binary())]))

    return merge


def read_flags(flags: pa.Table, how: Deal) -> tuple[np.ndarray, np.ndarray]:
    """All flagged cells of a block in order, with their total counts."""
    order = np.argsort(flags.column("slice").to_numpy(), kind="stable")
    cells, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint16)]
    for i in order:
        cells.append(unpack(flags.column("cells")[i].as_py()) + np.uint64(flags.column("slice")[i].as_py() * how.slice_width))
        counts.append(_counts(flags.column("counts")[i].as_py()))
    return np.concatenate(cells), np.concatenate(counts)


def look_up(cells: np.ndarray, flagged: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The total count of each cell, 0 where it was not flagged."""
    if not len(flagged) or not len(cells):
        return np.zeros(len(cells), np.uint16)
    at = np.minimum(np.searchsorted(flagged, cells), len(flagged) - 1)
    return np.where(flagged[at] == cells, counts[at], 0)


def repeated_cells(blocks: DataFrame, keys_of: Callable[[pa.Table], np.ndarray], how: Deal, least: int = 2) -> DataFrame:
    """Per block, the cells of its keys that are counted ``least`` times or more over all blocks.

    ``blocks`` has a column ``block``; ``keys_of`` gives the 64-bit keys of a block's rows.
    """

    def sketch(part: pa.Table) -> pa.Table:
        return sketch_rows(part.column("block")[0].as_py(), how.cells(keys_of(part)), how)

    sketches = blocks.groupBy("block").applyInArrow(sketch, SKETCH)
    return sketches.groupBy("slice").applyInArrow(add_up(how, least), FLAGGED)
