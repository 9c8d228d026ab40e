"""Line dedup: a line goes if an equal or nearly equal line stands earlier in the corpus.

Deletion-neighbourhood join.  Two lines are within one edit (a word inserted, deleted or
replaced) exactly if deleting at most one word of each leaves the same words; so a line's
variants are itself and the line without its word i, for every i, as hashed keys.  Equal
variants with the word missing at the same place, or with nothing missing on one side, are
joined, the words of the two lines are compared, and the earliest line is kept.

Three steps keep the work small and lose nothing.  Equal lines are merged first, so only the
first occurrence of a text goes on.  One edit leaves the first or the second half of a line
as it is, so only lines of which another line shares a half give out variants; that is found
with the partition sketches of ``blocks.py``.  And a block of documents gives out one row per
variant, its earliest line, however many lines have it.
"""

from __future__ import annotations

from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanecast.llm.blocks import Deal, add_up, deal_rows, look_up, read_flags, sketch_rows
from vanecast.llm.kernels import Ranges, Words, batches, find_words, mix, text_bytes

LAST = (1 << 63) - 1  # stands for a missing id: later than every other
MIN_WORDS = 8  # a line of fewer words is compared for equality only
WHOLE = -1  # the place of a variant from which nothing is missing
_U = np.uint64


class Lines(NamedTuple):
    """Lines with words of a block, in order: row of the document, number in it, span of words, hashes."""

    row: np.ndarray
    number: np.ndarray
    first: np.ndarray
    end: np.ndarray
    h1: np.ndarray
    h2: np.ndarray
    halves: np.ndarray  # 4 keys per line, 0 where it gives none


class Piece(NamedTuple):
    """Some documents of a block: their lines, hashes of runs of their words, bytes and word spans."""

    lines: Lines
    ranges: Ranges
    raw: np.ndarray
    words: Words


def _pieces(part: pa.Table, min_words: int = MIN_WORDS, halves: bool = False, second: bool = False) -> list[Piece]:
    """The block's documents, read once; the keys of halves and the second hash only if asked."""
    raw_all, offsets = text_bytes(part.column("text"))
    out = []
    for a, b in batches(offsets):
        raw, own = raw_all[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        words = find_words(raw, own)
        feeds = np.flatnonzero(raw == 0x0A)
        owner = words.owner()
        number = np.searchsorted(feeds, words.start) - np.searchsorted(feeds, own[:-1])[owner]
        lead = np.ones(len(owner), bool)
        lead[1:] = (owner[1:] != owner[:-1]) | (number[1:] != number[:-1])
        first = np.flatnonzero(lead)
        end = np.append(first[1:], len(owner)) if len(first) else first
        ranges = Ranges(words.hash)
        n = end - first
        keys = np.zeros((len(first), 4), np.uint64)
        if halves:
            for k, m in enumerate((n, n + 1)):  # as the longer line of a pair, and as the shorter one
                half = m // 2
                some = (m >= min_words) & (n > 1)
                keys[:, 2 * k] = np.where(some, mix(ranges.plain(first, first + np.minimum(half, n)) + m.astype(np.uint64) * _U(4)), 0)
                keys[:, 2 * k + 1] = np.where(some, mix(ranges.plain(np.maximum(end - (m - half), first), end) + m.astype(np.uint64) * _U(4) + _U(1)), 0)
        h1 = mix(ranges.plain(first, end))
        h2 = mix(Ranges(words.hash, 0x5851F42D4C957F2D).plain(first, end)) if second else h1
        out.append(Piece(Lines(owner[first] + a, number[first], first, end, h1, h2, keys), ranges, raw, words))
    return out


def _all(pieces: list[Piece]) -> Lines:
    if not pieces:
        none = np.zeros(0, np.int64)
        return Lines(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64), np.zeros((0, 4), np.uint64))
    return Lines(*(np.concatenate(x) for x in zip(*(p.lines for p in pieces), strict=True)))


def _first_in_block(lines: Lines, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lines that are the earliest of their text in the block, and for each line the place of that one."""
    order = np.lexsort((lines.number, ids[lines.row], lines.h2, lines.h1))
    lead = np.ones(len(order), bool)
    a, b = order[1:], order[:-1]
    lead[1:] = (lines.h1[a] != lines.h1[b]) | (lines.h2[a] != lines.h2[b])
    least = np.empty(len(order), np.int64)
    least[order] = order[lead][np.cumsum(lead) - 1] if len(order) else order
    return order[lead], least


def _distinct(part: pa.Table) -> pa.Table:
    """The distinct lines of a block with their earliest place."""
    lines, ids = _all(_pieces(part, second=True)), part.column("id").to_numpy()
    lead, _ = _first_in_block(lines, ids)
    block = np.full(len(lead), part.column("block")[0].as_py(), np.int64)
    return pa.table(
        {"h1": lines.h1[lead].view(np.int64), "h2": lines.h2[lead].view(np.int64), "block": block, "id": ids[lines.row[lead]], "line": lines.number[lead]}
    )


def _is_first(lines: Lines, ids: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Lines that are the first occurrence of their text in the corpus (repeated rows tie)."""
    _, least = _first_in_block(lines, ids)
    tie = (ids[lines.row] == ids[lines.row[least]]) & (lines.number == lines.number[least])
    return tie & ~np.isin(lines.h1, later)


def _kind(flags: pa.Table, kind: int) -> pa.Table:
    return flags.filter(pa.array(flags.column("kind").to_numpy() == kind)) if flags.num_rows else flags


def _hashes(flags: pa.Table) -> np.ndarray:
    later = _kind(flags, 0)
    return later.column("h").to_numpy().view(np.uint64) if later.num_rows else np.zeros(0, np.uint64)


def _sketch(min_words: int, how: Deal):
    def give(part: pa.Table, flags: pa.Table) -> pa.Table:
        if not part.num_rows:
            return sketch_rows(0, np.zeros(0, np.uint64), how)
        lines = _all(_pieces(part, min_words, halves=True))
        first = _is_first(lines, part.column("id").to_numpy(), _hashes(flags))
        keys = lines.halves[first].reshape(-1)
        return sketch_rows(part.column("block")[0].as_py(), how.cells(keys[keys != 0]), how)

    return give


class Variant(NamedTuple):
    id: int
    number: int
    h: int
    words: list[bytes]
    row: int = -1  # of the block; ids may repeat


def _variants(pieces: list[Piece], ids: np.ndarray, flags: pa.Table, min_words: int, how: Deal):
    """Variants of the first occurrences that share a half: (hash, place, line) each."""
    cells = read_flags(_kind(flags, 1), how)
    everything = _all(pieces)
    first = _is_first(everything, ids, _hashes(flags))
    shared = (look_up(how.cells(everything.halves.reshape(-1)), *cells).reshape(-1, 4) > 1) & (everything.halves != 0)
    chosen = first & shared.any(axis=1)
    at = 0
    for lines, ranges, raw, words in pieces:
        own = np.flatnonzero(chosen[at : at + len(lines.row)])
        at += len(lines.row)
        for i in own.tolist():
            a, b = int(lines.first[i]), int(lines.end[i])
            text = raw[words.start[a] : words.end[b - 1]].tobytes().split()
            line = Variant(int(ids[lines.row[i]]), int(lines.number[i]), int(lines.h1[i].astype(np.int64)), text, int(lines.row[i]))
            yield int(mix(ranges.plain(lines.first[i : i + 1], lines.end[i : i + 1])).astype(np.int64)[0]), WHOLE, line
            if b - a >= min_words:
                k = np.arange(a, b)
                ends = np.full(b - a, b)
                for place, v in enumerate(mix(ranges.join(np.full(b - a, a), k, ends)).view(np.int64).tolist()):
                    yield v, place, line


def _earliest(min_words: int, how: Deal):
    """One row per variant of a block: its earliest line; its words once per line."""

    def give(part: pa.Table, flags: pa.Table) -> pa.Table:
        best: dict[tuple[int, int], Variant] = {}
        if part.num_rows and flags.num_rows:
            pieces = _pieces(part, min_words, halves=True)
            for v, place, line in _variants(pieces, part.column("id").to_numpy(), flags, min_words, how):
                old = best.get((v, place))
                if old is None or line[:2] < old[:2]:
                    best[v, place] = line
        block = part.column("block")[0].as_py() if part.num_rows else 0
        texts = {x.h: x for x in best.values()}
        n, m = len(best), len(texts)
        # column by column: a tuple per variant would take ten times as much memory
        both = [*best.values(), *texts.values()]
        out = {
            "v": np.fromiter(chain((k[0] for k in best), texts), np.int64, n + m),
            "place": pa.array(np.concatenate([np.fromiter((k[1] for k in best), np.int64, n), np.zeros(m, np.int64)]), mask=np.arange(n + m) >= n),
            "id": np.fromiter((x.id for x in both), np.int64, n + m),
            "line": np.fromiter((x.number for x in both), np.int64, n + m),
            "h": np.fromiter((x.h for x in both), np.int64, n + m),
            "block": np.full(n + m, block, np.int64),
            "text": pa.concat_arrays([pa.nulls(n, pa.string()), pa.array([b" ".join(x.words).decode() for x in texts.values()], pa.string())]),
        }
        return pa.table(out, _EARLIEST)

    return give


_EARLIEST = pa.schema([("v", pa.int64()), ("place", pa.int64()), ("id", pa.int64()), ("line", pa.int64()), ("h", pa.int64()), ("block", pa.int64()), ("text", pa.string())])


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether one inserted, deleted or replaced word at most turns ``a`` into ``b``."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == (b[i + 1 :] if len(a) == len(b) else b[i:]) or a == b


def _keep(min_words: int, how: Deal, carry: bool):
    """The documents of a block without the lines that go."""

    def keep(part: pa.Table, flags: pa.Table) -> pa.Table:
        ids, later = part.column("id").to_numpy(), _hashes(flags)
        pieces = _pieces(part, min_words, halves=True)
        lines = _all(pieces)
        gone = ~_is_first(lines, ids, later)
        near: set[tuple[int, int]] = set()
        if flags.num_rows:
            local: dict[tuple[int, int], Variant] = {}
            mine = list(_variants(pieces, ids, flags, min_words, how))
            for v, place, line in mine:
                old = local.get((v, place))
                if old is None or line[:2] < old[:2]:
                    local[v, place] = line
            same: dict[int, list[Variant]] = {v: [] for v, place, _ in mine if place == WHOLE}
            for (v, _), line in local.items():
                if v in same:
                    same[v].append(line)
            far: dict[tuple[int, int], list[Variant]] = {}
            remote = _kind(flags, 2)
            for v, place, i, n, text in zip(*(remote.column(c).to_pylist() for c in ("h", "slice", "first_id", "first_line", "text")), strict=True):
                far.setdefault((v, place), []).append(Variant(i, n, 0, text.encode().split()))
            for v, place, line in mine:
                if (line.row, line.number) in near:
                    continue
                others = same[v] if place == WHOLE else [local[v, p] for p in (place, WHOLE) if (v, p) in local]
                for other in sorted(others + far.get((v, place), []), key=lambda x: x[:2]):
                    if other[:2] >= line[:2]:
                        break
                    if within_one(line.words, other.words):
                        near.add((line.row, line.number))
                        break
        by_row = np.searchsorted(lines.row, np.arange(part.num_rows + 1))
        total, removed, texts = [], [], []
        column = part.column("text")
        for r in range(part.num_rows):
            own = range(by_row[r], by_row[r + 1])
            out = {int(lines.number[i]) for i in own if gone[i] or (r, int(lines.number[i])) in near}
            text = column[r].as_py()
            total.append(len(own))
            removed.append(len(out))
            texts.append("\n".join(x for i, x in enumerate(text.split("\n")) if i not in out) if out else text)
        out = {"id": ids, "n_lines": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "text": pa.array(texts, pa.string())}
        return pa.table(out | ({"rest": part.column("rest")} if carry else {}))

    return keep


_FLAGS = ("block long", "kind int", "slice long", "cells binary", "counts binary", "h long", "first_id long", "first_line long", "text string")


def _flags(df: DataFrame, kind: int, **columns) -> DataFrame:
    """``df`` in the common form of all messages to blocks."""
    out = []
    for spec in _FLAGS:
        name, dtype = spec.split()
        value = F.lit(kind) if name == "kind" else columns.get(name, F.lit(None))
        out.append(value.cast(dtype).alias(name))
    return df.select(*out)


def nullable(kind: T.DataType) -> T.DataType:
    """The type with every part of it nullable, as workers return it."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType), True) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(nullable(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(nullable(kind.keyType), nullable(kind.valueType), True)
    return kind


def line_dedup(
    docs: DataFrame, min_words: int = MIN_WORDS, id_column: str = "doc_id", text_column: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per document: id, ``n_lines``, ``n_removed``, the ``text`` that is left, and the columns to ``carry``.

    Lines end at line feeds and count if they have a word (a run of non-space characters); a
    line goes if an earlier line - smaller id, or same id and further up - has the same words,
    or words within one edit where the longer of both has at least ``min_words``.  Lines are
    judged on the input.  Blank lines stay; a document without removals keeps its text as it
    is.  Columns to carry may not be named like those of the result.  A missing text counts as empty.  Rows with equal ids count as one document: a line
    at the same place of both stays in both.  A missing id is later than all others.  Other
    columns are not read.  An empty table gives an empty table.
    """
    schema, rest = T.StructType.fromDDL("id long, n_lines long, n_removed long, text string"), []
    if carry:
        schema = schema.add("rest", nullable(docs.select(*[F.col(f"`{c}`") for c in carry]).schema))
        rest = [F.struct(*[F.col(f"`{c}`") for c in carry]).cast(schema["rest"].dataType).alias("rest")]
    plain = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"), *rest)
    blocks, how = deal_rows(plain, "id", "text")
    by_block = blocks.groupBy("block")

    distinct = by_block.applyInArrow(_distinct, "h1 long, h2 long, block long, id long, line long")
    first = F.min(F.struct("id", "line")).over(Window.partitionBy("h1", "h2"))
    later = distinct.withColumn("first", first).filter(F.col("first") < F.struct("id", "line"))
    later = _flags(later, 0, block=F.col("block"), h=F.col("h1"))

    sketches = by_block.cogroup(later.groupBy("block")).applyInArrow(_sketch(min_words, how), "slice long, block long, cells binary, counts binary")
    shared = sketches.groupBy("slice").applyInArrow(add_up(how, 2), "block long, slice long, cells binary, counts binary")
    shared = _flags(shared, 1, **{c: F.col(c) for c in ("block", "slice", "cells", "counts")})

    known = later.unionByName(shared)
    rows = by_block.cogroup(known.groupBy("block")).applyInArrow(
        _earliest(min_words, how), "v long, place long, id long, line long, h long, block long, text string"
    ).repartition("v")  # dealt once, read three times
    place = F.struct("id", "line", "h")
    whole = Window.partitionBy("v")
    own = F.struct("id", "line")
    # both readings take all rows and columns of the exchange, so that the pass before it runs once
    ranked = rows.withColumn("size", F.count("*").over(whole))
    found = (
        rows.withColumn("same", F.min(place).over(Window.partitionBy("v", "place")))
        .withColumn("full", F.min(F.when(F.col("place") == WHOLE, place)).over(whole))
        .withColumn("less", F.min(F.when(F.col("place") != WHOLE, place)).over(whole))
        .withColumn("best", F.when(F.col("place") == WHOLE, F.col("less")).otherwise(F.least("same", "full")))
        .filter(F.col("same").isNotNull() & F.col("place").isNotNull() & (F.struct("best.id", "best.line") < own))
        .select("block", "v", "place", "best.*", F.col("text").alias("__none"))
    )
    words = ranked.filter("size > 0 AND place IS NULL AND id IS NOT NULL AND line IS NOT NULL AND block IS NOT NULL").select("h", "text")
    found = found.join(words, "h").withColumn("text", F.coalesce("text", "__none"))
    near = _flags(found, 2, block=F.col("block"), slice=F.col("place"), h=F.col("v"), first_id=F.col("id"), first_line=F.col("line"), text=F.col("text"))

    kept = by_block.cogroup(known.unionByName(near).groupBy("block")).applyInArrow(_keep(min_words, how, bool(carry)), schema)
    return kept.select(F.when(F.col("id") != LAST, F.col("id")).alias(id_column), "n_lines", "n_removed", "text", *[f"rest.`{c}`" for c in carry])
