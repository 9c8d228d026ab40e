"""Sums of a weight times the average rank of many columns, without ordering rows in Spark.

Rows with equal values share the mean of their places, so all that counts of a column are
its distinct values with the number of their rows and the sum of their weights. These are
reduced in the task that reads the rows, before any shuffle. Values travel as integers in
the order of the doubles, grouped by their leading 16 bits; a group of more rows than one
task may hold is parted by the next 16 bits, and so on. Group sizes are a histogram whose
running total gives the rank at which a group begins.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vanecast.session import group_rows, materialize

LEVEL_BITS = 16
CHUNK_CELLS = 4_000_000  # rows times columns reduced at a time
COUNTED_COLUMNS = 16  # columns counted by one scan
WHOLE = -1  # the target itself over all rows

Part = tuple[int, np.ndarray, np.ndarray]


def ordered_keys(values: np.ndarray) -> np.ndarray:
    """Doubles as unsigned integers in the same order; zeros are equal, NaN is the largest."""
    bits = (values.astype(float) + 0.0).view(np.uint64)
    top = np.uint64(1) << np.uint64(63)
    keys = np.where(bits & top, ~bits, bits | top)
    keys[np.isnan(values)] = np.iinfo(np.uint64).max
    return keys


def _chunks(stream: Iterator[pa.RecordBatch], columns: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in stream:
        held.append(batch)
        if sum(b.num_rows for b in held) * columns >= CHUNK_CELLS:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def _parts(chunk: pa.Table, partial: Sequence[int], columns: int) -> Iterator[Part]:
    """(number, keys, weights) of each column over its known rows.

    Column i is number 2 i; the target over the rows in which a partly known column i is known is 2 i + 1.
    """
    target = chunk.column("a")
    weight = target.fill_null(0.0).to_numpy()
    own = ordered_keys(target.fill_null(float("-inf")).to_numpy())
    yield WHOLE, own, weight
    for i in range(columns):
        column = chunk.column(f"c{i}")
        if column.null_count:
            known = ~column.is_null().combine_chunks().to_numpy(zero_copy_only=False)
            yield 2 * i, ordered_keys(column.drop_null().to_numpy()), weight[known]
        else:
            known = np.ones(len(weight), bool)
            yield 2 * i, ordered_keys(column.to_numpy()), weight
        if i in partial:
            yield 2 * i + 1, own[known], weight[known]


def _starts(keys: np.ndarray, levels: Mapping[int, np.ndarray]) -> np.ndarray:
    """First key of the group each key belongs to, given the prefixes of each level that are parted further."""
    if not levels:
        return np.zeros(len(keys), np.uint64)
    out = np.empty(len(keys), np.uint64)
    left = np.arange(len(keys))
    for level in range(1, 64 // LEVEL_BITS + 1):
        shift = np.uint64(64 - LEVEL_BITS * level)
        prefix = keys[left] >> shift
        out[left] = prefix << shift
        left = left[np.isin(prefix, levels.get(level, np.zeros(0, np.uint64)))]
        if not len(left):
            break
    return out


def _heavy(rows: DataFrame, counts: Mapping[int, int], partial: Sequence[int], columns: int, max_rows: int) -> dict[int, dict[int, np.ndarray]]:
    """For each column with more than ``max_rows`` rows, the prefixes of each level that hold more than that.

    A heavy prefix stands for more than ``max_rows`` rows, so there are fewer than cells / max_rows of them.
    """
    levels = {number: {0: np.zeros(1, np.uint64)} for number, n in counts.items() if n > max_rows}
    open_ = dict(levels)
    for level in range(1, 64 // LEVEL_BITS):
        if not open_:
            break
        shift, wanted = np.uint64(64 - LEVEL_BITS * level), {k: v[level - 1] for k, v in open_.items()}

        def count(stream, shift=shift, wanted=wanted, first=level == 1):
            for chunk in _chunks(stream, columns):
                for number, keys, _ in _parts(chunk, partial, columns):
                    if number in wanted:
                        prefix = keys >> shift
                        if not first:
                            prefix = prefix[np.isin(prefix >> np.uint64(LEVEL_BITS), wanted[number])]
                        prefix, n = np.unique(prefix, return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(n), number)), pa.array(prefix.view(np.int64)), pa.array(n)], names=["number", "prefix", "n"]
                        )

        found = rows.mapInArrow(count, "number long, prefix long, n long").groupBy("number", "prefix").agg(F.sum("n").alias("n"))
        heavy: dict[int, list[int]] = {}
        for r in found.where(F.col("n") > max_rows).collect():
            heavy.setdefault(r["number"], []).append(r["prefix"])
        open_ = {}
        for number, prefixes in heavy.items():
            levels[number][level] = np.array(prefixes, np.int64).view(np.uint64)
            open_[number] = levels[number]
    return levels


def rank_sums(df: DataFrame, target: str, columns: Sequence[str], max_rows: int | None = None) -> DataFrame:
    """Rows (i, n, total, weighted, best): of the i-th column, over the rows where it is known.

    ``n`` counts rows, ``total`` sums the target, ``weighted`` sums target times average rank
    by the column and ``best`` target times average rank by the target itself. A NULL target
    weighs nothing and ranks first.
    """
    max_rows = group_rows(df.sparkSession) if max_rows is None else max_rows
    rows = df.select(F.col(target).cast("double").alias("a"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    known: dict[str, int] = {}
    for i in range(0, len(columns), COUNTED_COLUMNS) or [0]:  # a scan of few columns each; the code of a wide one is too long to be compiled
        some = range(i, min(i + COUNTED_COLUMNS, len(columns)))
        known |= rows.agg(F.count(F.lit(1)).alias("total"), *[F.count(f"c{j}").alias(str(j)) for j in some]).first().asDict()
    total = known.pop("total")
    counts = {2 * int(i): n for i, n in known.items()} | {WHOLE: total}
    partial = [int(i) for i, n in known.items() if n < total]
    counts |= {2 * i + 1: known[str(i)] for i in partial}
    width = len(columns)
    levels = _heavy(rows, counts, partial, width, max_rows)

    def reduce(stream):
        for chunk in _chunks(stream, width):
            out = {x: [] for x in ("number", "start", "keys", "counts", "sums")}
            for number, keys, weights in _parts(chunk, partial, width):
                if not len(keys):
                    continue
                # only distinct keys are put in order; weights of equal ones add up in the order of rows
                place, distinct = pd.factorize(keys)
                order = np.argsort(distinct)
                keys = distinct[order]
                sums, n = np.bincount(place, weights)[order], np.bincount(place)[order]
                start = _starts(keys, levels.get(number, {}))
                cuts = np.flatnonzero(np.append(True, start[1:] != start[:-1]))
                for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(start)], strict=True):
                    out["number"].append(number)
                    out["start"].append(int(start[x : x + 1].view(np.int64)[0]))
                    for name, values in (("keys", keys), ("counts", n), ("sums", sums)):
                        out[name].append(values[x:y].tobytes())
            kinds = {"number": pa.int64(), "start": pa.int64(), "keys": pa.binary(), "counts": pa.binary(), "sums": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(out[x], kinds[x]) for x in kinds], names=list(kinds))

    def merge(part: pa.Table) -> pa.Table:
        keys, n, s = (
            np.concatenate([np.frombuffer(x.as_py(), kind) for x in part.column(name)])
            for name, kind in (("keys", np.uint64), ("counts", np.int64), ("sums", float))
        )
        order = np.argsort(keys, kind="stable")
        keys, n, s = keys[order], n[order], s[order]
        lead = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n, s = np.add.reduceat(n, lead), np.add.reduceat(s, lead)
        rank = np.cumsum(n) - n + (n + 1) / 2
        return pa.table(
            {"number": part.column("number")[:1], "start": part.column("start")[:1], "n": [int(n.sum())], "s": [float(s.sum())], "w": [float((s * rank).sum())]}
        )

    packed = rows.mapInArrow(reduce, "number long, start long, keys binary, counts binary, sums binary")
    groups = packed.groupBy("number", "start").applyInArrow(merge, "number long, start long, n long, s double, w double")
    # unsigned order of the first keys; a column has as many rows here as its histogram has cells
    in_order = Window.partitionBy("number").orderBy(F.col("start").bitwiseXOR(F.lit(-(1 << 63)))).rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("before", F.coalesce(F.sum("n").over(in_order), F.lit(0)))
    sums = placed.groupBy("number").agg(
        F.sum("n").alias("n"), F.sum("s").alias("total"), F.sum(F.col("w") + F.col("before") * F.col("s")).alias("weighted")
    )
    sums = materialize(sums, "rank-sums")  # read for the columns and for the target
    partly = F.array(*[F.lit(i) for i in partial]).cast("array<long>")
    # every column with the number of its own ranks of the target
    listed = df.sparkSession.range(width).withColumn("own", F.when(F.array_contains(partly, F.col("id")), 2 * F.col("id") + 1).otherwise(F.lit(WHOLE)))
    by_column = sums.select((F.col("number") / 2).cast("long").alias("id"), "number", "n", "total", "weighted").where("number >= 0 AND number % 2 = 0")
    best = sums.select(F.col("number").alias("own"), F.col("weighted").alias("best"))
    # one row per column on each side
    joined = listed.join(F.broadcast(by_column.drop("number")), "id").join(F.broadcast(best), "own")
    return joined.select(F.col("id").alias("i"), "n", "total", "weighted", "best")
