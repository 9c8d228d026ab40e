"""K-means rounds whose centres stay on the executors.

Vectors are packed into blocks of a few megabytes. In a round a block finds the nearest centre
of each of its rows and gives out the sums of its members, cut into slices by place; a slice
adds up the sums of all blocks and hands each block the values at the places it uses. The driver
sees counts, norms and a digest of the assignment, whatever the width of the vectors.
"""

from __future__ import annotations

import hashlib
import warnings
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.session import materialize

_PACKED = "block long, side binary, counts binary, places binary, at binary, entries binary"
_MESSAGE = "slice long, block long, places binary, sums binary, known binary, n0 array<long>, n1 array<long>, norm array<double>, rest array<double>, sign string"


def _pack(part: pa.Table) -> pa.Table:
    """The rows of a block in one row: lengths, distinct places, the place and value of each entry."""
    places, entries = (part.column(c).combine_chunks() for c in ("indices", "values"))
    counts = np.diff(places.offsets.to_numpy())
    used, at = np.unique(places.flatten().to_numpy(), return_inverse=True)
    cells = {
        "side": part.column("side").to_numpy().astype(np.int8), "counts": counts.astype(np.int64), "places": used.astype(np.int64),
        "at": at.astype(np.int64), "entries": entries.flatten().to_numpy(),
    }
    return pa.table({"block": part.column("block")[:1]} | {c: pa.array([x.tobytes()], pa.binary()) for c, x in cells.items()})


def _message(rows: list[dict]) -> pa.Table:
    kinds = {"slice": pa.int64(), "block": pa.int64(), "places": pa.binary(), "sums": pa.binary(), "known": pa.binary(), "n0": pa.list_(pa.int64()), "n1": pa.list_(pa.int64()), "norm": pa.list_(pa.float64()), "rest": pa.list_(pa.float64()), "sign": pa.string()}
    return pa.Table.from_pylist(rows, pa.schema(list(kinds.items())))


def _assign(part: pa.Table, centre: np.ndarray, norms: np.ndarray, width: int) -> pa.Table:
    """Sums and counts of the members of each centre in a block; a centre without members gives its old values."""
    row = {c: np.frombuffer(part.column(c)[0].as_py(), kind) for c, kind in (("side", np.int8), ("counts", np.int64), ("places", np.int64), ("at", np.int64), ("entries", float))}
    block, k, counts, at = part.column("block")[0].as_py(), len(norms), row["counts"], row["at"]
    full = np.flatnonzero(counts)
    first = (np.cumsum(counts) - counts)[full]
    gap = np.tile(norms, (len(counts), 1))
    for j in range(k if len(full) else 0):
        gap[full, j] -= 2 * np.add.reduceat(row["entries"] * centre[at, j], first)
    nearest = np.argmin(gap, axis=1)
    n0, n1 = (np.bincount(nearest[row["side"] == s], minlength=k) for s in (0, 1))
    owner = np.repeat(np.where(row["side"] == 0, nearest, -1), counts)
    sums = np.stack([np.bincount(at[owner == j], row["entries"][owner == j], len(row["places"])) if n0[j] else centre[:, j] for j in range(k)], axis=1)
    out = [{"slice": -1 - block, "block": -1, "n0": n0.tolist(), "n1": n1.tolist(), "sign": hashlib.sha256(nearest.tobytes()).hexdigest()}]
    slices = row["places"] // width
    cuts = np.flatnonzero(np.diff(slices, prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True) if len(slices) else ():
        out.append({"slice": int(slices[a]), "block": block, "places": row["places"][a:b].tobytes(), "sums": sums[a:b].tobytes(), "known": (n0 > 0).tobytes()})
    return _message(out)


def _merge(part: pa.Table) -> pa.Table:
    """New sums of the slice for every block, at the places it uses; of centres without members here the old values."""
    rows = part.to_pylist()
    if rows[0]["slice"] < 0:
        return part
    places = [np.frombuffer(r["places"], np.int64) for r in rows]
    known = [np.frombuffer(r["known"], bool) for r in rows]
    used = np.unique(np.concatenate(places))
    total, old = (np.zeros((len(used), len(known[0]))) for _ in range(2))
    places = [np.searchsorted(used, p) for p in places]
    for at, own, r in zip(places, known, rows, strict=True):
        sums = np.frombuffer(r["sums"]).reshape(len(at), -1)
        total[at] += np.where(own, sums, 0)
        old[at] = np.where(own, old[at], sums)
    some = np.any(known, axis=0)
    out = [{"slice": r["slice"], "block": r["block"], "places": r["places"], "sums": np.where(some, total[at], old[at]).tobytes(), "known": some.tobytes()} for at, r in zip(places, rows, strict=True)]
    norm, rest = ((x * x).sum(axis=0).tolist() for x in (np.where(some, total, 0), np.where(some, 0, old)))
    return _message([*out, {"slice": rows[0]["slice"], "block": -1, "norm": norm, "rest": rest}])


def settled_counts(rows: DataFrame, first: Sequence[np.ndarray], most: int, blocks: int) -> list[tuple[int, int, int]]:
    """(cluster, n0, n1) once no row changes its cluster, or after ``most`` moves of the centres.

    ``rows`` has ``side``, ``indices`` and ``values`` of sparse vectors; centres start at ``first`` and are
    the means of their rows of side 0. Without any, a centre stays where it is; ties go to the first centre.
    """
    spark, k = rows.sparkSession, len(first)
    slices = min(len(first[0]), max(8, blocks))
    width = -(-len(first[0]) // slices)
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
    packed = materialize(dealt.groupBy("block").applyInArrow(_pack, _PACKED), "packed")
    # dealt once, read in every round
    packed = packed.repartition(min(blocks, 2000), "block").sortWithinPartitions("block").persist(StorageLevel.DISK_ONLY)
    spread = spark.sparkContext.broadcast(np.stack(first, axis=1))
    norms = (spread.value**2).sum(axis=0)

    def begin(part: pa.Table) -> pa.Table:
        return _assign(part, spread.value[np.frombuffer(part.column("places")[0].as_py(), np.int64)], norms, width)

    def go_on(counts: np.ndarray, norms: np.ndarray):
        def run(part: pa.Table, messages: pa.Table) -> pa.Table:
            if not part.num_rows:
                return _message([])
            places = np.frombuffer(part.column("places")[0].as_py(), np.int64)
            centre = np.zeros((len(places), k))
            for p, sums, known in zip(*(messages.column(c).to_pylist() for c in ("places", "sums", "known")), strict=True):
                p, known = np.frombuffer(p, np.int64), np.frombuffer(known, bool)
                sums = np.frombuffer(sums).reshape(len(p), k)
                centre[np.searchsorted(places, p)] = np.where(counts > 0, np.where(known, sums, 0) / np.maximum(counts, 1), sums)
            return _assign(part, centre, norms, width)

        return run

    stats = [F.array(*[F.sum(F.col(c)[j]) for j in range(k)]).alias(c) for c in ("n0", "n1", "norm", "rest")]
    by_block, sign = packed.groupBy("block"), None
    try:
        step = by_block.applyInArrow(begin, _MESSAGE)
        for _ in range(most + 1):
            messages = materialize(step.groupBy("slice").applyInArrow(_merge, _MESSAGE), "centres")
            now = messages.where("block = -1").agg(*stats, F.bit_xor(F.xxhash64("slice", "sign")).alias("sign")).first()
            if now["sign"] == sign:
                break
            sign, counts = now["sign"], np.array(now["n0"])
            norm, rest = (np.array([x or 0.0 for x in now[c] or [0.0] * k]) for c in ("norm", "rest"))
            norms = np.where(counts > 0, norm / np.maximum(counts, 1) ** 2, rest)
            step = by_block.cogroup(messages.where("block >= 0").groupBy("block")).applyInArrow(go_on(counts, norms), _MESSAGE)
        else:
            warnings.warn(f"text clusters still moved after {most} rounds", stacklevel=3)
    finally:
        packed.unpersist()
        spread.unpersist()
    return [(j, a, b) for j, (a, b) in enumerate(zip(now["n0"], now["n1"], strict=True)) if a + b]
