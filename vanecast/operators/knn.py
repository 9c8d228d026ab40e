"""Mean distance to the k nearest neighbours, exact, by a tree of pivots.

1. Equal vectors are merged into one point with a multiplicity.
2. A tree is grown level by level: a node with too many points hands them to the nearest of
   a few of its own points, its pivots, down to *shelves*, nodes small enough for one task,
   which deals its points to leaves alike. Each node knows its pivot and radius, and since
   shelves keep their size while the table grows, radii shrink.
3. Every shelf finds the neighbours of its points among its points: a bound of each k-th distance.
4. From the root on, a point goes down to the nodes that its bound cannot exclude by the
   triangle inequality, and asks each other shelf it reaches once. A shelf answers only
   distances below the bound.
5. The answers and a point's own list are cut to the k smallest.

A point travels once per shelf it asks, never once per block of a few points or with a
copy of the other side. How much step 4 excludes depends on the data; the result does not.

Where bounds exclude little, as in high dimensions, a point would ask almost every shelf.
Then the points of a few shelves form a *block* that stays in one task, and the shelves which
any of them reaches stream past it. The task holds the block and a few sheets of points, and
ends with one row per point instead of k answers per point and shelf. Which way moves fewer
points is counted, per shelf, before either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vanecast.session import materialize

LEAF_ROWS = 500
SHELF_ROWS = 20_000
FAN = 64  # pivots of a node
PART_ROWS = 50_000  # points of a node handled by one task
DESCENT_ROWS = 4_000  # points of a node that go down together, as each may reach all its children
SHEET_BYTES = 4_096  # vectors that stream as one row, so that ten thousand rows are a batch of 40 MB
ASK_ROWS, PASS_ROWS = 1_024, 2_048  # rows on both sides of a product
MAX_DEPTH = 10
_CELLS = 4_000_000  # numbers of a temporary array


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
    return np.asarray(flat.flatten(), dtype=float).reshape(len(flat), -1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairwise Euclidean distances, from differences so that close points stay exact."""
    out = np.empty((len(a), len(b)))
    step = max(1, _CELLS // max(1, b.size))
    for i in range(0, len(a), step):
        out[i : i + step] = np.sqrt(((a[i : i + step, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return out


class Nearest:
    """The k smallest distances of each row so far with their multiplicities, in order of distance."""

    def __init__(self, rows: int, k: int):
        self.k = k
        self.d = np.full((rows, k), np.inf)
        self.w = np.zeros((rows, k), np.int64)

    @property
    def bound(self) -> np.ndarray:
        """Distance of the k-th neighbour counted with multiplicity; infinite if there are fewer."""
        return self.bound_at(slice(None))

    def bound_at(self, at: np.ndarray | slice) -> np.ndarray:
        d, reached = self.d[at], np.cumsum(self.w[at], axis=1) >= self.k
        return np.where(reached[:, -1], d[np.arange(len(d)), reached.argmax(axis=1)], np.inf)

    def take(self, at: np.ndarray, d: np.ndarray, weight: np.ndarray) -> None:
        """Offer rows ``at`` distances and their multiplicities; infinite ones do not count."""
        both = np.concatenate([self.d[at], d], axis=1)
        weights = np.concatenate([self.w[at], np.where(np.isinf(d), 0, np.minimum(weight, self.k))], axis=1)
        order = np.argsort(both, axis=1, kind="stable")[:, : self.k]
        self.d[at] = np.take_along_axis(both, order, axis=1)
        self.w[at] = np.take_along_axis(weights, order, axis=1)


def _slack(bound: np.ndarray) -> np.ndarray:
    return bound * (1 + 1e-9) + 1e-12


def closest(q: np.ndarray, v: np.ndarray, k: int, itself: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest rows of ``v`` for each row of ``q`` and their exact distances, infinite where there are fewer.

    Products of matrices pick a few rows more than asked for, whose distances are then taken
    from differences; a row for which the products' rounding could hide a nearer one is done
    again with all differences. ``itself`` is the place of a row of ``q`` in ``v``, or -1.
    """
    more = k + 8
    if len(v) <= 2 * more:
        d = distances(q, v)
        if itself is not None:
            d[itself[:, None] == np.arange(len(v))] = np.inf
        at = np.argsort(d, axis=1, kind="stable")[:, :k]
        return at, np.take_along_axis(d, at, axis=1)
    center = v.mean(axis=0)
    a, b = q - center, v - center
    a2, b2 = (a * a).sum(axis=1), (b * b).sum(axis=1)
    rough = a2[:, None] + b2[None, :] - 2 * (a @ b.T)
    if itself is not None:
        own = np.flatnonzero(itself >= 0)
        rough[own, itself[own]] = np.inf
    at = np.argpartition(rough, more - 1, axis=1)[:, :more]
    d = np.sqrt(((q[:, None, :] - v[at]) ** 2).sum(axis=2))
    if itself is not None:
        d[at == itself[:, None]] = np.inf
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    reach = np.take_along_axis(rough, at, axis=1).max(axis=1)  # no row left out is nearer than this
    at, d = np.take_along_axis(at, order, axis=1), np.take_along_axis(d, order, axis=1)
    error = 8 * np.finfo(float).eps * (q.shape[1] + 4) * (a2 + b2.max())
    unsure = np.flatnonzero(~(reach - error > d[:, -1] ** 2))
    if len(unsure):
        full = distances(q[unsure], v)
        if itself is not None:
            full[itself[unsure][:, None] == np.arange(len(v))] = np.inf
        at[unsure] = np.argsort(full, axis=1, kind="stable")[:, :k]
        d[unsure] = np.take_along_axis(full, at[unsure], axis=1)
    return at, d


class Shelf:
    """Points of one shelf, dealt to leaves around some of them, and the search among them."""

    def __init__(self, v: np.ndarray, weight: np.ndarray, leaf_rows: int):
        wanted = -(-2 * len(v) // leaf_rows) if len(v) > leaf_rows else 1
        pivots = v[np.random.default_rng(len(v)).choice(len(v), wanted, replace=False)]
        leaf = np.concatenate([closest(v[i : i + 1000], pivots, 1)[0][:, 0] for i in range(0, len(v), 1000)])
        order = np.argsort(leaf, kind="stable")
        self.order, self.v, self.weight = order, v[order], weight[order]
        cuts = np.flatnonzero(np.diff(leaf[order], prepend=-1, append=-1))
        self.spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        self.centers = np.array([self.v[a:b].mean(axis=0) for a, b in self.spans])
        self.radii = np.array([distances(self.v[a:b], c[None])[:, 0].max() for (a, b), c in zip(self.spans, self.centers, strict=True)])

    def search_itself(self, near: Nearest) -> None:
        """Offer each point the others: first those of its leaf, then leaf by leaf or, where bounds exclude few leaves, as a block."""
        leaf = np.repeat(np.arange(len(self.spans)), [b - a for a, b in self.spans])
        for a, b in self.spans:
            step = max(1, _CELLS // max(b - a, (near.k + 8) * self.v.shape[1]))
            for i in range(a, b, step):
                rows = np.arange(i, min(i + step, b))
                at, d = closest(self.v[rows], self.v[a:b], near.k, rows - a)
                near.take(rows, d, self.weight[a:b][at])
        low = distances(self.v, self.centers) - self.radii
        if (low <= _slack(near.bound)[:, None]).mean() <= 0.5:
            self.search(self.v, near, searched=leaf)
            return
        block = Block(self.v, near, leaf)  # the points are in order of their leaves already
        for i, (a, b) in enumerate(self.spans):
            block.offer(self.v[a:b], self.weight[a:b], i)

    def search(self, q: np.ndarray, near: Nearest, itself: np.ndarray | None = None, searched: np.ndarray | None = None) -> None:
        """Offer each row of ``q`` the points of all leaves its bound cannot exclude, nearest leaves first, but not of the one it has searched."""
        low = np.maximum(distances(q, self.centers) - self.radii, 0)
        if searched is not None:
            low[np.arange(len(q)), searched] = np.inf
        turn = np.argsort(low, axis=1, kind="stable")
        for j in range(len(self.spans)):
            leaf = turn[:, j]
            at_turn = low[np.arange(len(q)), leaf]
            open_ = (at_turn <= _slack(near.bound)) & (at_turn < np.inf)
            if not open_.any():  # leaves to come are farther still
                break
            for at_leaf in np.unique(leaf[open_]):
                a, b = self.spans[at_leaf]
                rows = np.flatnonzero(open_ & (leaf == at_leaf))
                step = max(1, _CELLS // max(b - a, (near.k + 8) * q.shape[1]))
                for i in range(0, len(rows), step):
                    part = rows[i : i + step]
                    own = None if itself is None else np.where((itself[part] >= a) & (itself[part] < b), itself[part] - a, -1)
                    at, d = closest(q[part], self.v[a:b], near.k, own)
                    near.take(part, d, self.weight[a:b][at])


class Block:
    """Points that stay in their task while all points they may reach pass by.

    ``unit`` numbers the shelf that a point has searched already.
    """

    def __init__(self, v: np.ndarray, near: Nearest, unit: np.ndarray):
        order = np.argsort(unit, kind="stable")
        self.order, self.v, self.unit = order, v[order], unit[order]
        self.near = near
        near.d, near.w = near.d[order], near.w[order]
        self.bound = near.bound
        self.center = self.v.mean(axis=0)
        a = self.v - self.center
        self.scale = float(np.abs(a).max()) or 1.0
        a /= self.scale
        self.a2 = (a * a).sum(axis=1)
        # a product with (b, |b|^2) is |b|^2 - 2 ab
        self.left = np.concatenate([-2 * a, np.ones((len(a), 1))], axis=1).astype(np.float32)

    def offer(self, v: np.ndarray, weight: np.ndarray, unit: int) -> None:
        """Points of one shelf pass by; those of the same shelf know them."""
        center = v.mean(axis=0)
        low = distances(self.v, center[None])[:, 0] - distances(v, center[None]).max()
        rows = np.flatnonzero((self.unit != unit) & (low <= _slack(self.bound)))
        if not len(rows):
            return
        b = (v - self.center) / self.scale
        b2 = (b * b).sum(axis=1)
        if not b2.max() < 1e30:  # too far for single precision
            for i in range(0, len(rows), ASK_ROWS):
                self._whole(rows[i : i + ASK_ROWS], v, weight)
            return
        right = np.concatenate([b, b2[:, None]], axis=1).astype(np.float32).T
        # single precision only picks pairs; its rounding is added to the bound, so that none is lost
        terms = v.shape[1] + 4
        error = terms * (8 * float(np.finfo(np.float32).eps) * (self.a2[rows] + b2.max()) + 1e-36)
        with np.errstate(over="ignore"):
            limit = ((_slack(self.bound[rows]) / self.scale) ** 2 - self.a2[rows] + error).astype(np.float32)
        for i in range(0, len(rows), ASK_ROWS):
            part = rows[i : i + ASK_ROWS]
            picked = np.flatnonzero((self.left[part] @ right) < limit[i : i + ASK_ROWS, None])
            if len(picked) > len(part) * len(v) // 8:
                self._whole(part, v, weight)
            elif len(picked):
                self._some(part, *np.divmod(picked, len(v)), v, weight)

    def _whole(self, part: np.ndarray, v: np.ndarray, weight: np.ndarray) -> None:
        at, d = closest(self.v[part], v, self.near.k)
        self._take(part, d, weight[at])

    def _some(self, part: np.ndarray, row: np.ndarray, col: np.ndarray, v: np.ndarray, weight: np.ndarray) -> None:
        """Exact distances of the picked pairs, in order of their rows."""
        step = max(1, _CELLS // v.shape[1])
        d = np.concatenate([
            np.sqrt(((self.v[part[row[i : i + step]]] - v[col[i : i + step]]) ** 2).sum(axis=1)) for i in range(0, len(row), step)
        ])
        good = d < self.bound[part[row]]
        row, col, d = row[good], col[good], d[good]
        if not len(row):
            return
        lead = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
        n = np.diff(np.append(lead, len(row)))
        line = np.repeat(np.arange(len(lead)), n)
        place = np.arange(len(row)) - np.repeat(lead, n)
        wide, counted = np.full((len(lead), n.max()), np.inf), np.zeros((len(lead), n.max()), np.int64)
        wide[line, place], counted[line, place] = d, weight[col]
        self._take(part[row[lead]], wide, counted)

    def _take(self, rows: np.ndarray, d: np.ndarray, weight: np.ndarray) -> None:
        self.near.take(rows, d, weight)
        self.bound[rows] = self.near.bound_at(rows)


def _grow(points: DataFrame, shelf_rows: int, fan: int) -> tuple[DataFrame, DataFrame | None]:
    """Points with their ``shelf``; the tree above as (parent, node, pivot, radius, is_shelf) from the root, node 0, down to the shelves."""
    id_type, v_type = dict(points.dtypes)["id"], dict(points.dtypes)["v"]
    n = F.col("n")
    state, tree = points.withColumn("shelf", F.lit(0).cast("long")), None

    def split(left: pa.Table, right: pa.Table) -> pa.Table:
        out = left.select(["id", "v", "m"])
        if not left.num_rows or not right.num_rows:
            return out.slice(0, 0).append_column("shelf", pa.array([], pa.int64())).append_column("r", pa.array([], pa.float64()))
        pivots, v = _vectors(right.column("pivot")), _vectors(left.column("v"))
        near = [closest(v[i : i + 1000], pivots, 1) for i in range(0, len(v), 1000)]
        at, r = (np.concatenate([x[j][:, 0] for x in near]) for j in (0, 1))
        return out.append_column("shelf", pa.array(right.column("child").to_numpy()[at])).append_column("r", pa.array(r))

    for _ in range(MAX_DEPTH):
        big = state.groupBy("shelf").agg(F.count(F.lit(1)).alias("n")).where(n > shelf_rows)
        big = big.select(F.col("shelf").alias("node"), F.least(F.lit(fan), F.ceil(2 * n / shelf_rows)).alias("fan"), F.ceil(n / PART_ROWS).alias("parts"))
        big = materialize(big, "nodes")
        if big.isEmpty():
            break
        held = state.join(big, F.col("shelf") == F.col("node"), "left")
        inside = held.where(F.col("node").isNotNull())
        place = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("id"), "id"))
        chosen = inside.select("node", "id", "v", "fan", "parts").withColumn("place", place).where(F.col("place") <= fan).where("place <= fan")
        chosen = materialize(chosen.select("node", "v", "parts", (F.col("node") * fan + F.col("place")).alias("child")), "pivots")
        pivots = chosen.select(F.col("node").alias("of"), F.col("v").alias("pivot"), "child", F.explode(F.expr("sequence(0L, parts - 1)")).alias("p"))
        dealt = inside.select("id", "v", "m", "node", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))
        moved = dealt.groupBy("node", "part").cogroup(pivots.groupBy("of", "p")).applyInArrow(split, f"id {id_type}, v {v_type}, m long, shelf long, r double")
        moved = materialize(moved, "moved")
        radii = moved.groupBy(F.col("shelf").alias("child")).agg(F.max("r").alias("radius"), F.count(F.lit(1)).alias("n"))
        level = radii.join(chosen.select("node", "child", F.col("v").alias("pivot")), "child")
        level = level.select(F.col("node").alias("parent"), F.col("child").alias("node"), "pivot", "radius", (n <= shelf_rows).alias("is_shelf"))
        tree = level if tree is None else tree.unionByName(level)
        state = materialize(held.where(F.col("node").isNull()).select("id", "v", "m", "shelf").unionByName(moved.select("id", "v", "m", "shelf")), "state")
    return state, tree


def neighbour_distance(
    df: DataFrame, key: str, vector: str, k: int, leaf_rows: int = LEAF_ROWS, shelf_rows: int = SHELF_ROWS, fan: int = FAN
) -> DataFrame:
    """Adds ``distance``: mean distance to the ``k`` nearest other rows (all of them if fewer).

    Rows whose vector is NULL, empty or holds a NULL or non-finite number have no distance
    (NULL) and are nobody's neighbour. All other vectors have one length.
    """
    x = F.col(vector)
    finite = F.forall(x, lambda e: F.coalesce(F.abs(e.cast("double")) < F.lit(float("inf")), F.lit(False)))
    rows = df.withColumn("__v", F.when((F.size(x) > 0) & finite, x))
    usable = rows.where(F.col("__v").isNotNull())
    points = materialize(usable.groupBy(F.col("__v").alias("v")).agg(F.min(key).alias("id"), F.count(F.lit(1)).alias("m")), "points")
    size = points.agg(F.count(F.lit(1)), F.sum("m")).first()
    total = size[1] or 0
    k = min(k, total - 1)
    if k <= 0:
        return rows.withColumn("distance", F.when(F.col("__v").isNotNull(), 0.0)).drop("__v")
    id_type, v_type = dict(points.dtypes)["id"], dict(points.dtypes)["v"]
    if size[0] > shelf_rows:
        shelves, children = _grow(points, shelf_rows, fan)
        # a node that no depth could make small is a shelf in parts
        parts = materialize(shelves.groupBy("shelf").agg(F.ceil(F.count(F.lit(1)) / shelf_rows).alias("parts")), "parts")
        placed = shelves.join(parts, "shelf").withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")))
    else:
        placed, children, parts = points.withColumns({"shelf": F.lit(0).cast("long"), "part": F.lit(0).cast("long")}), None, None

    def own(part: pa.Table) -> pa.Table:
        v, weight = _vectors(part.column("v")), part.column("m").to_numpy()
        shelf = Shelf(v, weight, leaf_rows)
        near = Nearest(len(v), k)
        # a point's own copies are neighbours at distance 0
        near.take(np.arange(len(v)), np.where(shelf.weight > 1, 0.0, np.inf)[:, None], shelf.weight[:, None] - 1)
        shelf.search_itself(near)
        out = part.select(["id", "v", "m", "shelf", "part"]).take(pa.array(shelf.order))
        out = out.append_column("bound", pa.array(near.bound))
        out = out.append_column("d", pa.array(list(np.where(near.w > 0, near.d, 0.0)), pa.list_(pa.float64())))
        return out.append_column("w", pa.array(list(near.w), pa.list_(pa.int64())))

    mine = placed.groupBy("shelf", "part").applyInArrow(own, f"id {id_type}, v {v_type}, m long, shelf long, part long, bound double, d array<double>, w array<long>")
    mine = materialize(mine, "own")
    passing = None if parts is None else _passing(mine, children, parts)
    lists = mine if passing is None else _sweep(mine, *passing, k)
    lists = lists.select("id", F.explode(F.arrays_zip("d", "w")).alias("x")).select("id", "x.d", "x.w")
    if parts is not None and passing is None:
        lists = lists.unionByName(_answers(placed, _asks(mine, children, parts), k, leaf_rows, f"id {id_type}, d double, w long"))
    lists = lists.where("w > 0")
    nearest = Window.partitionBy("id").orderBy("d")
    first = lists.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k)
    before = F.sum("w").over(nearest.rowsBetween(Window.unboundedPreceding, 0)) - F.col("w")
    used = F.greatest(F.least(F.col("w"), k - before), F.lit(0))
    result = first.withColumn("used", used).groupBy("id").agg((F.sum(F.col("used") * F.col("d")) / k).alias("distance"))
    by_vector = points.join(result, "id").select(F.col("v").alias("__v"), "distance")
    return rows.join(by_vector, "__v", "left").select(*df.columns, "distance")


def _one_each(left: DataFrame, left_keys: list[str], right: DataFrame, right_keys: list[str], groups: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a cogroup in as many partitions as there are groups, so that no task reads more as the groups become more."""
    n = max(groups, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return left.repartition(n, *left_keys), right.repartition(n, *right_keys)


def _passing(mine: DataFrame, children: DataFrame | None, parts: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """Blocks as (shelf, part, block) and the blocks each shelf must pass as (shelf, blocks), or None where asking moves fewer points."""
    tree: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    # a row per shelf and node above it: a ten-thousandth of the points
    by_parent: dict[int, list] = {}
    for r in [] if children is None else children.orderBy("parent", "node").collect():
        by_parent.setdefault(r["parent"], []).append(r)
    for parent, kids in by_parent.items():
        tree[parent] = np.array([r["node"] for r in kids]), np.array([r["pivot"] for r in kids], float), np.array([r["radius"] for r in kids])
    split = {r["shelf"]: r["parts"] for r in parts.where("parts > 1").collect()}

    def reach(part: pa.Table) -> pa.Table:
        v, bound = _vectors(part.column("v")), _slack(part.column("bound").to_numpy())
        own = part.column("shelf")[0].as_py()
        found = {own: len(v) * (split[own] - 1)} if own in split else {}  # the other parts of its shelf
        open_ = [(0, np.arange(len(v)))] if tree else []
        while open_:
            node, rows = open_.pop()
            names, pivots, radii = tree[node]
            low = distances(v[rows], pivots) - radii <= bound[rows, None]
            for j, child in enumerate(names.tolist()):
                some = rows[low[:, j]]
                if child in tree and len(some):
                    open_.append((child, some))
                elif child != own and len(some):
                    found[child] = len(some) * split.get(child, 1)
        n = len(found)
        first = [part.column(c)[:1].combine_chunks() for c in ("shelf", "part")]
        same = [pa.concat_arrays([x] * n) if n else pa.array([], pa.int64()) for x in first]
        return pa.table({"shelf": same[0], "part": same[1], "to": pa.array(list(found), pa.int64()), "asks": pa.array(list(found.values()), pa.int64())})

    spark = mine.sparkSession
    units = [tuple(r) for r in mine.groupBy("shelf", "part").count().orderBy("shelf", "part").collect()]
    total = sum(n for *_, n in units)
    # two blocks or more for every core, and none larger than one task takes
    most = min(PART_ROWS, max(1, total // (2 * spark.sparkContext.defaultParallelism)))
    numbered, block, held = [], 0, 0
    for shelf, part, n in units:
        if held and held + n > most:
            block, held = block + 1, 0
        numbered.append((shelf, part, block))
        held += n
    blocks = materialize(spark.createDataFrame(numbered, "shelf long, part long, block int"), "blocks")
    reached = mine.select("shelf", "part", "v", "bound").groupBy("shelf", "part").applyInArrow(reach, "shelf long, part long, to long, asks long")
    pairs = reached.join(blocks, ["shelf", "part"]).groupBy("block", F.col("to").alias("shelf")).agg(F.sum("asks").alias("asks"))
    pairs = materialize(pairs, "reached")
    sizes = mine.groupBy("shelf").agg(F.count(F.lit(1)).alias("n"))
    moved, asks = pairs.join(sizes, "shelf").agg(F.sum("n"), F.sum("asks")).first()
    # an ask travels down the tree, to its shelf and back with k answers
    if not asks or moved > 2 * asks:
        return None
    return blocks, pairs.groupBy("shelf").agg(F.collect_set("block").alias("blocks"))


def _sweep(mine: DataFrame, blocks: DataFrame, passed: DataFrame, k: int) -> DataFrame:
    """(id, d, w) with the k smallest distances of every point: a block holds its points and their own lists while the shelves it reaches pass by."""
    id_type = mine.schema["id"].dataType
    sheet = "shelf long, part long, rows int, short boolean, v binary, m binary"
    kept = f"ids array<{id_type.simpleString()}>, d binary, w binary"

    def pack(part: pa.Table) -> pa.Table:
        v, d, w = (_vectors(part.column(c)) for c in ("v", "d", "w"))
        with np.errstate(over="ignore"):
            single = v.astype(np.float32)
        short = bool((single == v).all())
        v = single if short else v
        rows = max(1, SHEET_BYTES // (v.shape[1] * v.itemsize))
        cuts = range(0, len(v), rows)
        out = {c: pa.concat_arrays([part.column(c)[:1].combine_chunks()] * len(cuts)) for c in ("shelf", "part")}
        out["rows"] = pa.array([min(rows, len(v) - i) for i in cuts], pa.int32())
        out["short"] = pa.array([short] * len(cuts))
        arrays = {"v": v, "m": part.column("m").to_numpy(), "ids": None, "d": d, "w": w.astype(np.int64)}
        ids = pa.concat_arrays(part.column("id").chunks)
        for name, x in arrays.items():
            if x is None:
                out[name] = pa.ListArray.from_arrays(pa.array([*cuts, len(v)], pa.int32()), ids)
            else:
                out[name] = pa.array([x[i : i + rows].tobytes() for i in cuts], pa.binary())
        return pa.table(out)

    def finished(block: Block, ids: list[pa.Array]) -> pa.RecordBatch:
        near = block.near
        d, w = (pa.array(list(x), pa.list_(t)) for x, t in ((np.where(near.w > 0, near.d, 0.0), pa.float64()), (near.w, pa.int64())))
        return pa.RecordBatch.from_arrays([pa.concat_arrays(ids).take(pa.array(block.order)), d, w], names=["id", "d", "w"])

    def begun(sheets: list[tuple]) -> Block:
        near = Nearest(0, k)
        near.d, near.w = (np.concatenate([np.frombuffer(x[c], t) for x in sheets]).reshape(-1, k) for c, t in ((2, float), (3, np.int64)))
        near.d = np.where(near.w > 0, near.d, np.inf)
        units = {u: i for i, u in enumerate(dict.fromkeys(x[0] for x in sheets))}
        unit = np.concatenate([np.full(len(x[1]), units[x[0]]) for x in sheets])
        block = Block(np.concatenate([x[1] for x in sheets]), near, unit)
        block.units = units
        return block

    def sweep(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, block, own, ids = None, None, [], []
        unit, vectors, weights, held = None, [], [], 0

        def offer() -> None:
            nonlocal vectors, weights, held
            if held:
                block.offer(np.concatenate(vectors), np.concatenate(weights), block.units.get(unit, -1))
            vectors, weights, held = [], [], 0

        for batch in stream:
            names = ("block", "passes", "shelf", "part", "rows", "short", "v", "m", "d", "w")
            columns = [batch.column(c).to_pylist() for c in names]
            for i, (of, passes, shelf, part, rows, short, v, m, d, w) in enumerate(zip(*columns, strict=True)):
                if of != number:
                    if number is not None:
                        offer()
                        yield finished(block or begun(own), ids)
                    number, block, own, ids = of, None, [], []
                v = np.frombuffer(v, np.float32 if short else float).reshape(rows, -1)
                if not passes:
                    own.append(((shelf, part), v.astype(float), d, w))
                    ids.append(batch.column("ids")[i].values)
                    continue
                if block is None:
                    block, own = begun(own), []
                if (shelf, part) != unit or held >= PASS_ROWS:
                    offer()
                    unit = (shelf, part)
                vectors.append(v.astype(float))
                weights.append(np.frombuffer(m, np.int64))
                held += rows
        if number is not None:
            offer()
            yield finished(block or begun(own), ids)

    sheets = mine.select("id", "v", "m", "shelf", "part", "d", "w").groupBy("shelf", "part").applyInArrow(pack, f"{sheet}, {kept}")
    sheets = materialize(sheets, "sheets")
    askers = sheets.join(F.broadcast(blocks), ["shelf", "part"]).withColumn("passes", F.lit(False))  # a row per shelf
    passing = sheets.select("shelf", "part", "rows", "short", "v", "m").join(passed, "shelf")
    passing = passing.withColumn("block", F.explode("blocks")).drop("blocks").withColumn("passes", F.lit(True))
    both = askers.unionByName(passing, allowMissingColumns=True)
    count = blocks.agg(F.max("block")).first()[0] + 1
    dealt = both.repartitionById(count, F.col("block")).sortWithinPartitions("block", "passes", "shelf", "part")
    swept = dealt.mapInArrow(sweep, f"id {id_type.simpleString()}, d array<double>, w array<long>")
    return materialize(swept, "swept")


def _asks(mine: DataFrame, children: DataFrame | None, parts: DataFrame) -> DataFrame:
    """(id, v, bound, to, part): the other shelves that may hold a closer point than the bound of a point."""
    asks = None
    in_parts = mine.select("id", "v", "bound", F.col("shelf").alias("to"), F.col("part").alias("own")).join(
        parts.where("parts > 1").withColumnRenamed("shelf", "to"), "to"
    )
    siblings = in_parts.withColumn("p", F.explode(F.expr("sequence(0L, parts - 1)"))).where("p <> own").select("id", "v", "bound", "to", "p")
    if children is None:
        return siblings
    id_type, v_type = dict(mine.dtypes)["id"], dict(mine.dtypes)["v"]
    schema = f"id {id_type}, v {v_type}, bound double, own long, node long, is_shelf boolean"

    def descend(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            out = left.select(["id", "v", "bound", "own"]).slice(0, 0)
            return out.append_column("node", pa.array([], pa.int64())).append_column("is_shelf", pa.array([], pa.bool_()))
        d = distances(_vectors(left.column("v")), _vectors(right.column("pivot"))) - right.column("radius").to_numpy()
        at, child = np.nonzero(d <= _slack(left.column("bound").to_numpy())[:, None])
        out = left.select(["id", "v", "bound", "own"]).take(pa.array(at))
        out = out.append_column("node", pa.array(right.column("node").to_numpy()[child]))
        return out.append_column("is_shelf", pa.array(right.column("is_shelf").to_numpy()[child]))

    children = materialize(children, "children")
    front = mine.select("id", "v", "bound", F.col("shelf").alias("own"), F.lit(0).cast("long").alias("node"))
    inner = children.select(F.col("parent").alias("node")).distinct()
    while True:
        counts = front.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / min(PART_ROWS, DESCENT_ROWS)).alias("copies")).join(inner, "node")
        counts = materialize(counts, "front")
        if counts.isEmpty():
            break
        dealt = front.join(counts, "node").withColumn("p", F.pmod(F.xxhash64("id"), F.col("copies"))).drop("copies")
        spread = counts.select(F.col("node").alias("parent"), "copies").join(children, "parent").withColumn("q", F.explode(F.expr("sequence(0L, copies - 1)")))
        dealt, spread = _one_each(dealt, ["node", "p"], spread.drop("copies"), ["parent", "q"], counts.agg(F.sum("copies")).first()[0])
        found = dealt.groupBy("node", "p").cogroup(spread.groupBy("parent", "q")).applyInArrow(descend, schema)
        found = materialize(found, "descent")
        ask = found.where("is_shelf AND node <> own").select("id", "v", "bound", F.col("node").alias("to"), F.lit(0).cast("long").alias("p"))
        asks = ask if asks is None else asks.unionByName(ask)
        # a node that is no shelf and has no children is a shelf in parts
        dead = found.where("NOT is_shelf").join(inner, "node", "left_anti").where("node <> own").withColumnRenamed("node", "to")
        dead = dead.join(parts.withColumnRenamed("shelf", "to"), "to").withColumn("p", F.explode(F.expr("sequence(0L, parts - 1)")))
        asks = asks.unionByName(dead.select("id", "v", "bound", "to", "p"))
        front = found.where("NOT is_shelf").drop("is_shelf")
    return siblings if asks is None else asks.unionByName(siblings)


def _answers(placed: DataFrame, asked: DataFrame, k: int, leaf_rows: int, schema: str) -> DataFrame:
    """(id, d, w): at most k distances below its bound for each point and shelf it asked."""
    asked = materialize(asked, "asked")
    counts = materialize(asked.groupBy("to", "p").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).alias("copies")), "wanted")
    dealt = asked.join(counts, ["to", "p"]).withColumn("c", F.pmod(F.xxhash64("id"), F.col("copies"))).drop("copies")
    wanted = counts.withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    shelves = placed.select(F.col("shelf").alias("to"), F.col("part").alias("p"), F.col("v").alias("v2"), F.col("m").alias("m2"))
    spread = shelves.join(wanted.select("to", "p", "copy"), ["to", "p"])
    spread = spread.select(F.col("to").alias("s"), F.col("p").alias("t"), F.col("copy").alias("u"), "v2", "m2")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return left.select(["id"]).slice(0, 0).append_column("d", pa.array([], pa.float64())).append_column("w", pa.array([], pa.int64()))
        shelf = Shelf(_vectors(right.column("v2")), right.column("m2").to_numpy(), leaf_rows)
        bound = left.column("bound").to_numpy()
        near = Nearest(left.num_rows, k)
        near.d[:, -1], near.w[:, -1] = bound, np.where(np.isinf(bound), 0, k)  # nothing beyond the bound is wanted
        shelf.search(_vectors(left.column("v")), near)
        at, place = np.nonzero((near.w > 0) & (near.d < bound[:, None]))
        out = left.select(["id"]).take(pa.array(at))
        return out.append_column("d", pa.array(near.d[at, place])).append_column("w", pa.array(near.w[at, place]))

    dealt, spread = _one_each(dealt, ["to", "p", "c"], spread, ["s", "t", "u"], counts.agg(F.sum("copies")).first()[0] or 0)
    return dealt.groupBy("to", "p", "c").cogroup(spread.groupBy("s", "t", "u")).applyInArrow(answer, schema)
