"""Exact neighbour distances against brute force, with trees of every depth, and their shuffles."""

import numpy as np
import pytest

from vanecast.operators import knn
from vanecast.operators.knn import Nearest, Shelf, closest, distances, neighbour_distance


def brute(points, k):
    out = []
    for i, p in enumerate(points):
        d = np.sqrt(((points - p) ** 2).sum(axis=1))
        out.append(np.sort(np.delete(d, i))[:k].mean())
    return np.array(out)


def drawn(n, dims, clustered, seed=5):
    """A third of the points are copies of one."""
    rng = np.random.default_rng(seed)
    points = rng.normal(size=(n, dims)) + (rng.integers(0, 9, size=(n, 1)) * 40 if clustered else 0)
    points[: n // 3] = points[0]
    points[n // 3 : n // 3 + 4] = points[n // 3]
    return points


def frame(spark, points, kind="double"):
    return spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], f"id long, v array<{kind}>").repartition(3)


@pytest.mark.parametrize(
    ("dims", "clustered", "leaf", "shelf", "fan", "depth", "part"),
    [
        (2, True, 8, 30, 4, 10, 50_000),  # several levels above and below the shelves
        (8, False, 8, 20, 3, 10, 15),  # nodes and asks handled by several tasks
        (2, True, 5, 25, 2, 1, 50_000),  # a depth that leaves shelves in parts
        (3, False, 500, 20_000, 64, 10, 50_000),  # one shelf
    ],
)
def test_against_brute_force(spark, monkeypatch, dims, clustered, leaf, shelf, fan, depth, part):
    monkeypatch.setattr(knn, "MAX_DEPTH", depth)
    monkeypatch.setattr(knn, "PART_ROWS", part)
    points = drawn(240, dims, clustered)
    out = neighbour_distance(frame(spark, points), "id", "v", 5, leaf, shelf, fan).orderBy("id").collect()
    assert len(out) == 240
    np.testing.assert_allclose([r["distance"] for r in out], brute(points, 5), atol=1e-9)


def test_few_and_awkward_rows(spark):
    df = spark.createDataFrame([(0, [0.0]), (1, [3.0]), (2, [4.0])], "id long, v array<double>")
    out = neighbour_distance(df, "id", "v", 10).orderBy("id").collect()
    assert [r["distance"] for r in out] == [3.5, 2.0, 2.5]
    assert neighbour_distance(df.limit(1), "id", "v", 3).first()["distance"] == 0.0
    assert neighbour_distance(df.limit(0), "id", "v", 3).collect() == []
    rows = [(0, [0.0]), (1, [3.0]), (2, None), (3, []), (4, [float("nan")]), (5, [None]), (6, [float("inf")]), (1, [3.0])]
    odd = spark.createDataFrame([(*r, "x") for r in rows], "id long, v array<float>, m string")
    got = sorted((r["id"], r["distance"]) for r in neighbour_distance(odd, "id", "v", 2).collect() if r["distance"] is not None)
    assert got == [(0, 3.0), (1, 1.5), (1, 1.5)]
    assert neighbour_distance(odd, "id", "v", 2).count() == 8


def test_shelf_reads_only_leaves_within_the_bound():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 2)) + np.repeat(np.arange(10), 30)[:, None] * 50
    shelf = Shelf(v, np.ones(300, np.int64), 20)
    seen = []
    near = Nearest(300, 4)
    take = near.take
    near.take = lambda at, d, w: (seen.append(len(at)), take(at, d, w))
    shelf.search(shelf.v, near, itself=np.arange(300))
    np.testing.assert_allclose(near.d.mean(axis=1), brute(shelf.v, 4))
    assert len(shelf.spans) > 20 and sum(seen) < 300 * len(shelf.spans) / 3


def test_products_never_hide_a_nearer_row():
    """Differences far below the rounding of products: the exact ones decide."""
    rng = np.random.default_rng(2)
    for scale in (1.0, 1e-9):
        v = 1e3 + rng.normal(size=(200, 6)) * scale
        v[100:] += 50
        at, d = closest(v, v, 5, np.arange(200))
        exact = distances(v, v)
        np.fill_diagonal(exact, np.inf)
        assert (d == np.sort(exact, axis=1)[:, :5]).all()
        assert (np.take_along_axis(exact, at, axis=1) == d).all()


def test_asks_grow_slower_than_pairs(spark):
    """On clustered points four times the rows ask far less than sixteen times as much."""
    asked = []
    for n in (400, 1600):
        rng = np.random.default_rng(n)
        points = rng.uniform(0, 40, size=(n, 2))
        df = frame(spark, points, "float").selectExpr("id", "v", "1L AS m")
        placed, children = knn._grow(df, 40, 8)
        parts = placed.groupBy("shelf").agg({"shelf": "count"}).selectExpr("shelf", "CAST(ceil(`count(shelf)` / 40) AS LONG) AS parts")
        assert parts.where("parts > 1").isEmpty()
        mine = placed.selectExpr("id", "v", "shelf", "0L AS part", f"{60 / n ** 0.5}D AS bound")
        asked.append(knn._asks(mine, children, parts).count())
    assert asked[1] < 7 * asked[0]


def test_tasks_of_the_answers_follow_the_shelves(spark):
    """Forty shelves in a session of four shuffle partitions: a task reads a few shelves and their askers, not a fourth of all."""
    from pyspark.sql import functions as F

    placed = spark.range(400).select("id", F.array((F.col("id") * 7 % 40).cast("double")).alias("v"), (F.col("id") % 40).alias("shelf"), F.lit(0).cast("long").alias("part"), F.lit(1).cast("long").alias("m"))
    asked = placed.select("id", "v", F.lit(1.5).alias("bound"), F.explode(F.expr("sequence(0L, 39L)")).alias("to"), F.lit(0).cast("long").alias("p")).where("to <> shelf")
    out = knn._answers(placed, asked, 3, 100, "id long, d double, w long")
    assert out.rdd.getNumPartitions() >= 40
    # every other shelf holds ten copies of one value; those within the bound answer
    near = {v: sum(x != v and abs(x - v) < 1.5 for x in range(40)) for v in range(40)}
    got = {r["id"]: r["n"] for r in out.groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert got == {i: 3 * near[i * 7 % 40] for i in range(400)}  # three each, as many as are looked for
