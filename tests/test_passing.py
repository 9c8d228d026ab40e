"""Neighbours where bounds exclude little: shelves pass by the blocks of points instead of being asked."""

import numpy as np
import pytest

from vanecast.operators import knn
from vanecast.operators.knn import Block, Nearest, Shelf, distances, neighbour_distance


def brute(points, k):
    d = distances(points, points)
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k].mean(axis=1)


@pytest.mark.parametrize(("kind", "depth", "copies"), [("float", 10, 0), ("double", 10, 150), ("double", 1, 0)])
def test_no_answer_per_point_and_shelf(spark, monkeypatch, kind, depth, copies):
    """In 24 dimensions every point reaches every shelf; none is asked, and each point comes back once."""
    monkeypatch.setattr(knn, "MAX_DEPTH", depth)
    monkeypatch.setattr(knn, "_answers", lambda *a: pytest.fail("a shelf was asked"))
    rows, materialize = {}, knn.materialize

    def counted(df, label):
        out = materialize(df, label)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    monkeypatch.setattr(knn, "materialize", counted)
    points = np.random.default_rng(3).normal(size=(450, 24)).astype(np.float32).astype(float)
    points[:copies] = points[0]
    df = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], f"id long, v array<{kind}>").repartition(3)
    out = neighbour_distance(df, "id", "v", 5, 10, 40, 4).orderBy("id").collect()
    np.testing.assert_allclose([r["distance"] for r in out], brute(points, 5), atol=1e-9)
    assert rows["swept"] == 450 - max(0, copies - 1)
    assert max(rows.values()) <= 2 * 450


def test_text_keys_and_rows_without_a_vector(spark):
    points = np.random.default_rng(4).normal(size=(200, 20))
    rows = [(f"k{i}", p.tolist()) for i, p in enumerate(points)] + [("none", None), ("odd", [float("nan")] * 20)]
    df = spark.createDataFrame(rows, "id string, v array<double>").repartition(3)
    got = {r["id"]: r["distance"] for r in neighbour_distance(df, "id", "v", 3, 10, 30, 4).collect()}
    np.testing.assert_allclose([got[f"k{i}"] for i in range(200)], brute(points, 3), atol=1e-9)
    assert len(got) == 202 and got["none"] is None and got["odd"] is None


@pytest.mark.parametrize(("middle", "scale", "far"), [(0.0, 1.0, 3.0), (1e3, 1e-9, 50.0), (0.0, 1e-25, 1e-20), (0.0, 1e18, 1e25), (1e6, 1.0, 0.0)])
def test_single_precision_hides_no_pair(middle, scale, far):
    """Rounding far above the differences: what is picked may be everything, what is kept is exact."""
    rng = np.random.default_rng(7)
    v = middle + rng.normal(size=(600, 12)) * scale
    v[300:] += far
    weight = rng.integers(1, 3, size=600)
    near = Nearest(200, 4)
    block = Block(v[:200], near, np.arange(200) % 2)
    for a in range(200, 600, 100):
        block.offer(v[a : a + 100], weight[a : a + 100], -1)
    exact, m = distances(v[:200], v[200:]), np.broadcast_to(weight[200:], (200, 400))
    want = np.sort(np.repeat(exact.ravel(), m.ravel()).reshape(200, -1), axis=1)[:, :4]
    got = np.array([np.repeat(d, w)[:4] for d, w in zip(near.d, near.w, strict=True)])
    np.testing.assert_array_equal(got, want[block.order])


def test_points_of_a_unit_do_not_meet_again():
    v = np.random.default_rng(8).normal(size=(90, 6))
    near = Nearest(90, 3)
    block = Block(v, near, np.repeat([0, 1, 2], 30))
    block.offer(v[:30], np.ones(30, np.int64), 0)
    assert np.isinf(block.bound[:30]).all() and np.isfinite(block.bound[30:]).all()


@pytest.mark.parametrize("dims", [2, 32])
def test_a_shelf_searches_itself(dims):
    """Near leaves first where bounds exclude some, all as one block where they do not."""
    v = np.random.default_rng(dims).normal(size=(400, dims))
    shelf = Shelf(v, np.ones(400, np.int64), 30)
    near = Nearest(400, 6)
    shelf.search_itself(near)
    np.testing.assert_allclose(near.d.mean(axis=1), brute(shelf.v, 6))


def test_a_descent_holds_few_points(spark, monkeypatch):
    """A group of a descent reaches all children of its node: it is cut by its own measure, not by that of the points a task holds."""
    monkeypatch.setattr(knn, "DESCENT_ROWS", 25)
    groups = []
    one_each = knn._one_each
    monkeypatch.setattr(knn, "_one_each", lambda left, lk, right, rk, n: groups.append(n) or one_each(left, lk, right, rk, n))
    points = np.random.default_rng(5).uniform(0, 20, size=(200, 2))
    df = spark.createDataFrame([(i, p.tolist(), 1) for i, p in enumerate(points)], "id long, v array<double>, m long")
    placed, children = knn._grow(df, 40, 8)
    parts = placed.selectExpr("shelf", "1L AS parts").distinct()
    mine = placed.selectExpr("id", "v", "shelf", "0L AS part", "1D AS bound")
    assert knn._asks(mine, children, parts).count() > 0
    assert groups[0] == 8
