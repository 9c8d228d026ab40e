"""Embedding near-dedup against all cosines."""

import numpy as np
import pytest

from vanecast.llm import embeddings as E
from vanecast.llm import flatgraph as G


def brute(rows, threshold=0.95):
    ok = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = np.zeros(len(rows), int)
    up = {rows[k][0]: rows[k][0] for k in ok}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in ok:
        for b in ok:
            va, vb = rows[a][1], rows[b][1]
            if a < b and len(va) == len(vb):
                x, y = E.unit(np.array([va, vb], float))
                if x @ y >= threshold or va == vb:
                    links[a] += 1
                    links[b] += 1
                    p, q = find(rows[a][0]), find(rows[b][0])
                    up[max(p, q)] = min(p, q)
    return [(i, int(links[k]), find(i) if k in ok else i, (find(i) if k in ok else i) == i) for k, (i, _) in enumerate(rows)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(0)
    f = lambda v: [float(x) for x in np.float32(v)]
    out = [(k, f(rng.normal(size=16))) for k in range(150)]
    middle = rng.normal(size=16)
    out += [(200 + k, f(middle + 0.12 * np.linalg.norm(middle) / 4 * rng.normal(size=16))) for k in range(90)]  # near copies
    out += [(300 + k, out[3][1]) for k in range(70)]  # copies
    out += [(400 + k, f(np.array(out[k][1]) * 3 + 0.05 * rng.normal(size=16))) for k in range(0, 60, 2)]
    out += [(500, None), (501, [0.0] * 16), (502, [float("nan")] + [1.0] * 15), (503, [float("inf")] + [1.0] * 15), (504, [None] + [1.0] * 15)]
    out += [(505, []), (506, [1.0, 2.0]), (507, [1.0, 2.0]), (None, out[0][1]), (508, f(np.array(out[0][1]) * 1e30)), (509, f(np.array(out[0][1]) * 1e-30))]
    return out


def test_links(spark, rows, monkeypatch):
    frame = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<float>, rep int, shard int").repartition(3)
    want = sorted(brute(rows), key=str)
    for part in (E.PART_ROWS, 40):  # one graph per shard, several
        monkeypatch.setattr(E, "PART_ROWS", part)
        monkeypatch.setattr(E, "MIN_SHARDS", 6)
        got = E.near_vectors(frame).collect()
        found = sum(r.n_links for r in got)
        true = sum(w[1] for w in want)
        assert 0.95 * true <= found <= true
        by_id = {r.vec_id: r for r in got}
        assert len(got) == len(rows)
        for i, n, c, _ in want:
            if i is not None:
                assert by_id[i].n_links <= n and by_id[i].kept == (by_id[i].component_id == i)
                if n == 0 or i in range(300, 370):
                    assert (by_id[i].n_links, by_id[i].component_id) == (n, c)
        same = sum(by_id[i].component_id == c for i, _, c, _ in want if i is not None)
        assert same >= 0.98 * len(want)
    assert E.near_vectors(frame.limit(0)).collect() == []


def test_graph_reaches_all_and_finds_the_range():
    rng = np.random.default_rng(2)
    tight = E.unit(rng.normal(size=(1, 24)) + 0.08 * rng.normal(size=(300, 24)))
    vectors = np.concatenate([E.unit(rng.normal(size=(900, 24))), tight]).astype(np.float32)
    graph = G.build(vectors)
    start = G.medoids(vectors)
    assert G.reached(graph, start).all()
    hits = np.concatenate([h for _, h in G.in_range(vectors, graph, start, vectors, 0.95)])
    true = vectors @ vectors.T >= 0.95
    assert not (hits & ~(vectors @ vectors.T >= 0.95 - 1e-5)).any()
    assert (hits & true).sum() >= 0.97 * true.sum()
    for n in (0, 1, 2, 5):
        assert len(G.build(vectors[:n])) == n


def test_audit_notices_missing_links(spark, rows):
    good = [(k, 1, E.unit(np.array([v]))[0].tobytes()) for k, (i, v) in enumerate(rows[:240])]
    classes = spark.createDataFrame(good, "rep long, size long, vector binary")
    none = spark.createDataFrame([], "rep long, linked long, star long")
    assert E.measured_recall(classes, none, 240, 16, 0.95) == 0.0
    full = E._links(classes, 240, 16, 0.95, 2, G.BEAM)
    assert E.measured_recall(classes, full, 240, 16, 0.95) >= 0.95


def test_components(spark):
    from vanecast.llm.graph import components

    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1100)] + [(5, 5), (1050, 1000)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        up[max(p, q)] = min(p, q)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in up}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_audit_is_not_masked_by_a_dense_group(spark):
    rng = np.random.default_rng(5)
    dense = E.unit(rng.normal(size=(1, 32)) + 0.02 * rng.normal(size=(200, 32)))
    alone = E.unit(rng.normal(size=(60, 32)))
    vectors = E.unit(np.concatenate([dense, alone, alone + 0.01 * rng.normal(size=alone.shape)]))
    classes = spark.createDataFrame([(k, 1, v.tobytes()) for k, v in enumerate(vectors)], "rep long, size long, vector binary")
    found = spark.createDataFrame([(k, 199, 0) for k in range(200)], "rep long, linked long, star long")
    assert E.measured_recall(classes, found, len(vectors), 32, 0.95) == 0.0


def test_exact_when_no_try_meets_the_audit(spark, rows, monkeypatch):
    monkeypatch.setattr(E, "_links", lambda classes, *_: spark.createDataFrame([], "rep long, linked long, star long"))
    frame = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<float>")
    for rows_of_one in (E.EXACT_ROWS, 50):
        monkeypatch.setattr(E, "EXACT_ROWS", rows_of_one)
        got = [tuple(r) for r in E.near_vectors(frame).collect() if r.vec_id is not None]
        assert sorted(got) == sorted(x for x in brute(rows) if x[0] is not None)


def test_every_length_is_searched(spark, monkeypatch):
    rng = np.random.default_rng(6)
    out = [(k, [float(x) for x in rng.normal(size=8)]) for k in range(40)]
    for at, width, n in ((100, 3, 30), (200, 5, 12), (300, 6, 1)):
        for k in range(n):
            v = rng.normal(size=width)
            out += [(at + 2 * k, [float(x) for x in v]), (at + 2 * k + 1, [float(x) for x in v * 2 + 0.001])]
    frame = spark.createDataFrame(out, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in E.near_vectors(frame).collect()) == sorted(brute(out))
    monkeypatch.setattr(E, "PART_ROWS", 30)  # a graph for the second length, too
    assert sum(r.n_links for r in E.near_vectors(frame).collect()) >= 0.95 * sum(x[1] for x in brute(out))
