"""A flat proximity graph in numpy: robust-pruned neighbours, greedy and range-expanding search.

Vectors have unit length; similarity is the cosine.  The graph is built by inserting points
in batches that double in size: a batch searches the graph so far from its medoids, every
point keeps a robust-pruned part of what the search met (a candidate goes if a kept
neighbour is closer to it than the point is, by a factor), and the reverse links are added
and pruned the same way.
"""

from __future__ import annotations

import numpy as np

DEGREE = 24
NEAREST = 8  # of them the closest points, whatever pruning says
REPAIRS = 8  # further columns that the greedy search reads
BEAM = 64
ALPHA = 1.2
WIDTH = 4  # beam entries expanded per step
QUERIES = 512  # queries that advance together
PAIRS = 1 << 16  # similarities computed at a time


def medoids(vectors: np.ndarray, most: int = BEAM // 2, rounds: int = 4, seed: int = 9) -> np.ndarray:
    """Entry points: the points closest to the centres of about sqrt(n) clusters.

    With one entry a search from inside a dense group would not leave it: all its links and
    its whole beam stay in the group.
    """
    n = len(vectors)
    k = min(most, int(np.sqrt(n)) + 1, n)
    centres = vectors[np.random.default_rng(seed).choice(n, k, replace=False)]
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, vectors)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), centres)
    return np.unique((vectors @ centres.T).argmax(0))


def robust_prune(vectors: np.ndarray, points: np.ndarray, found: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Neighbours (-1: none) of ``points`` chosen from the rows of ``found`` (-1: none), all points at once.

    The closest ``NEAREST`` come first and stay: pruning alone would leave the members of a
    dense group one link, to its middle, and a search in range needs to walk the group.
    """
    rows = np.arange(len(points))
    found = np.where(found == points[:, None], -1, found)
    near = vectors[found]
    close = np.einsum("bcd,bd->bc", near, vectors[points])
    close[found < 0] = -np.inf
    own = 2 - 2 * close  # squared distance to the point
    out = np.full((len(points), degree), -1, np.int64)
    for k in range(degree):
        best = close.argmax(1)
        live = close[rows, best] > -np.inf
        if not live.any():
            break
        out[live, k] = found[rows, best][live]
        if k < NEAREST - 1:
            close[rows, best] = -np.inf
            continue
        apart = 2 - 2 * np.einsum("bcd,bd->bc", near, near[rows, best])
        close[alpha * apart <= own] = -np.inf
        close[rows, best] = -np.inf
        close[~live] = -np.inf
    return out


def _distinct_rows(ids: np.ndarray) -> np.ndarray:
    """Every row sorted, repeats replaced by -1."""
    ids = np.sort(ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    return ids


def greedy(vectors: np.ndarray, graph: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int = BEAM, met: list | None = None, least: float = 2.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-first search of all ``queries`` from ``starts``: ids and similarities of the beams,
    and which points each query was compared with.

    ``met``, if given, receives (query, point, similarity) of all comparisons of at least
    ``least``; the beam may have dropped some of those points again.
    """
    n = len(queries)
    graph = graph[:, : DEGREE + REPAIRS]
    rows = np.arange(n)[:, None]
    seen = np.zeros((n, len(vectors)), bool)
    ids = np.full((n, beam), -1, np.int64)
    close = np.full((n, beam), -np.inf, np.float32)
    done = np.ones((n, beam), bool)
    first = len(starts)
    ids[:, :first], close[:, :first], done[:, :first] = starts, queries @ vectors[starts].T, False
    seen[:, starts] = True
    if met is not None:
        q, c = np.nonzero(close[:, :first] >= least)
        met.append((q, starts[c], close[q, c]))
    while not done.all():
        open_ = np.where(done, -np.inf, close)
        pick = np.argpartition(-open_, min(WIDTH, beam - 1), axis=1)[:, :WIDTH]
        live = ~np.take_along_axis(done, pick, 1)
        np.put_along_axis(done, pick, True, 1)
        at = np.where(live, np.take_along_axis(ids, pick, 1), -1)
        near = np.where(at[:, :, None] >= 0, graph[at], -1).reshape(n, -1)
        near[seen[rows, near]] = -1
        near = _distinct_rows(near)
        new = near >= 0
        if not new.any():
            continue
        q, c = np.nonzero(new)
        seen[q, near[q, c]] = True
        score = np.full(near.shape, -np.inf, np.float32)
        score[q, c] = value = np.einsum("pd,pd->p", vectors[near[q, c]], queries[q])
        if met is not None:
            keep = value >= least
            met.append((q[keep], near[q[keep], c[keep]], value[keep]))
        ids, close, done = np.hstack([ids, near]), np.hstack([close, score]), np.hstack([done, ~new])
        top = np.argpartition(-close, beam - 1, axis=1)[:, :beam]
        ids, close, done = (np.take_along_axis(x, top, 1) for x in (ids, close, done))
    return ids, close, seen


def build(vectors: np.ndarray, seed: int = 5) -> np.ndarray:
    """Adjacency (points x DEGREE, -1: none) of the graph over all ``vectors``."""
    n = len(vectors)
    graph = np.full((n, DEGREE), -1, np.int64)
    if n < 2:
        return graph
    order = np.random.default_rng(seed).permutation(n)
    starts = medoids(vectors)
    order = np.concatenate([starts, order[~np.isin(order, starts)]])
    size = min(n, 2 * DEGREE)
    first = order[:size]
    graph[first] = robust_prune(vectors, first, np.broadcast_to(first, (size, size)).copy())
    while size < n:
        batch = order[size : min(n, 2 * size)]
        for at in range(0, len(batch), QUERIES):
            some = batch[at : at + QUERIES]
            ids = greedy(vectors, graph, starts, vectors[some])[0]
            graph[some] = robust_prune(vectors, some, ids)
        # reverse links of the whole batch
        source = np.repeat(batch, DEGREE)
        target = graph[batch].reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        turn = np.argsort(target, kind="stable")
        source, target = source[turn], target[turn]
        points, first_at, count = np.unique(target, return_index=True, return_counts=True)
        for at in range(0, len(points), QUERIES):
            some, some_count = points[at : at + QUERIES], count[at : at + QUERIES]
            width = int(some_count.max())
            more = np.full((len(some), width), -1, np.int64)
            k = np.arange(width)
            inside = k < some_count[:, None]
            more[inside] = source[(first_at[at : at + QUERIES, None] + k)[inside]]
            both = _distinct_rows(np.hstack([graph[some], more]))
            graph[some] = _pruned(vectors, some, both)
        size += len(batch)
    return back_links(connect(vectors, graph, starts))


def reached(graph: np.ndarray, starts: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(graph), bool)
    seen[starts] = True
    front = starts
    while len(front):
        near = np.unique(graph[front])
        near = near[near >= 0]
        front = near[~seen[near]]
        seen[front] = True
    return seen


def connect(vectors: np.ndarray, graph: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Give every point that ``starts`` do not reach a link from its closest reached neighbour.

    Pruning drops the links to points at the rim of a dense group; the repair takes further
    columns, and of several neighbours the one with the fewest of them.
    """
    extra: list[list[int]] = [[] for _ in graph]
    seen = reached(graph, starts)
    while not seen.all():
        lost = np.flatnonzero(~seen)
        own = graph[lost]
        known = (own >= 0) & seen[own]
        some = np.flatnonzero(known.any(1))
        if not len(some):  # a group on its own: link its first point to the closest reached one
            inside = np.flatnonzero(seen)
            extra[inside[(vectors[inside] @ vectors[lost[0]]).argmax()]].append(int(lost[0]))
        for i in some.tolist():
            extra[min(own[i][known[i]].tolist(), key=lambda v: len(extra[v]))].append(int(lost[i]))
        width = max(len(x) for x in extra)
        more = np.full((len(graph), width), -1, np.int64)
        for v, links in enumerate(extra):
            more[v, : len(links)] = links
        seen = reached(np.hstack([graph[:, :DEGREE], more]), starts)
        full = np.hstack([graph[:, :DEGREE], more])
    return full if any(extra) else graph


def back_links(graph: np.ndarray) -> np.ndarray:
    """Give every point a link from one of its closest neighbours, the one with the fewest of these.

    A point at the rim of a dense group is nobody's neighbour; without this the group could
    not be walked to it.
    """
    n = len(graph)
    near = graph[:, :NEAREST]
    held = ((graph[near] == np.arange(n)[:, None, None]).any(2) & (near >= 0)).any(1)
    extra: dict[int, list[int]] = {}
    for i in np.flatnonzero(~held & (near >= 0).any(1)).tolist():
        extra.setdefault(min(near[i][near[i] >= 0].tolist(), key=lambda v: len(extra.get(v, ()))), []).append(i)
    if not extra:
        return graph
    more = np.full((n, max(map(len, extra.values()))), -1, np.int64)
    for v, links in extra.items():
        more[v, : len(links)] = links
    return np.hstack([graph, more])


def _pruned(vectors: np.ndarray, points: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Robust pruning only where there are more candidates than links, the widest rows in small groups."""
    out = np.full((len(points), DEGREE), -1, np.int64)
    count = (found >= 0).sum(1)
    few = np.flatnonzero(count <= DEGREE)
    if len(few):
        out[few] = robust_prune(vectors, points[few], -np.sort(-found[few], axis=1)[:, :DEGREE], alpha=1e9)  # sorted only
    many = np.flatnonzero(count > DEGREE)
    many = many[np.argsort(count[many], kind="stable")]
    at = 0
    while at < len(many):
        step = max(1, PAIRS // 8 // max(int(count[many[min(at + 64, len(many) - 1)]]), 1))
        rows = many[at : at + min(step, 64)]
        width = int(count[rows].max())
        out[rows] = robust_prune(vectors, points[rows], -np.sort(-found[rows], axis=1)[:, :width])
        at += len(rows)
    return out


def in_range(vectors: np.ndarray, graph: np.ndarray, starts: np.ndarray, queries: np.ndarray, least: float, slack: float = 0.03, beam: int = BEAM):
    """Yields (first query, hits): all points of similarity >= ``least`` that the search reaches.

    After the greedy search every point met within ``least - slack`` is expanded, and what that
    meets again, until nothing new is in range.
    """
    for at in range(0, len(queries), QUERIES):
        own = queries[at : at + QUERIES]
        met: list = []
        seen = greedy(vectors, graph, starts, own, beam, met, least - slack)[2]
        hits = np.zeros((len(own), len(vectors)), bool)
        q, p, close = (np.concatenate(x) for x in zip(*met, strict=True))
        hits[q, p] = close >= least
        while len(q):
            nq, np_ = [], []
            for a in range(0, len(q), PAIRS // DEGREE):
                near = graph[p[a : a + PAIRS // DEGREE]]
                who = np.repeat(q[a : a + PAIRS // DEGREE], near.shape[1])
                near = near.reshape(-1)
                new = near >= 0
                who, near = who[new], near[new]
                new = ~seen[who, near]
                pair = np.unique(who[new] * len(vectors) + near[new])
                who, near = pair // len(vectors), pair % len(vectors)
                seen[who, near] = True
                score = np.einsum("pd,pd->p", vectors[near], own[who])
                hits[who, near] = score >= least
                close_by = score >= least - slack
                nq.append(who[close_by])
                np_.append(near[close_by])
            q, p = np.concatenate(nq), np.concatenate(np_)
        yield at, hits
