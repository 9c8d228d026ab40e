"""Embedding near-dedup: a flat graph built on overlapping shards, searched in range, audited.

Equal vectors are merged first.  A bounded sample gives cluster centres; every vector goes
to the shards of its nearest two, or of more where there are many.  Each shard builds a robust-pruned graph, the adjacency
lists that a vector has in its shards are united, and every vector searches its shards from
their medoids, expanding all points in range.  What the search returns is checked with
cosines in double precision.  A pair that two shards hold counts in the smaller one only, so
counts add up without a list of pairs; for the components each shard gives out stars.

A shard beyond a size is cut into parts: a graph per part, searched by the vectors of every
part.  The audit compares a bounded sample of vectors with all others by brute force and
takes the mean share of its own links that a vector got, apart for vectors with few and with
many links, so that a dense group hides nothing; below the wanted recall the work is done
again with more shards per vector and a wider beam, and at last exactly, all with all.
Vectors of every length are searched among their like.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.llm import flatgraph
from vanecast.llm.graph import components
from vanecast.session import materialize

THRESHOLD = 0.95
SHARD_ROWS = 1000  # vectors per cluster centre
MIN_SHARDS = 32
MAX_SHARDS = 4096  # bounds the centres that go to every task
PART_ROWS = 3000  # vectors of one graph at most, about
SAMPLE_ROWS = 20_000  # for the centres
AUDIT_ROWS = 1000  # vectors compared with all others
APART = 0.8  # cosine of two centres at most
RECALL = 0.95
TRIES = 3
AUDIT_LEAST = 20  # audited vectors of a like number of links that are judged apart
EXACT_ROWS = 10_000  # vectors of one side of an exact comparison, about


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision; scaled first, so that no square overflows."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column, width: int) -> np.ndarray:
    data = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.array([np.frombuffer(x.as_buffer(), np.float64) for x in data]).reshape(len(data), width)


def centres(sample: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Spherical k-means; empty clusters take a new random row.

    Of centres closer than ``APART`` one stays, so that a dense group is not cut by borders.
    """
    rng = np.random.default_rng(seed)
    out = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(sample[a : a + 2000] @ out.T).argmax(1) for a in range(0, len(sample), 2000)])
        sums = np.zeros_like(out)
        np.add.at(sums, nearest, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        empty = norm[:, 0] < 1e-12
        out = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), out)
        out[empty] = sample[rng.integers(0, len(sample), empty.sum())]
    kept: list[int] = []
    for i in range(len(out)):
        if not kept or (out[kept] @ out[i]).max() < APART:
            kept.append(i)
    return out[kept]


def _assign(middle, overlap: int, width: int):
    def run(stream):
        points = middle.value
        for batch in stream:
            vectors = _matrix(batch.column(2), width)
            if len(vectors):
                close = vectors @ points.T
                few = min(overlap, len(points))
                top = np.sort(np.argpartition(-close, few - 1, axis=1)[:, :few], axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(top.tolist(), pa.list_(pa.int64()))], names=["rep", "size", "vector", "shards"])

    return run


def _build(width: int):
    def run(part: pa.Table) -> pa.Table:
        order = np.argsort(part.column("rep").to_numpy(), kind="stable")
        reps = part.column("rep").to_numpy()[order]
        graph = flatgraph.build(_matrix(part.column("vector"), width)[order].astype(np.float32))
        near = [reps[row[row >= 0]].tolist() for row in graph]
        return pa.table({"rep": reps, "near": pa.array(near, pa.list_(pa.int64()))})

    return run


def _stars(first: np.ndarray, second: np.ndarray, n: int) -> np.ndarray:
    """Smallest position connected to each of n positions by the given links (pointer doubling)."""
    label = np.arange(n)
    while len(first):
        low = np.minimum(label[first], label[second])
        new = label.copy()
        np.minimum.at(new, label[first], low)
        np.minimum.at(new, label[second], low)
        while True:
            again = new[new]
            if (again == new).all():
                break
            new = again
        if (new == label).all():
            break
        label = new
        apart = label[first] != label[second]
        first, second = first[apart], second[apart]
    return label


def _search(width: int, threshold: float, beam: int):
    """Links of the queries of one part with the points of another (or the same) part of a shard."""

    def run(key, points: pa.Table, queries: pa.Table) -> pa.Table:
        shard, same = key[0].as_py(), key[1].as_py() == key[2].as_py()
        none = {"rep": pa.array([], pa.int64()), "linked": pa.array([], pa.int64()), "star": pa.array([], pa.int64())}
        if not points.num_rows or not queries.num_rows:
            return pa.table(none)
        reps, asked = points.column("rep").to_numpy(), queries.column("rep").to_numpy()
        vectors, wanted = _matrix(points.column("vector"), width), _matrix(queries.column("vector"), width)
        size, asked_size = points.column("size").to_numpy(), queries.column("size").to_numpy()
        order = np.argsort(reps)
        graph = np.full((len(reps), max(1, max(len(x) for x in points.column("near").to_pylist()))), -1, np.int64)
        for i, near in enumerate(points.column("near").to_pylist()):
            near = np.array(near, np.int64)
            at = np.minimum(np.searchsorted(reps[order], near), len(reps) - 1)
            inside = order[at[reps[order[at]] == near]]
            graph[i, : len(inside)] = inside
        shards, asked_shards = (np.array(x.column("shards").to_pylist(), np.int64) for x in (points, queries))
        narrow = vectors.astype(np.float32)
        starts = flatgraph.medoids(narrow)
        links = []
        for at, hits in flatgraph.in_range(narrow, graph, starts, wanted.astype(np.float32), threshold - 1e-4, beam=beam):
            q, p = np.nonzero(hits)
            keep = np.zeros(len(q), bool)
            for a in range(0, len(q), flatgraph.PAIRS):
                b = slice(a, a + flatgraph.PAIRS)
                keep[b] = np.einsum("pd,pd->p", wanted[at + q[b]], vectors[p[b]]) >= threshold
            links.append(((at + q[keep]) * len(reps) + p[keep]))
        pair = np.concatenate(links)
        q, p = pair // len(reps), pair % len(reps)
        if same:  # queries and points are the same vectors: a link found from one end holds for both
            place = np.searchsorted(reps[order], asked)
            q = order[place][q]
            low, high = np.minimum(q, p), np.maximum(q, p)
            pair = np.unique(low[low != high] * len(reps) + high[low != high])
            q, p = pair // len(reps), pair % len(reps)
            asked, asked_size, asked_shards = reps, size, shards
        # count a pair in the first shard that both have
        common = np.full(len(q), np.iinfo(np.int64).max)
        for k in range(asked_shards.shape[1]):
            held = (shards[p] == asked_shards[q, k : k + 1]).any(1)
            common = np.where(held, np.minimum(common, asked_shards[q, k]), common)
        here = common == shard
        total, asked_total = np.zeros(len(reps), np.int64), np.zeros(len(asked), np.int64)
        np.add.at(total, p[here], asked_size[q[here]])
        np.add.at(asked_total, q[here], size[p[here]])
        if same:
            star = _stars(q, p, len(reps))
            least = np.full(len(reps), np.iinfo(np.int64).max)
            np.minimum.at(least, star, reps)
            rows = (reps, total + asked_total, least[star])
        else:
            star = _stars(q, p + len(asked), len(asked) + len(reps))
            every = np.concatenate([asked, reps])
            least = np.full(len(every), np.iinfo(np.int64).max)
            np.minimum.at(least, star, every)
            rows = (every, np.concatenate([asked_total, total]), least[star])
        keep = (rows[1] > 0) | (rows[0] != rows[2])
        return pa.table(dict(zip(none, (x[keep] for x in rows), strict=True)))

    return run


def _compared(reps: np.ndarray, size: np.ndarray, vectors: np.ndarray, asked: np.ndarray, asked_size: np.ndarray, wanted: np.ndarray, threshold: float) -> pa.Table:
    """All links between two sets of classes, or inside one if both are the same."""
    same = wanted is vectors
    total, asked_total = np.zeros(len(reps), np.int64), np.zeros(len(asked), np.int64)
    shift = 0 if same else len(asked)
    label = np.arange(shift + len(reps))
    rows = max(1, flatgraph.PAIRS // max(1, len(reps)))
    for a in range(0, len(asked), rows):
        close = wanted[a : a + rows] @ vectors.T >= threshold
        if same:
            close[np.arange(len(close)), np.arange(a, a + len(close))] = False
        else:
            total += close.T @ asked_size[a : a + rows]
        asked_total[a : a + rows] = close @ size
        q, p = np.nonzero(close)
        label = _stars(label[q + a], label[p + shift], len(label))[label]
    every, linked = (reps, asked_total) if same else (np.concatenate([asked, reps]), np.concatenate([asked_total, total]))
    least = np.full(len(every), np.iinfo(np.int64).max)
    np.minimum.at(least, label, every)
    keep = (linked > 0) | (every != least[label])
    return pa.table({"rep": every[keep], "linked": linked[keep], "star": least[label][keep]})


def _exact(classes: DataFrame, n: int, width: int, threshold: float) -> DataFrame:
    """What ``_links`` gives, by comparing all classes with all in blocks."""
    parts = -(-n // EXACT_ROWS)

    def run(key, points: pa.Table, queries: pa.Table) -> pa.Table:
        sides = []
        for part in (points, queries):
            sides += [part.column("rep").to_numpy(), part.column("size").to_numpy(), _matrix(part.column("vector"), width)]
        if key[0].as_py() == key[1].as_py():
            sides[3:] = sides[:3]
        return _compared(*sides, threshold)

    rows = classes.withColumn("part", F.pmod(F.xxhash64("rep"), F.lit(parts)))
    points = rows.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), "part"))).withColumnRenamed("part", "to")
    queries = rows.withColumn("to", F.explode(F.sequence("part", F.lit(parts - 1).cast("long")))).withColumnRenamed("part", "from")
    found = points.groupBy("from", "to").cogroup(queries.groupBy("from", "to")).applyInArrow(run, "rep long, linked long, star long")
    return materialize(found, "exact")


def _links(classes: DataFrame, n: int, width: int, threshold: float, overlap: int, beam: int) -> DataFrame:
    """(``rep``, ``linked``, ``star``) per shard: linked rows of other classes, and a connected class."""
    spark = classes.sparkSession
    draw = F.pmod(F.xxhash64(F.lit("centres"), "rep"), F.lit(1_000_000)) / 1_000_000
    sample = classes.filter(draw < min(1.0, SAMPLE_ROWS / n)).select("rep", "vector").toArrow().sort_by("rep")
    k = min(max(MIN_SHARDS, n // SHARD_ROWS), MAX_SHARDS)
    middle = spark.sparkContext.broadcast(centres(_matrix(sample.column("vector"), width), k) if sample.num_rows else np.eye(1, width))
    placed = materialize(classes.mapInArrow(_assign(middle, overlap, width), "rep long, size long, vector binary, shards array<long>"), "placed")
    in_shards = placed.withColumn("shard", F.explode("shards"))
    counts = in_shards.groupBy("shard").agg(F.ceil(F.count("*") / PART_ROWS).cast("long").alias("parts"))
    rows = in_shards.join(F.broadcast(counts), "shard").withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")))
    built = rows.select("shard", "part", "rep", "vector").groupBy("shard", "part").applyInArrow(_build(width), "rep long, near array<long>")
    united = materialize(built.groupBy("rep").agg(F.flatten(F.collect_list("near")).alias("near")), "graph")
    points = rows.join(united, "rep").withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("part")))).withColumnRenamed("part", "to")
    queries = rows.toDF(*rows.columns).withColumn("to", F.explode(F.sequence("part", F.col("parts") - 1))).withColumnRenamed("part", "from")
    keys = ("shard", "from", "to")
    found = (
        points.select(*keys, "rep", "size", "vector", "shards", "near").groupBy(*keys)
        .cogroup(queries.select(*keys, "rep", "size", "vector", "shards").groupBy(*keys))
        .applyInArrow(_search(width, threshold, beam), "rep long, linked long, star long")
    )
    return materialize(found, "found")


def _true_links(classes: DataFrame, asked: pa.Table, width: int, threshold: float) -> DataFrame:
    """Links of a bounded number of classes by brute force over all classes, in blocks."""
    reps = asked.column("rep").to_numpy()
    sent = classes.sparkSession.sparkContext.broadcast((reps, _matrix(asked.column("vector"), width)))

    def run(stream):
        own, vectors = sent.value
        total = np.zeros(len(own), np.int64)
        for batch in stream:
            close = _matrix(batch.column(2), width) @ vectors.T >= threshold
            other = batch.column(0).to_numpy()[:, None] != own[None, :]
            total += (close & other).T @ batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total)], names=["rep", "truth"])

    return classes.select("rep", "size", "vector").mapInArrow(run, "rep long, truth long").groupBy("rep").agg(F.sum("truth").alias("truth"))


def measured_recall(classes: DataFrame, found: DataFrame, n: int, width: int, threshold: float) -> float:
    """Mean share of its own true links that a class has in ``found``, of about AUDIT_ROWS classes (1.0 without links).

    Classes are taken apart by the power of two of their number of links, and the worst mean counts.
    """
    draw = F.pmod(F.xxhash64(F.lit("audit"), "rep"), F.lit(1_000_000)) / 1_000_000
    asked = classes.filter(draw < min(1.0, AUDIT_ROWS / n)).select("rep", "vector").toArrow()
    if not asked.num_rows:
        return 1.0
    have = found.groupBy("rep").agg(F.sum("linked").alias("linked"))
    truth = _true_links(classes, asked, width, threshold).filter("truth > 0").join(have, "rep", "left")
    rows = sorted((r.truth, (r.linked or 0) / r.truth) for r in truth.collect())  # one per audited class
    groups: list[list[float]] = []
    level = 0
    for links, share in rows:
        if not groups or (links.bit_length() > level and len(groups[-1]) >= AUDIT_LEAST):
            groups.append([])
            level = links.bit_length()
        groups[-1].append(share)
    if len(groups) > 1 and len(groups[-1]) < AUDIT_LEAST:
        few = groups.pop()
        groups[-1] += few
    return min((sum(x) / len(x) for x in groups), default=1.0)


def _searched(classes: DataFrame, n: int, width: int, threshold: float) -> DataFrame:
    """Links of classes of one length: searched until the audit is met, exact if it never is."""
    shards = min(max(MIN_SHARDS, n // SHARD_ROWS), MAX_SHARDS)
    overlap = 2 + (shards > 64) + (shards > 512)  # the more centres, the more pairs without a common one
    for step in range(TRIES):
        linked = _links(classes, n, width, threshold, overlap + step, flatgraph.BEAM * (1 + step))
        if measured_recall(classes, linked, n, width, threshold) >= RECALL:
            return linked
    return _exact(classes, n, width, threshold)


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``.

    Vectors link at a cosine of ``threshold`` or more, in double precision; ``n_links`` counts
    the other rows linked directly, equal vectors included.  Vectors that are null, zero or
    hold null or non-finite components, and rows without an id, link with nothing: they are
    components of their own (a missing id has none) and kept.  Only vectors of the same
    length are comparable.  Equal ids are one node of the components.  Other columns are not read; an empty table gives an
    empty table.
    """
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    fine = F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("ok", fine & F.col("id").isNotNull())
    valid = rows.filter("ok")
    # equal vectors make one class
    classes = valid.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("size"))
    classes = materialize(classes.select("rep", "size", "v", F.size("v").alias("width")), "classes")
    lengths = classes.groupBy("width").count().orderBy(F.desc("count"), "width").filter("count > 1").collect()
    spark = vectors.sparkSession
    linked = spark.createDataFrame([], "width int, rep long, linked long, star long")

    def units(stream):
        for batch in stream:
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            packed = [x.tobytes() for x in unit(values.reshape(batch.num_rows, -1))] if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["rep", "size", "vector"])

    def few(part: pa.Table) -> pa.Table:
        width = part.column("width")[0].as_py()
        part = part.sort_by("rep")
        rows = [part.column("rep").to_numpy(), part.column("size").to_numpy(), unit(np.array(part.column("v").to_pylist()))]
        out = _compared(*rows, *rows, threshold)
        return out.add_column(0, "width", pa.array([width] * out.num_rows, pa.int32()))

    for k, (width, n) in enumerate(lengths):
        if k and n <= PART_ROWS:
            break
        same = classes.filter(F.col("width") == width).select("rep", "size", "v")
        ready = materialize(same.mapInArrow(units, "rep long, size long, vector binary"), "units")
        linked = linked.unionByName(_searched(ready, n, width, threshold).withColumn("width", F.lit(width)))
    rare = [x["width"] for k, x in enumerate(lengths) if k and x["count"] <= PART_ROWS]
    if rare:  # lengths of few vectors, compared at once
        some = classes.join(F.broadcast(spark.createDataFrame([(x,) for x in rare], "width int")), "width").select("width", "rep", "size", "v")
        linked = linked.unionByName(materialize(some.groupBy("width").applyInArrow(few, linked.schema), "few"))
    stars = components(linked.filter("rep <> star").select(F.col("rep").alias("a"), F.col("star").alias("b")))
    counts = linked.groupBy("width", "rep").agg(F.sum("linked").alias("linked"))
    known = classes.join(counts, ["width", "rep"], "left").join(stars.withColumnRenamed("id", "rep"), "rep", "left")
    known = materialize(known.select("v", "rep", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id")), "known")
    good = valid.select("id", "v").join(known, "v").select("id", "n_links", "component_id")
    alone = rows.filter(~F.col("ok")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = good.unionByName(alone)
    return out.select(F.col("id").alias(id_column), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
