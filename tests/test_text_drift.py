"""Text clusters find planted topics, and their distance follows the mix of topics."""

import random

import numpy as np
import pytest

from vanecast.operators import drift
from vanecast.operators.centres import settled_counts

TOPICS = {t: [f"{t}{i}" for i in range(60)] for t in ("sea", "ore", "law")}
COMMON = [f"common{i}" for i in range(15)]


def texts(spark, mix, seed):
    draw = random.Random(seed)
    rows = []
    for topic, n in mix.items():
        for _ in range(n):
            words = draw.choices(TOPICS[topic], k=40) + draw.choices(COMMON, k=20)
            draw.shuffle(words)
            rows.append((topic, " ".join(words).title()))
    return spark.createDataFrame(rows, "topic string, text string").repartition(3)


@pytest.fixture(scope="module")
def history(spark):
    return texts(spark, {"sea": 120, "ore": 80, "law": 40}, 1).persist()


def test_clusters_are_the_planted_topics(spark, history):
    new = texts(spark, {"sea": 30, "ore": 20, "law": 10}, 2)
    got = sorted((r["n0"], r["n1"]) for r in drift.text_clusters(history, new, "text").collect())
    assert got == [(40, 10), (80, 20), (120, 30)]


def test_distance_follows_the_mix(spark, history):
    far = lambda mix: drift.cluster_distance(history, texts(spark, mix, 3), "text").first()["statistic"]
    same, moved, one = far({"sea": 60, "ore": 40, "law": 20}), far({"sea": 20, "ore": 40, "law": 60}), far({"law": 60})
    assert same < 1e-6 < 0.2 < moved < one
    assert drift.detect(history, texts(spark, {"law": 60}, 4), "Clustering", ["text"]).first()["drift"]


def test_width_follows_the_vocabulary_and_empty_texts_count(spark, history):
    assert 2 * 195 <= drift.hashed_width(history, "text") <= 1024
    many = spark.range(3000).selectExpr("concat('w', id) AS text")
    assert 6000 <= drift.hashed_width(many, "text") <= 16384
    new = spark.createDataFrame([("",), (None,)], "text string")
    assert sum(r["n1"] for r in drift.text_clusters(history, new, "text").collect()) == 2


def test_rounds_of_k_means_stay_off_the_driver(spark, history, monkeypatch):
    rounds = []
    fit = drift.KMeans.fit
    monkeypatch.setattr(drift.KMeans, "fit", lambda self, rows: rounds.append(self.getMaxIter()) or fit(self, rows))
    drift.text_clusters(history, history.limit(10), "text").collect()
    assert rounds == [0]  # a round of Spark's k-means gathers all centres


@pytest.mark.parametrize("blocks", [1, 4])
def test_settled_counts_are_those_of_plain_rounds(spark, blocks):
    draw = np.random.default_rng(blocks)
    x = np.where(draw.random((90, 37)) < 0.2, draw.random((90, 37)), 0.0)
    x[5] = 0
    side = (np.arange(90) % 3 == 0).astype(int)
    first = [x[0] + 0.1, x[1], x[2], np.full(37, 50.0) * (x.sum(0) > 0)]  # the last one has no member and stays
    centres, old = np.stack(first), None
    while True:
        near = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        if old is not None and (near == old).all():
            break
        old = near
        own = [(near == j) & (side == 0) for j in range(4)]
        centres = np.stack([x[m].mean(axis=0) if m.any() else c for m, c in zip(own, centres, strict=True)])
    rows = [(int(s), np.flatnonzero(v).tolist(), v[v != 0].tolist()) for s, v in zip(side, x, strict=True)]
    df = spark.createDataFrame(rows, "side int, indices array<int>, values array<double>")
    want = [(j, int(((near == j) & (side == 0)).sum()), int(((near == j) & (side == 1)).sum())) for j in range(4)]
    assert settled_counts(df, first, 200, blocks) == [r for r in want if r[1] + r[2]]
