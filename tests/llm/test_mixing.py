"""Raking and the calibrated draw."""

import random

import pytest
from pyspark.sql import functions as F

from vanecast.llm.mixing import calibrate, cell_tokens, draw, flattened, measure, mix_sources, rake

POWERS = {"source": 0.5, "lang": 0.7, "topic": 0.5}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(5)
    data = []
    for i in range(3000):
        source = "hot" if i % 3 == 0 else f"s{rng.randrange(6)}"
        text = " ".join(["word"] * rng.randint(1, 40)) + rng.choice(["", " a@b", " license", " | | |", " !! !! !!"])
        data.append((i, text, rng.choice(["en", "de", None]), source, 1.0))
    data += [(3000, None, "en", "hot", 0.0), (3001, "", None, None, 0.0), (None, "no id", "en", "hot", 0.0), (7, data[7][1], data[7][2], data[7][3], 0.0)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, weight double").repartition(4).cache()


def test_measure(spark):
    texts = ["", None, "a  b\tc", "the license", "x@y z", "a | b | c", "A!! B!! C!!", "a*** b***", "plain text"]
    got = measure(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == [0, 0, 3, 2, 2, 5, 3, 2, 2]
    assert [r.topic for r in got] == ["prose", "prose", "prose", "legal", "contact", "table", "loud", "markup", "prose"]


def test_weights_meet_every_target(docs):
    cells = cell_tokens(measure(docs), list(POWERS)).cache()
    targets = {d: flattened(cells, d, p) for d, p in POWERS.items()}
    raked = rake(cells, targets, rounds=15).cache()
    total = raked.agg(F.sum(F.col("weight") * F.col("tokens"))).first()[0]
    for d, target in targets.items():
        share = raked.groupBy(d).agg((F.sum(F.col("weight") * F.col("tokens")) / total).alias("share"))
        assert all(abs(r.share - r.target) < 1e-6 for r in share.join(target, d).collect())


def test_expected_tokens_meet_the_budget(docs):
    cells = cell_tokens(measure(docs), list(POWERS))
    raked = rake(cells, {d: flattened(cells, d, p) for d, p in POWERS.items()}, rounds=8)
    for budget in (0.1, 0.6, 1.0):
        chances = calibrate(raked, budget)
        sums = chances.agg(F.sum(F.col("p") * F.col("tokens")), F.sum("tokens"), F.max("p"), F.min("p")).first()
        assert abs(sums[0] / sums[1] - budget) < 1e-6 and sums[2] <= 1 and sums[3] >= 0


def test_draw(docs):
    out = mix_sources(measure(docs), POWERS, 0.5).cache()
    rows = out.collect()
    assert all(0 < r.p <= 1 for r in rows)
    ids = [r.doc_id for r in rows]
    assert ids.count(7) in (0, 2)  # repeated rows share their fate
    want = measure(docs).agg(F.sum("n_tokens")).first()[0] / 2
    assert abs(sum(r.n_tokens for r in rows) - want) < 0.06 * want
    u = docs.select("doc_id", draw("doc_id").alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= u[0] and u[1] < 1 and abs(u[2] - 0.5) < 0.02


def test_same_when_cells_are_joined_by_shuffle(spark, docs):
    measured = measure(docs)
    whole = mix_sources(measured, POWERS, 0.5).select("doc_id", "p").collect()
    spark.conf.set("spark.vanecast.broadcastRows", "2")
    spark.conf.set("spark.vanecast.groupRows", "50")
    try:
        split = mix_sources(measured, POWERS, 0.5).select("doc_id", "p").collect()
    finally:
        spark.conf.unset("spark.vanecast.broadcastRows")
        spark.conf.unset("spark.vanecast.groupRows")
    rounded = lambda rows: sorted(((r.doc_id is None, r.doc_id or 0, round(r.p, 9)) for r in rows))
    assert rounded(whole) == rounded(split)


def test_given_targets_and_empty_table(spark, docs):
    goal = {"lang": spark.createDataFrame([("en", 1.0)], "lang string, target double")}
    out = mix_sources(measure(docs), {"lang": 1.0}, 0.3, targets=goal)
    assert {r.lang for r in out.select("lang").distinct().collect()} == {"en"}
    assert mix_sources(measure(docs.limit(0)), POWERS, 0.5).collect() == []
