"""Boosting of several classes: beats the majority, loses less each round, stops early, survives storing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanecast.functions.registry import FeatureSet
from vanecast.operators.clean import round_probability
from vanecast.plans.boosting import fit_boosted
from vanecast.plans.model import fit, importances, predict, predict_probability, predict_run
from vanecast.sources.sinks import save_run


def planted(spark, n=900, noise=0.05, seed=0):
    """Three classes by two inputs, one of them with gaps; a third input says nothing, a fourth is never known."""
    rng = np.random.default_rng(seed)
    x = rng.uniform(-1, 1, size=(n, 3))
    y = np.where(x[:, 0] > 0.3, 2, np.where(x[:, 1] > 0, 1, 0))
    y = np.where(rng.random(n) < noise, rng.integers(0, 3, n), y)
    rows = [(i, float(a), None if i % 29 == 3 else float(b), float(c), None, int(k)) for i, ((a, b, c), k) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y int").repartition(2)


@pytest.fixture(scope="module")
def boosted(spark):
    return fit_boosted(planted(spark), ["a", "b", "c", "d"], "y", rounds=6, stepSize=0.3, maxDepth=3)


def test_three_classes_beat_the_majority(spark, boosted):
    fresh = planted(spark, seed=1)
    scored = predict(boosted.model, fresh)
    share = scored.agg(F.avg((F.col("y") == F.col("y_pred")).cast("double"))).first()[0]
    majority = fresh.groupBy("y").count().agg(F.max("count")).first()[0] / 900
    assert share > 0.85 > majority + 0.2
    best = [n for n, _ in importances(boosted.model)]
    assert set(best[:2]) == {"a", "b"} and "d" not in best


def test_losses_fall_round_by_round(boosted):
    for code in range(3):
        own = [r for r in boosted.log if r[0] == code]
        assert [r[1] for r in own] == list(range(1, boosted.rounds[code] + 1))
        training = [r[2] for r in own]
        assert all(b < a for a, b in zip(training, training[1:], strict=False))
        assert own[-1][3] < own[0][3]


def test_probabilities_sum_to_one_and_follow_the_class(spark, boosted):
    rows = predict_probability(boosted.model, planted(spark, 60, seed=2), 3).collect()
    predicted = {r["id"]: r["y_pred"] for r in predict(boosted.model, planted(spark, 60, seed=2)).collect()}
    for r in rows:
        p = [r["p0"], r["p1"], r["p2"]]
        assert sum(p) == pytest.approx(1, abs=5e-5) and int(np.argmax(p)) == predicted[r["id"]]
    assert round_probability(F.lit(0.5)) is not None


def test_stops_before_the_last_round_where_there_is_nothing_to_learn(spark):
    """Labels drawn by chance: more rounds fit the training rows and not the held-out ones."""
    noise = planted(spark, 400, noise=1.0)
    found = fit_boosted(noise, ["a", "b", "c"], "y", noise.where("id % 3 = 0"), rounds=12, stepSize=0.5, maxDepth=4)
    held = fit_boosted(noise.where("id % 3 > 0"), ["a", "b", "c"], "y", noise.where("id % 3 = 0"), rounds=12, stepSize=0.5, maxDepth=4)
    assert max(held.rounds) < 12 and len(found.rounds) == 3


def test_a_stored_run_predicts_alike(spark, boosted, tmp_path):
    save_run(spark, f"{tmp_path}/run", boosted.model, FeatureSet([]).fit(planted(spark, 5)), None)
    fresh = planted(spark, 50, seed=3)
    want = {r["id"]: r["y_pred"] for r in predict(boosted.model, fresh).collect()}
    assert {r["id"]: r["y_pred"] for r in predict_run(spark, f"{tmp_path}/run", fresh).collect()} == want


def test_awkward_classes(spark):
    rows = planted(spark, 40)
    with pytest.raises(ValueError):
        fit_boosted(rows.withColumn("y", F.lit(None).cast("int")), ["a"], "y")
    with pytest.raises(ValueError):
        fit_boosted(rows.withColumn("y", F.lit(1000)), ["a"], "y")
    two = fit(rows.withColumn("y", F.when(F.col("id") > 2, (F.col("a") > 0).cast("int"))), "boosted", ["a", "d"], "y", rounds=2)
    assert predict(two, rows).where("y_pred IN (0.0, 1.0)").count() == 40
