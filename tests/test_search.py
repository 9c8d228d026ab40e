"""Successive halving: a full-data winner on growing, nested samples."""

import numpy as np
import pytest

from vanecast.operators.metrics import mse
from vanecast.plans.model import LEARNERS, halving_search, predict, search_models


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(-2, 2, size=(3000, 2))
    y = np.where(x[:, 0] > 0, 5.0, 0.0) + x[:, 1] + 0.3 * rng.normal(size=3000)
    rows = [(float(a), float(b), float(c)) for (a, b), c in zip(x, y, strict=True)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    return df.limit(2400), spark.createDataFrame(rows[2400:], "a double, b double, y double")


TRIALS = [("linear", {}), ("linear", {"regParam": 10.0}), ("tree", {"maxDepth": 1}), ("tree", {"maxDepth": 6}), ("tree", {"maxDepth": 3}), ("linear", {"regParam": 1.0})]


def test_winner_is_close_to_the_best_on_all_rows(spark, parts):
    train, validation = parts
    model, log = halving_search(train, validation, ["a", "b"], "y", TRIALS, mse, factor=2, least_rows=200)
    _, whole = search_models(train, validation, ["a", "b"], "y", TRIALS, mse)
    best = min(r[3] for r in whole)
    assert min(r[5] for r in log if r[0] == log[-1][0]) <= 1.01 * best
    by_rung = {k: [r for r in log if r[0] == k] for k in range(log[-1][0] + 1)}
    assert [len(v) for v in by_rung.values()] == [6, 3, 2]
    rows = [v[0][4] for v in by_rung.values()]
    assert rows[-1] == 2400 and all(1.7 < b / a < 2.3 for a, b in zip(rows, rows[1:], strict=False))
    for k in range(1, len(by_rung)):  # only the best of a rung see more rows
        left = {r[1] for r in by_rung[k]}
        assert max(r[5] for r in by_rung[k - 1] if r[1] in left) <= min(r[5] for r in by_rung[k - 1] if r[1] not in left)
    assert predict(model, validation).where("y_pred IS NOT NULL").count() == 600
    again = halving_search(train, validation, ["a", "b"], "y", TRIALS, mse, factor=2, least_rows=200)[1]
    assert [r[:5] for r in again] == [r[:5] for r in log]
    np.testing.assert_allclose([r[5] for r in again], [r[5] for r in log])


def test_small_tables_and_no_trials(parts, monkeypatch):
    train, validation = parts
    _, log = halving_search(train, validation, ["a"], "y", TRIALS[:2], mse, factor=2, least_rows=5000)
    assert {(r[0], r[4]) for r in log} == {(0, 2400)}  # no sample below the least number of rows: all trials see all
    with pytest.raises(ValueError):
        halving_search(train, validation, ["a"], "y", [], mse)
    assert "tree" in LEARNERS


def test_rows_are_prepared_once_for_all_trials(parts, monkeypatch):
    from vanecast.plans import model as M

    seen, prepare = [], M.prepare
    monkeypatch.setattr(M, "prepare", lambda *args: seen.append(1) or prepare(*args))
    _, log = M.search_models(*parts, ["a", "b"], "y", TRIALS[:3], mse)
    assert len(log) == 3 and len(seen) == 2  # the trials, and the best one on all rows


def test_a_run_stores_the_model_of_its_search(spark, parts, monkeypatch, tmp_path):
    """The baseline and the measured model are fitted by the run itself, the model on all rows by the search."""
    from vanecast.plans import train as T

    fits, fit = [], T.fit
    monkeypatch.setattr(T, "fit", lambda rows, *args, **params: fits.append(rows) or fit(rows, *args, **params))
    one, two = (p.selectExpr("monotonically_increasing_id() AS id", "*") for p in parts)
    done = T.train_run(one, two, "y", "id", ["a", "b"], [], str(tmp_path), candidates=2, maxIter=2)
    assert len(fits) == 2
    kept = list(done.model.stages[0].getInputCols())
    assert kept[:2] == ["a", "b"] and predict(done.model, done.validation.drop("y_pred")).where("y_pred IS NULL").count() == 0
