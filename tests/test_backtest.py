"""Back-tests that train per origin: against numpy, with planted futures, gaps and constant features."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from vanecast.plans.backtest import backtest_trained, solve_ridge, training_sums
from vanecast.plans.forecast import Origins, tasks_within

DAY, QUARTER = datetime(2024, 1, 1), timedelta(minutes=15)
SCHEMA = "g string, t timestamp, y double, a double, b double, one double"


def drawn(days=6, groups=("p", "q"), seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for g in groups:
        level = 1e6 if g == "q" else 0.0  # a large level must cost no digits
        for k in range(96 * days):
            if rng.random() < 0.9:
                a, b = rng.normal(level, 1), rng.normal()
                y = level + 2 * np.sin(k / 9) + rng.normal()
                rows.append((g, DAY + k * QUARTER, None if k % 41 == 7 else float(y), None if k % 37 == 5 else float(a), float(b), 3.0))
    return rows


def fit(rows, g, origin, steps, names, lookback=None, penalty=0.0):
    """Ridge by normal equations on the rows whose label lies before the origin."""
    at = {r[1]: r for r in rows if r[0] == g}
    x, y, labels = [], [], []
    for t, r in at.items():
        if t < origin and (lookback is None or t >= origin - lookback) and r[2] is not None:
            labels.append(r[2])
            base = at.get(t - steps * QUARTER)
            if base and None not in [base[i] for i in names]:
                x.append([base[i] for i in names])
                y.append(r[2])
    if not y:
        return None, np.mean(labels) if labels else None, 0
    x, y = np.array(x), np.array(y)
    mx, my = x.mean(axis=0), y.mean()
    xc = x - mx
    w = np.linalg.lstsq(xc.T @ xc + penalty * np.eye(len(names)), xc.T @ (y - my), rcond=1e-9)[0]
    return (my - w @ mx, w), np.mean(labels), len(y)


@pytest.mark.parametrize(
    ("step", "steps", "subs", "lookback", "penalty", "names"),
    [
        (timedelta(days=1), 96, 1, None, 0.0, ["a", "b"]),
        (timedelta(days=1), 192, 1, timedelta(days=2), 3.0, ["y", "a", "b"]),
        (timedelta(hours=4), 16, 16, None, 0.5, ["y", "b", "one"]),  # one feature never changes
    ],
)
def test_each_origin_is_trained_alone(spark, step, steps, subs, lookback, penalty, names):
    rows = drawn()
    at = {(r[0], r[1]): r for r in rows}
    columns = {"y": 2, "a": 3, "b": 4, "one": 5}
    index = [columns[n] for n in names]
    origins = Origins(DAY + timedelta(days=1), step, 4)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = backtest_trained(df, ["g"], "t", names, "y", origins, steps, subs, lookback, penalty).collect()
    assert len(got) == 2 * 4 * subs * steps
    models = {}
    for r in got:
        key = (r["g"], r["origin"])
        if key not in models:
            models[key] = fit(rows, r["g"], r["origin"], steps, index, lookback, penalty)
        model, mean, n = models[key]
        base = at.get((r["g"], r["date_time"] - steps * QUARTER))
        x = [base[i] for i in index] if base else [None]
        want = mean if model is None or None in x else model[0] + model[1] @ np.array(x)
        assert r["n"] == n
        assert r["y_pred"] == want or r["y_pred"] == pytest.approx(want, rel=1e-9, abs=1e-6)
        actual = at.get((r["g"], r["date_time"]))
        assert r["y_true"] == (actual[2] if actual else None)
    assert any(m[0] is not None for m in models.values())


def test_nothing_from_the_origin_on_is_learnt_or_used(spark):
    """Values at and after the last origin are replaced: no forecast made at any origin moves."""
    rows, origins = drawn(seed=1), Origins(DAY + timedelta(days=2), timedelta(days=1), 3)
    last = DAY + timedelta(days=4)
    poisoned = [r if r[1] < last else (r[0], r[1], -1e9, 1e9, -1e9, 1e9) for r in rows]
    out = []
    for data in (rows, poisoned):
        df = spark.createDataFrame(data, SCHEMA)
        found = backtest_trained(df, ["g"], "t", ["y", "a", "b"], "y", origins, 96, 1, None, 1.0)
        out.append({(r["g"], r["origin"], r["date_time"]): r["y_pred"] for r in found.collect()})
    assert out[0].keys() == out[1].keys()
    for key, value in out[0].items():
        assert out[1][key] == pytest.approx(value, rel=1e-6)
    horizon = timedelta(days=1)
    sums = training_sums(spark.createDataFrame(rows, SCHEMA).withColumn("label", F.col("y")), ["g"], "t", ["a"], "label", horizon, origins)
    for r in sums.collect():
        origin = origins.first + r["number"] * origins.step
        assert r["n"] == sum(x[0] == r["g"] and x[1] < origin - horizon and None not in x[2:4] for x in rows)


def test_one_pass_whatever_the_number_of_origins(spark):
    """The plan reads the series a fixed number of times and sums products once."""
    df = spark.createDataFrame(drawn(), SCHEMA)
    plans = []
    for count in (2, 40):
        origins = Origins(DAY + timedelta(days=1), timedelta(hours=1), count)
        out = backtest_trained(df, ["g"], "t", ["a"], "y", origins, 16)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD"))
    assert plans[0] == plans[1]


def test_awkward_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert backtest_trained(empty, ["g"], "t", ["a"], "y", Origins(DAY, timedelta(days=1), 3), 96).collect() == []
    one = spark.createDataFrame([("p", DAY, 5.0, 1.0, float("nan"), None)], SCHEMA)
    assert backtest_trained(one, ["g"], "t", ["a"], "y", Origins(DAY, timedelta(days=1), 0), 96).collect() == []
    early, late = (
        {r["y_pred"] for r in backtest_trained(one, ["g"], "t", ["a", "b"], "y", Origins(DAY + timedelta(days=d), timedelta(days=1), 1), 96).collect()}
        for d in (0, 1)
    )
    assert early == {None} and late == {5.0}  # nothing before the origin; one label and no model


def test_fits_from_one_row_on(spark):
    t = [DAY, DAY + timedelta(days=1)]
    rows = spark.createDataFrame([("p", t[0], 2.0, 7.0), ("p", t[1], 4.0, 7.0)], "g string, t timestamp, y double, a double")
    sums = training_sums(rows, ["g"], "t", ["a"], "y", timedelta(0), Origins(DAY + timedelta(hours=1), timedelta(days=1), 2))
    got = {r["number"]: r for r in solve_ridge(sums, ["g"], 1).collect()}
    assert (got[0]["n"], got[0]["intercept"], got[0]["weights"]) == (1, 2.0, [0.0])
    assert (got[1]["n"], got[1]["mean"], got[1]["intercept"], got[1]["weights"]) == (2, 3.0, 3.0, [0.0])


def test_shorter_tasks_are_the_first_quarters(spark):
    rows = [(DAY + timedelta(hours=8), DAY + timedelta(hours=8) + k * QUARTER, float(k)) for k in range(6)]
    df = spark.createDataFrame(rows, "exec_point timestamp, date_time timestamp, y_pred double")
    got = tasks_within(df, {"short": 2, "long": 6}).collect()
    assert sorted((r["task"], r["y_pred"]) for r in got) == [("long", float(k)) for k in range(6)] + [("short", 0.0), ("short", 1.0)]
