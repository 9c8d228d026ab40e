"""Ordered computations on skewed groups, split and whole, against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vanecast.operators import ordered
from vanecast.operators.ordered import OrderedRows, first_rows_per_group
from vanecast.operators.window import Ewm, Rolling, ewm_features, rolling_features

SPLITS = [10**9, 7]


def skewed(n=300, seed=3):
    """One group with most rows, a short one, a single row and rows without a group."""
    rng = np.random.default_rng(seed)
    g = np.array(["hot"] * (n - 60) + ["cold"] * 40 + ["one"] + [None] * 19, dtype=object)
    x = rng.integers(0, 12, n) / 4
    y = rng.normal(size=n)
    pdf = pd.DataFrame({"g": g, "k": rng.permutation(n), "x": x, "y": y})
    pdf.loc[rng.random(n) < 0.15, "x"] = np.nan
    pdf.loc[rng.random(n) < 0.05, "y"] = np.nan
    return pdf.sort_values(["k"]).reset_index(drop=True)


def frame(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.select(*[F.nanvl(c, F.lit(None)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def by_key(df, name):
    got = {r["k"]: r[name] for r in df.select("k", name).collect()}
    return np.array([np.nan if got[k] is None else got[k] for k in sorted(got)], dtype=float)


def grouped(pdf, fn):
    """Per group in key order, aligned to the sorted keys; rows without a group are a group."""
    parts = [fn(part.sort_values("k")) for _, part in pdf.groupby(pdf["g"].fillna("~"))]
    values = pd.concat(parts)
    return values.loc[pdf.sort_values("k").index].to_numpy(dtype=float)


@pytest.mark.parametrize("max_rows", SPLITS)
def test_positions_and_sums(spark, max_rows):
    pdf = skewed()
    rows = OrderedRows(frame(spark, pdf), ["g"], ["k"], max_rows)
    out = rows.running_sum({"pos": F.lit(1), "total": F.col("x")})
    assert out.count() == len(pdf)
    np.testing.assert_allclose(by_key(out, "pos"), grouped(pdf, lambda p: pd.Series(np.arange(1, len(p) + 1), p.index)))
    np.testing.assert_allclose(by_key(out, "total"), grouped(pdf, lambda p: p["x"].fillna(0).cumsum()))


@pytest.mark.parametrize("max_rows", SPLITS)
def test_order_without_group_descending(spark, max_rows):
    pdf = skewed()
    out = OrderedRows(frame(spark, pdf), [], [("k", "desc")], max_rows).positions()
    np.testing.assert_allclose(by_key(out, "pos"), len(pdf) - np.arange(len(pdf)))


@pytest.mark.parametrize("max_rows", SPLITS)
def test_fill_forward(spark, max_rows):
    pdf = skewed()
    pdf.loc[(pdf["k"] > 40) & (pdf["k"] < 200), "x"] = np.nan  # a gap over many borders
    out = OrderedRows(frame(spark, pdf), ["g"], ["k"], max_rows).fill_forward({"f": F.col("x")})
    np.testing.assert_allclose(by_key(out, "f"), grouped(pdf, lambda p: p["x"].ffill()))


@pytest.mark.parametrize("max_rows", SPLITS)
def test_fill_both_ways(spark, max_rows):
    pdf = skewed()
    pdf.loc[(pdf["k"] > 40) & (pdf["k"] < 200), "x"] = np.nan
    rows = OrderedRows(frame(spark, pdf), ["g"], ["k"], max_rows)
    np.testing.assert_allclose(by_key(rows.fill_backward({"b": F.col("x")}), "b"), grouped(pdf, lambda p: p["x"].bfill()))
    out = rows.fill({"before": ("last", F.col("x"), False), "after": ("next", F.col("x"), False)})
    np.testing.assert_allclose(by_key(out, "before"), grouped(pdf, lambda p: p["x"].shift(1).ffill()))
    np.testing.assert_allclose(by_key(out, "after"), grouped(pdf, lambda p: p["x"].shift(-1).bfill()))


@pytest.mark.parametrize("group", [["g"], []], ids=["grouped", "whole"])
def test_carries_in_lots(spark, monkeypatch, group):
    """Sums, places and fills over lots of three partitions."""
    monkeypatch.setattr(ordered, "LOT", 3)
    pdf = skewed()
    pdf.loc[(pdf["k"] > 40) & (pdf["k"] < 200), "x"] = np.nan
    rows = OrderedRows(frame(spark, pdf), group, ["k"], 7)
    assert rows.chunks > 9
    known = pdf if group else pdf.assign(g="all")
    np.testing.assert_allclose(by_key(rows.running_sum({"s": F.col("x")}), "s"), grouped(known, lambda p: p["x"].fillna(0).cumsum()))
    np.testing.assert_allclose(by_key(rows.positions("p"), "p"), grouped(known, lambda p: pd.Series(np.arange(1, len(p) + 1), p.index)))
    out = rows.fill({"f": ("last", F.col("x"), True), "b": ("next", F.col("x"), False)})
    np.testing.assert_allclose(by_key(out, "f"), grouped(known, lambda p: p["x"].ffill()))
    np.testing.assert_allclose(by_key(out, "b"), grouped(known, lambda p: p["x"].shift(-1).bfill()))


@pytest.mark.parametrize("max_rows", SPLITS)
def test_first_rows(spark, max_rows):
    out = first_rows_per_group(frame(spark, skewed()), ["g"], ["k"], F.lit(5), max_rows)
    counts = {r["g"]: r["count"] for r in out.groupBy("g").count().collect()}
    assert counts == {"hot": 5, "cold": 5, "one": 1, None: 5}


PANDAS_ROLLING = {
    "diff": lambda p, n: p["x"] - p["x"].shift(n),
    "delay": lambda p, n: p["x"].shift(n),
    "ts_mean": lambda p, n: p["x"].rolling(n).mean(),
    "ts_std": lambda p, n: p["x"].rolling(n).std(),
    "ts_max": lambda p, n: p["x"].rolling(n).max(),
    "ts_min": lambda p, n: p["x"].rolling(n).min(),
    "ts_cov": lambda p, n: p["x"].rolling(n).cov(p["y"]),
    "ts_rank": lambda p, n: p["x"].rolling(n).rank(),
}


@pytest.mark.parametrize("max_rows", SPLITS)
@pytest.mark.parametrize("n", [1, 3, 9])
def test_rolling(spark, max_rows, n):
    pdf = skewed()
    specs = {op: Rolling(op, "x", n, "y" if op == "ts_cov" else None) for op in PANDAS_ROLLING}
    out = rolling_features(frame(spark, pdf), ["g"], ["k"], specs, max_rows)
    for op, fn in PANDAS_ROLLING.items():
        np.testing.assert_allclose(by_key(out, op), grouped(pdf, lambda p: fn(p, n)), atol=1e-9, err_msg=op)


def test_self_correlation_fixture(spark):
    pdf = pd.DataFrame({"g": "a", "k": range(5), "x": [1.0, 3, 2, 2, 5], "y": 0.0})
    specs = {"self": Rolling("ts_corr", "x", 3), "flat": Rolling("ts_corr", "x", 3, "y")}
    out = rolling_features(frame(spark, pdf), ["g"], ["k"], specs)
    np.testing.assert_allclose(by_key(out, "self"), [np.nan, np.nan, 1, 1, 1])
    assert np.isnan(by_key(out, "flat")).all()


@pytest.mark.parametrize("max_rows", SPLITS)
@pytest.mark.parametrize("span", [1, 3, 40])
def test_ewm(spark, max_rows, span):
    pdf = skewed(500)
    pdf["x"] += 1000  # a mean far above the spread
    specs = {"mean": Ewm("mean", "x", span), "std": Ewm("std", "x", span), "cov": Ewm("cov", "x", span, "y"), "corr": Ewm("corr", "x", span, "y")}
    out = ewm_features(frame(spark, pdf), ["g"], ["k"], specs, max_rows)

    def masked(p):
        both = p["x"].notna() & p["y"].notna()
        return p["x"].where(both), p["y"].where(both)

    want = {
        "mean": grouped(pdf, lambda p: p["x"].ewm(span=span).mean()),
        "std": grouped(pdf, lambda p: p["x"].ewm(span=span).std()),
        "cov": grouped(pdf, lambda p: masked(p)[0].ewm(span=span).cov(masked(p)[1])),
        "corr": grouped(pdf, lambda p: masked(p)[0].ewm(span=span).corr(masked(p)[1])),
    }
    if span == 1:
        want = {"mean": want["mean"]} | {k: np.full(len(pdf), np.nan) for k in ("std", "cov", "corr")}
    for name, values in want.items():
        np.testing.assert_allclose(by_key(out, name), values, atol=1e-7, err_msg=name)


def test_ewm_holds_its_value_over_a_long_gap(spark):
    x = [1.0, 2.0, 4.0] + [None] * 400 + [3.0]
    pdf = pd.DataFrame({"g": "a", "k": range(len(x)), "x": pd.array(x, dtype="float64")})
    out = ewm_features(frame(spark, pdf), ["g"], ["k"], {"m": Ewm("mean", "x", 3)})
    np.testing.assert_allclose(by_key(out, "m"), pdf["x"].ewm(span=3).mean().to_numpy(), atol=1e-9)


@pytest.mark.parametrize("max_rows", SPLITS)
@pytest.mark.parametrize("span", [1.0001, 1.001, 5, 500])
@pytest.mark.parametrize("step", [1e3, 1e6, 1e9])
def test_ewm_keeps_its_digits_over_a_level_shift(spark, monkeypatch, max_rows, span, step):
    from vanecast.operators import window

    monkeypatch.setattr(window, "BLOCK_ROWS", 50)  # several blocks even here
    rng = np.random.default_rng(8)
    n = 600
    x = rng.normal(0, 0.01, n) + np.where(np.arange(n) >= n // 2, step, 0.0)
    pdf = pd.DataFrame({"g": "a", "k": range(n), "x": x, "y": x * 2 + rng.normal(0, 0.01, n)})
    specs = {"std": Ewm("std", "x", span), "cov": Ewm("cov", "x", span, "y"), "corr": Ewm("corr", "x", span, "y"), "mean": Ewm("mean", "x", span)}
    out = ewm_features(frame(spark, pdf), ["g"], ["k"], specs, max_rows).cache()
    e = pdf["x"].ewm(span=span)
    want = {"std": e.std(), "cov": e.cov(pdf["y"]), "corr": e.corr(pdf["y"]), "mean": e.mean()}
    for name, values in want.items():
        np.testing.assert_allclose(by_key(out, name), values.to_numpy(), rtol=1e-9, err_msg=name)
    out.unpersist()


def test_window_features_cut_long_groups(spark, monkeypatch):
    """One task never computes the frames of more than ``WINDOW_ROWS`` rows, however few the groups."""
    from vanecast.functions.registry import Feature, FeatureSet
    from vanecast.operators import window

    df = spark.range(120).selectExpr("id AS k", "CAST(id % 2 AS STRING) AS g", "(id * 37 % 101) * 1.0D AS x", "(id * 11 % 17) * 1.0D AS y").repartition(3)
    asked = [Feature("ts_corr", ("x", "y"), 4), Feature("ts_rank", ("x",), 3), Feature("ewm_mean", ("y",), 2), Feature("log", ("x",)), Feature("aggmean", ("g", "x"))]
    found = lambda: {tuple(r)[0]: [None if v is None else round(v, 9) for v in tuple(r)[4:]] for r in FeatureSet(asked, ["g"], ["k"]).fit(df).transform(df).collect()}
    whole, split = found(), []
    plain = window.OrderedRows

    def watched(*args, **kwargs):
        out = plain(*args, **kwargs)
        split.append(out.split)
        return out

    monkeypatch.setattr(window, "OrderedRows", watched)
    monkeypatch.setattr(window, "WINDOW_ROWS", 20, raising=False)
    assert found() == whole and split == [True, True]
