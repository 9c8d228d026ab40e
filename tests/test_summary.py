"""Stored summaries give what the rows give, however the rows were split."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vanecast.operators import drift, summary
from vanecast.streaming import jobs
from vanecast.sources import sinks


@pytest.fixture(scope="module")
def sides(spark):
    draw = np.random.default_rng(7)

    def frame(n, shift):
        x = draw.normal(1e6 + shift, 0.5, n)
        x[::50] = np.nan
        y = draw.exponential(3, n)
        y[3] = np.inf
        return pd.DataFrame({"x": x, "y": y, "zero": 0.0, "kind": draw.choice(["a", "b", "c"], n, p=[0.2, 0.3, 0.5])})

    frames = frame(3000, 0.0), frame(1000, 0.1)
    return frames, [spark.createDataFrame(f).repartition(5) for f in frames]


def rows(df):
    return {r["name"]: r.asDict() for r in df.collect()}


def split(df, parts):
    return [df.where(F.pmod(F.xxhash64(*df.columns), F.lit(parts)) == i) for i in range(parts)]


def test_moments_and_counts_of_any_split(spark, sides):
    frames, (history, _) = sides
    pieces = [summary.summarise(p, ["x", "y", "zero"], ["kind"]) for p in split(history, 3)]
    for got in (summary.summarise(history, ["x", "y", "zero"], ["kind"]), summary.combine(summary.combine(*pieces[:2]), pieces[2])):
        got = got.toPandas()
        for c in ("x", "y", "zero"):
            values = frames[0][c].to_numpy()
            values = values[np.isfinite(values)]
            m = got[(got.name == c) & (got.kind == "moments")].iloc[0]
            assert m["n"] == len(values) and math.isclose(m["mean"], values.mean(), rel_tol=1e-12)
            assert math.isclose(m["m2"], ((values - values.mean()) ** 2).sum(), rel_tol=1e-9)
            assert (m["lo"], m["hi"]) == (values.min(), values.max())
            cells = got[(got.name == c) & (got.kind == "cell")]
            assert cells["e"].nunique() == 1 and len(cells) <= summary.CELLS + 1
            want = pd.Series(np.floor(np.ldexp(values, -int(m["e"]))).astype("int64")).value_counts()
            assert dict(zip(cells["cell"].astype("int64"), cells["n"])) == want.to_dict()
        kinds = got[got.kind == "category"].set_index("category")["n"].to_dict()
        assert kinds == frames[0]["kind"].value_counts().to_dict()


def test_tests_equal_those_on_rows(spark, sides):
    _, (history, new) = sides
    clean = [d.select(*[F.when(F.abs(F.nanvl(c, F.lit(math.inf))) < math.inf, F.col(c)).alias(c) for c in ("x", "y")], "kind") for d in (history, new)]
    a, b = [summary.summarise(d, ["x", "y"], ["kind"]) for d in (history, new)]
    want, got = rows(drift.detect(*clean, "ttest", ["x", "y"])), rows(summary.detect(a, b, "ttest"))
    for c in ("x", "y"):
        assert math.isclose(got[c]["statistic"], want[c]["statistic"], rel_tol=1e-6)
        assert math.isclose(got[c]["dof"], want[c]["dof"], rel_tol=1e-6) and got[c]["drift"] == want[c]["drift"]
    want, got = rows(drift.detect(*clean, "chi", ["kind"])), rows(summary.detect(a, b, "chi"))
    assert math.isclose(got["kind"]["statistic"], want["kind"]["statistic"], rel_tol=1e-9) and got["kind"]["dof"] == 2


def test_distance_counts_exactly_on_shared_steps(spark, sides):
    frames, (history, new) = sides
    got = rows(summary.js_distance(summary.summarise(history, ["x", "y"]), summary.summarise(new, ["x", "y"])))
    for c in ("x", "y"):
        a, b = [f[c][np.isfinite(f[c])] for f in frames]
        lo, hi = min(a.min(), b.min()), max(a.max(), b.max())
        step = 2.0 ** math.ceil(math.log2((hi - lo) / summary.COMPARED))
        p, q = [np.floor(s / step).value_counts(normalize=True) for s in (a, b)]
        p, q = p.align(q, fill_value=0.0)
        m = (p + q) / 2
        part = lambda s: np.where(s > 0, s * np.log2(np.where(s > 0, s, 1) / m), 0).sum()
        assert math.isclose(got[c]["statistic"], math.sqrt((part(p) + part(q)) / 2), rel_tol=1e-9)


def test_empty_sides_and_missing_history(spark, sides):
    _, (history, _) = sides
    a, none = summary.summarise(history, ["x"], ["kind"]), summary.summarise(history.limit(0), ["x"], ["kind"])
    assert none.count() == 0 and summary.combine(a, none).count() == a.count()
    for method in ("ttest", "chi", "kl"):
        assert not any(r["drift"] for r in summary.detect(a, none, method).collect())
    assert [r["drift"] for r in summary.detect(None, a, "chi").collect()] == [True]
    with pytest.raises(ValueError):
        summary.detect(a, none, "ddm")


def test_a_stream_checks_against_the_store_and_a_repeated_batch_counts_once(spark, tmp_path):
    folder, log, mark, states = (str(tmp_path / n) for n in ("in", "log", "mark", "states"))
    base = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"))
    store = summary.SummaryStore(spark, states)
    store.start(summary.summarise(base, ["x"]))
    trained = []
    for part in (base, base.withColumn("x", F.col("x") + 9)):
        sinks.append(part, folder)
        stream = jobs.new_files(spark, folder, base.schema, "parquet")
        jobs.retrain_on_drift(
            stream, lambda b, n: summary.check_batch(store, n, b, "ttest", ["x"]), lambda b, n: trained.append(n), log, mark
        )
    assert trained == [1]
    first = store.state(1).orderBy("kind", "cell").collect()
    summary.check_batch(store, 1, base.withColumn("x", F.col("x") + 9), "ttest", ["x"])
    assert store.state(1).orderBy("kind", "cell").collect() == first
    assert store.state(1).where("kind = 'moments'").first()["n"] == 1200
    with pytest.raises(ValueError):
        store.advance(7, store.state(1))
