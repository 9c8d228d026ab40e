"""Average-rank sums and gini against pandas, with groups parted to the last bit."""

import numpy as np
import pandas as pd
import pytest

from vanecast.operators import joins, ranks
from vanecast.operators.joins import lookup_join
from vanecast.operators.metrics import gini_table
from vanecast.operators.ranks import ordered_keys, rank_sums


def drawn(n=600, seed=3):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({"a": rng.normal(5, 2, n), "smooth": rng.normal(size=n), "near": 1 + rng.integers(0, 50, n) * 2.0**-50, "few": rng.integers(0, 3, n) - 1.0})
    frame["gaps"] = np.where(rng.random(n) < 0.3, np.nan, frame["a"] + rng.normal(size=n))
    frame["zeros"] = np.where(rng.random(n) < 0.5, 0.0, -0.0)
    frame["none"] = np.nan
    frame["huge"] = np.where(rng.random(n) < 0.1, np.inf, -1e300 * rng.random(n))
    return frame


def gini(a, p):
    known = p.notna()
    a, p = a[known], p[known]
    n = len(a)

    def area(ranks_):
        return ((a * (n - ranks_ + 1)).sum() / a.sum() - (n + 1) / 2) / n

    best = area(a.rank())
    return abs(area(p.rank()) / best) if best else None


@pytest.mark.parametrize("max_rows", [2_000_000, 40, 1])
def test_against_pandas(spark, max_rows, monkeypatch):
    monkeypatch.setattr(ranks, "CHUNK_CELLS", 500)
    frame = drawn()
    columns = [c for c in frame if c != "a"]
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else float(v) for v in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame)).repartition(5)
    got = {r["i"]: r for r in rank_sums(df, "a", columns, max_rows).collect()}
    scored = {r["feature"]: r["gini"] for r in gini_table(df, "a", columns, max_rows).collect()}
    for i, c in enumerate(columns):
        known = frame[c].notna()
        if c == "none":
            assert i not in got and c not in scored
            continue
        a = frame["a"][known]
        assert got[i]["n"] == known.sum() and got[i]["total"] == pytest.approx(a.sum())
        assert got[i]["weighted"] == pytest.approx((a * frame[c][known].rank()).sum())
        assert got[i]["best"] == pytest.approx((a * a.rank()).sum())
        assert scored[c] == pytest.approx(gini(frame["a"], frame[c]), abs=1e-12)


def test_awkward_rows(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, float("nan")), (1.0, None), (4.0, -1.0)], "a double, x double")
    got = rank_sums(df, "a", ["x"]).first()  # known rows: NULL at place 2, 2 at place 3 (NaN is largest), 4 at place 1
    assert (got["n"], got["total"], got["weighted"], got["best"]) == (3, 6.0, 2 * 3 + 4 * 1, 2 * 2 + 4 * 3)
    assert rank_sums(df.limit(0), "a", ["x"]).collect() == []


def test_keys_follow_the_doubles():
    v = np.array([-np.inf, -2.0, -1e-300, -0.0, 0.0, 5e-324, 1.0, np.inf, np.nan])
    k = ordered_keys(v)
    assert k[3] == k[4] and (np.diff(k[[0, 1, 2, 3, 5, 6, 7, 8]].astype(object)) > 0).all()


def test_lookups_broadcast_by_rows_and_bytes(spark, monkeypatch):
    left = spark.range(100).withColumnRenamed("id", "k")
    lookup = spark.range(100).selectExpr("id AS k", "repeat('x', 1000) AS v")
    assert "BroadcastHashJoin" in lookup_join(left, lookup, ["k"])._jdf.queryExecution().sparkPlan().toString()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 10_000)
    out = lookup_join(left, lookup, ["k"])
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().sparkPlan().toString() and out.where("v IS NOT NULL").count() == 100
    for rows in ([(1, 1), (1, 2)], [(None, 1), (1, 2), (1, 2)]):
        with pytest.raises(ValueError):
            lookup_join(left, spark.createDataFrame(rows, "k long, v long"), ["k"])
    assert lookup_join(left, spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k long, v long"), ["k"]).where("v = 3").count() == 1


@pytest.mark.parametrize("max_rows", [2_000_000, 20])
def test_every_row_has_a_place_of_its_own_by_key(spark, max_rows):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({"k": rng.permutation(200).astype(float), "a": rng.integers(0, 9, 200) + 1.0, "few": rng.integers(0, 4, 200) * 1.0, "smooth": rng.normal(size=200)})
    df = spark.createDataFrame([tuple(map(float, r)) for r in frame.itertuples(index=False)], "k double, a double, few double, smooth double").repartition(4)

    def area(by):
        ordered = frame.sort_values(by)["a"].to_numpy()
        return ((ordered * np.arange(200, 0, -1)).sum() / ordered.sum() - 201 / 2) / 200

    got = {r["feature"]: r["gini"] for r in gini_table(df, "a", ["few", "smooth"], max_rows, key="k").collect()}
    for c in ("few", "smooth"):
        assert got[c] == pytest.approx(abs(area([c, "k"]) / area(["a", "k"])), abs=1e-12)
    shared = {r["feature"]: r["gini"] for r in gini_table(df, "a", ["few"]).collect()}
    assert got["few"] != pytest.approx(shared["few"], abs=1e-6)


def test_key_ties_and_nulls(spark):
    rows = [(None, 3.0, 1.0), (1.0, 2.0, 1.0), (1.0, 2.0, 1.0), (2.0, None, 0.0), (3.0, 5.0, None)]
    df = spark.createDataFrame(rows, "k double, a double, x double")
    got = gini_table(df, "a", ["x"], key="k").first()["gini"]  # places by x: NULL target 1, key NULL (3) 2, then 2 and 2
    weighted, best = 3 * 2 + 2 * 3 + 2 * 4, 2 * 2 + 2 * 3 + 3 * 4
    assert got == pytest.approx(abs((5 * 7 - weighted) / 7 - 2.5) / abs((5 * 7 - best) / 7 - 2.5))
    assert gini_table(df.limit(0), "a", ["x"], key="k").collect() == []


def test_wide_tables_are_counted_in_parts(spark):
    n = ranks.COUNTED_COLUMNS + 3
    df = spark.range(1, 30).selectExpr("id * 1.0D AS a", *[f"if(id % {i + 2} = 0, NULL, id * 1.0D) AS x{i}" for i in range(n)])
    got = {r["i"]: r["n"] for r in rank_sums(df, "a", [f"x{i}" for i in range(n)]).collect()}
    assert got == {i: sum(v % (i + 2) != 0 for v in range(1, 30)) for i in range(n)}
