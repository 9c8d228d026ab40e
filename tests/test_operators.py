"""Fixtures with known answers, planted effects and skewed inputs."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vanecast.functions.distributions import chi_square_tail, t_two_sided
from vanecast.functions.registry import Feature, FeatureSet
from vanecast.operators import clean, drift, groupstat, metrics, sampling, timegrid, weather
from vanecast.operators.custom import per_group
from vanecast.operators.joins import lookup_join
from vanecast.plans.features import enumerate_features
from vanecast.plans.forecast import Origins, backtest_naive

DAY = datetime(2024, 1, 1)


def at(text):
    h, m = text.split(":")
    return DAY + timedelta(hours=int(h), minutes=int(m))


def test_asof_fixture(spark):
    seen = spark.createDataFrame([(at("0:05"), 1.0), (at("0:30"), 2.0), (at("0:52"), 3.0), (at("0:52"), 5.0)], "t timestamp, x double")
    grid = timegrid.grid_between(spark.range(1).select(), at("0:00"), at("1:15"), "t")
    out = timegrid.asof_fill(grid, seen, [], "t", ["x"]).orderBy("t").collect()
    assert [r["x"] for r in out] == [None, 1, 2, 2, 4, 4]


def test_asof_keeps_nulls_of_the_last_row(spark):
    seen = spark.createDataFrame([(at("0:00"), 1.0, 1.0), (at("0:20"), None, 2.0)], "t timestamp, x double, y double")
    grid = timegrid.grid_between(spark.range(1).select(), at("0:00"), at("0:30"), "t")
    out = timegrid.asof_fill(grid, seen, [], "t", ["x", "y"]).orderBy("t").collect()
    assert [(r["x"], r["y"]) for r in out] == [(1, 1), (1, 1), (None, 2)]


@pytest.mark.parametrize("late", [False, True])
def test_interpolation_fixture(spark, late):
    rows = [(at("0:00"), 10.0), (at("1:00"), 16.0), (at("1:30"), 7.0)] + ([(at("2:00"), None)] if late else [])
    out = timegrid.interpolate(spark.createDataFrame(rows, "t timestamp, x double"), [], "t", ["x"]).orderBy("t").collect()
    assert [r["x"] for r in out] == [10, 11.5, 13, 14.5, 16, 11.5, 7] + ([7, 7] if late else [])


def test_interpolation_uses_values_between_grid_points(spark):
    rows = [(at("0:00"), 0.0), (at("0:20"), 20.0), (at("0:25"), 25.0), (at("0:45"), 45.0)]
    out = timegrid.interpolate(spark.createDataFrame(rows, "t timestamp, x double"), [], "t", ["x"]).orderBy("t").collect()
    np.testing.assert_allclose([r["x"] for r in out], [0, 15, 30, 45])


def test_first_per_key_and_mean(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, None)], "k int, o int, v string")
    assert sorted(tuple(r) for r in timegrid.first_per_key(df, ["k"], ["o"]).collect()) == [(1, 1, "a"), (2, 5, None)]


def test_combine_and_count_fixtures(spark):
    df = spark.createDataFrame([("b", "x", 1), ("a", "y", None), ("b", "z", 1)], "p string, q string, k int")
    codes = groupstat.combine(df, groupstat.fit_combined(df, "p", "q"), "p", "q", "c")
    assert {(r["p"], r["q"]): r["c"] for r in codes.collect()} == {("b", "x"): 1, ("a", "y"): 0, ("b", "z"): 2}
    counted = groupstat.fit_stats(df, {"n": groupstat.GroupStat("count", ("k",))}).transform(df)
    assert sorted(((r["k"], r["n"]) for r in counted.collect()), key=str) == [(1, 2), (1, 2), (None, None)]


def test_statistics_come_from_training_rows(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, v double")
    new = spark.createDataFrame([("a", 100.0), ("c", 1.0)], "k string, v double")
    fitted = FeatureSet([Feature("aggmean", ("k", "v")), Feature("aggstd", ("k", "v"))]).fit(train)
    out = {r["k"]: (r["aggmean__k__v"], r["aggstd__k__v"]) for r in fitted.transform(new).collect()}
    assert out == {"a": (2.0, pytest.approx(math.sqrt(2))), "c": (None, None)}
    one = {r["k"]: r["aggstd__k__v"] for r in fitted.transform(train).collect()}
    assert one["b"] is None


def test_label_codes(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,)], "k string")
    new = spark.createDataFrame([("a",), (None,), ("zzz",)], "k string")
    classes = groupstat.fit_labels(train, "k")
    coded = groupstat.encode_labels(new.withColumn("raw", F.col("k")), classes, "k")
    assert {r["raw"]: r["k"] for r in coded.collect()} == {None: 0, "a": 1, "zzz": 3}
    back = groupstat.decode_labels(coded.select("raw", F.col("k").alias("code")), classes, "code", "name")
    assert {r["raw"]: r["name"] for r in back.collect()} == {None: None, "a": "a", "zzz": None}


def test_lookup_join_on_a_hot_key(spark):
    """Half of the rows share one key and many have none; all come out once."""
    spark.conf.set("spark.vanecast.groupRows", "100")
    try:
        left = spark.range(2000).select(
            "id", F.when(F.col("id") < 1000, 7).when(F.col("id") < 1300, None).otherwise(F.col("id")).cast("long").alias("k")
        )
        right = spark.range(0, 2000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).unionByName(
            spark.createDataFrame([(7, 70)], "k long, v long")
        )
        out = lookup_join(left, right, ["k"], broadcast_limit=10)
        assert out.count() == 2000
        got = out.agg(F.sum("v"), F.count("v"), F.count_distinct("id")).first()
        even = [i for i in range(1300, 2000) if i % 2 == 0]
        assert tuple(got) == (70 * 1000 + 10 * sum(even), 1000 + len(even), 2000)
    finally:
        spark.conf.unset("spark.vanecast.groupRows")


def test_tails():
    assert chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-10)
    assert chi_square_tail(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-10)
    assert chi_square_tail(2.0, 10) == pytest.approx(0.9963401531726563, abs=1e-10)
    assert t_two_sided(2.2281388519649385, 10) == pytest.approx(0.05, abs=1e-10)
    assert t_two_sided(12.706204736432095, 1) == pytest.approx(0.05, abs=1e-10)
    assert t_two_sided(0.0, 7.5) == pytest.approx(1.0)


def test_planted_drift_is_found_only_where_it_is(spark):
    rows = spark.range(4000).select(
        (F.randn(1) + 10).alias("moved"), F.randn(2).alias("same"),
        F.when(F.rand(3) < 0.5, "a").otherwise("b").alias("kind"), F.when(F.rand(4) < 0.5, "a").otherwise("b").alias("steady"),
    ).persist()
    new = rows.withColumn("moved", F.col("moved") + 0.5).withColumn("kind", F.when(F.rand(5) < 0.2, "a").otherwise("c"))
    flags = {}
    for method, columns in (("ttest", ["moved", "same"]), ("kl", ["moved", "same"]), ("chi", ["kind", "steady"])):
        flags |= {(method, r["name"]): r["drift"] for r in drift.detect(rows, new, method, columns).collect()}
    assert flags == {
        ("ttest", "moved"): True, ("ttest", "same"): False, ("kl", "moved"): True, ("kl", "same"): False,
        ("chi", "kind"): True, ("chi", "steady"): False,
    }
    assert [r["drift"] for r in drift.detect(None, new, "ttest", ["same"]).collect()] == [True]
    with pytest.raises(ValueError):
        drift.detect(rows, new, "other", ["same"])


def test_constant_columns_do_not_fail(spark):
    rows = spark.range(50).select(F.lit(1.0).alias("c"), F.col("id").cast("double").alias("x"))
    assert drift.js_distance(rows, rows, "c").first()["statistic"] == 0.0
    assert not drift.detect(rows, rows, "ttest", ["c"]).first()["drift"]
    assert metrics.evaluate(rows, "c", "x", {"r2": metrics.r2}).first()["r2"] == -1.0
    assert metrics.histogram(rows, "c").collect()[0]["n"] == 50
    table = {(r["a"], r["b"]): r["corr"] for r in metrics.correlation_table(rows, ["c", "x"]).collect()}
    assert table[("c", "x")] is None and table[("x", "x")] == pytest.approx(1.0)


def test_text_clusters_see_a_new_topic(spark):
    old = spark.createDataFrame([(f"wind turbine speed {i % 7}",) for i in range(60)] + [(f"solar panel heat {i % 5}",) for i in range(60)], "t string")
    new = spark.createDataFrame([(f"solar panel heat {i % 5}",) for i in range(60)], "t string")
    assert drift.cluster_distance(old, old, "t").first()["statistic"] == pytest.approx(0.0, abs=1e-9)
    assert drift.detect(old, new, "Clustering", ["t"]).first()["drift"]


def test_gini_of_the_target_itself_is_one(spark):
    df = spark.range(200).select("id", (F.rand(7) + 1).alias("y"))
    assert metrics.gini_table(df, "y", ["y"]).first()["gini"] == pytest.approx(1.0)


def test_auc_fixture(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)], "y int, s double")
    assert metrics.auc(df, F.col("y") == 1, "s").first()["auc"] == pytest.approx(0.875)
    assert metrics.auc(df.where("y = 1"), F.col("y") == 1, "s").first()["auc"] is None


def test_balancing(spark):
    rows = spark.range(103).select("id", F.when(F.col("id") < 100, "big").otherwise("small").alias("c"))
    count = lambda df: {r["c"]: r["count"] for r in df.groupBy("c").count().collect()}
    assert count(sampling.fill_small_classes(rows, "c", ["id"])) == {"big": 100, "small": 10}
    filled = sampling.oversample(rows, "c", ["id"])
    assert count(filled) == {"big": 100, "small": 100}
    assert sorted(r["count"] for r in filled.where("c = 'small'").groupBy("id").count().collect()) == [33, 33, 34]
    assert count(sampling.undersample(rows, "c", ["id"], seed=1)) == {"big": 3, "small": 3}


def test_sampling_is_repeatable(spark):
    rows = spark.range(1000)
    once = {r["id"] for r in sampling.random_rows(rows, ["id"], 50, 7).collect()}
    assert once == {r["id"] for r in sampling.random_rows(rows.repartition(7), ["id"], 50, 7).collect()} and len(once) == 50
    assert sampling.sample_history(rows, "random", ["id"], size=10, above=1000).count() == 1000
    assert sampling.sample_history(rows, "random", ["id"], size=10, above=999).count() == 10
    assert sampling.sample_history(rows, "random", ["id"], size=10).count() == 10
    with pytest.raises(ValueError):
        sampling.sample_history(rows, "other", ["id"], size=10)


def test_no_forecast_from_the_future(spark):
    hours = spark.range(24 * 4 * 3).select((F.lit(DAY).cast("timestamp") + F.make_dt_interval(mins=(F.col("id") * 15).cast("int"))).alias("t"))
    for back in (0, 1, 3):
        issue = weather.issue_published("t", F.lit(DAY + timedelta(days=9)), 8, back)
        assert hours.where(issue > F.col("t")).count() == 0
    capped = weather.issue_published("t", F.lit(DAY), 8)
    assert hours.where(capped > F.lit(DAY)).count() == 0


def test_backtest_uses_the_past_only(spark):
    """Changing values at or after an origin changes none of its predictions."""
    start = F.lit(DAY).cast("timestamp")
    s = spark.range(96 * 6).select(F.lit("a").alias("g"), (start + F.make_dt_interval(mins=(F.col("id") * 15).cast("int"))).alias("t"), F.col("id").cast("double").alias("y"))
    origin = DAY + timedelta(days=3, hours=8)
    changed = s.withColumn("y", F.when(F.col("t") >= F.lit(origin), -1e6).otherwise(F.col("y")))
    run = lambda df: [
        (r["date_time"], r["y_pred"])
        for r in backtest_naive(df, ["g"], "t", "y", Origins(origin, timedelta(days=1), 1), 192).orderBy("date_time").collect()
    ]
    assert run(s) == run(changed) and len(run(s)) == 192


def test_cleaning(spark):
    assert clean.clean_name(" a (b)/c！ ") == "a__b__c_"
    df = spark.createDataFrame([("50%", 1.0, None), (" 7 ", float("inf"), None)], "p string, x double, e double")
    out = clean.bound_infinities(clean.percent_to_fraction(df)).collect()
    assert [(r["p"], r["x"]) for r in out] == [(0.5, 1.0), (7.0, 1e9)]
    mixed = spark.createDataFrame([("5%", "5%"), ("7", "7"), ("grew a lot", None)], "p string, q string")
    assert clean.percent_columns(mixed) == (["q"], ["p"])
    rows = clean.percent_to_fraction(mixed).collect()
    assert [(r["p"], r["q"]) for r in rows] == [("5%", 0.05), ("7", 7.0), ("grew a lot", None)]
    kept, dropped = clean.drop_constant(df)
    assert dropped == ["e"] and kept.columns == ["p", "x"]
    repeated = spark.createDataFrame([(1, 2.0, 2.0, None), (2, 3.0, 3.0, None)], "k int, a double, b double, c double")
    assert clean.drop_repeated_columns(repeated, ["k"]).columns == ["k", "a", "c"]
    assert clean.submit_window(datetime(2024, 1, 1, 8, 7), 240, 30, 2) == (datetime(2024, 1, 1, 4, 30), datetime(2024, 1, 1, 8, 0))


def test_kinds_and_profile(spark):
    df = spark.createDataFrame([(1, 0.0, "a"), (2, 0.0, "b"), (3, None, "c")], "n int, z double, s string")
    kinds = {r["name"]: r["kind"] for r in metrics.column_kinds(df, ["n", "z", "s"]).collect()}
    assert kinds == {"n": "numeric", "z": "categorical", "s": "categorical"}
    profile = {r["name"]: tuple(r)[1:] for r in metrics.profile(df, ["n", "z"]).collect()}
    assert profile == {"n": (0, 3, False, False), "z": (1, 1, True, True)}


def test_enumeration_is_whole_and_nested(spark):
    everything = enumerate_features(["a", "b"], ["c", "d"], ordered=True)
    assert {"ts_cov", "ts_corr", "ewm_mean", "ewm_std", "ewm_cov", "ewm_corr"} <= {f.op for f in everything}
    assert {f.span for f in everything if f.span} == {1, 2, 3, 4, 5}
    found = enumerate_features(["a", "b"], ["c", "d"], ordered=True, limit=60)
    assert found == everything[:60] and len({f.name for f in everything}) == len(everything) > 60
    assert {"sine", "add", "count", "crosscount", "aggmean", "ts_mean"} <= {f.op for f in found}
    nested = enumerate_features([Feature("add", ("a", Feature("log", ("b",))))], [], limit=60)
    assert nested == []  # one level more would exceed the depth
    with pytest.raises(ValueError):
        FeatureSet([Feature("drop table", ("a",))])


def test_softmax_and_nested_features(spark):
    df = spark.createDataFrame([(1, 1000.0), (2, 1001.0)], "k int, x double")
    out = FeatureSet([Feature("softmax", ("x",)), Feature("pow", (Feature("sub", ("x", "k")),))]).fit(df).transform(df)
    rows = {r["k"]: r for r in out.collect()}
    assert rows[1]["softmax__x"] + rows[2]["softmax__x"] == pytest.approx(1.0)
    assert rows[2]["pow__sub__x__k"] == 999.0**2 and out.columns == ["k", "x", "softmax__x", "pow__sub__x__k"]


def test_group_function_refuses_hot_groups(spark):
    df = spark.range(50).select(F.lit("a").alias("g"), "id")
    identity = lambda p: p[["id"]]
    assert per_group(df, ["g"], identity, "id long").count() == 50
    with pytest.raises(ValueError):
        per_group(df, ["g"], identity, "id long", max_rows=10)


def test_copies_are_cut_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(sampling, "COPIES_PER_TASK", 7)
    rows = spark.range(203).select("id", F.when(F.col("id") < 200, "big").otherwise("small").alias("c"))
    filled = sampling.oversample(rows, "c", ["id"])
    counts = {r["id"]: r["count"] for r in filled.where("c = 'small'").groupBy("id").count().collect()}
    assert sum(counts.values()) == 200 and sorted(counts.values()) == [66, 67, 67]
    assert filled.where("c = 'big'").count() == 200


def test_lookup_must_be_unique(spark):
    from vanecast.operators.joins import lookup_join

    left = spark.createDataFrame([("a",), (None,)], "k string")
    once = spark.createDataFrame([("a", 1), (None, 2), (None, 3)], "k string, v int")
    assert sorted(r["v"] or 0 for r in lookup_join(left, once, ["k"]).collect()) == [0, 1]
    with pytest.raises(ValueError):
        lookup_join(left, once.unionByName(once), ["k"])
