"""The classification report by hand, with three classes, and as part of a training run."""

import math

import pytest
from pyspark.sql import functions as F

from vanecast.operators import metrics
from vanecast.plans.train import train_run


def test_three_classes_by_hand(spark):
    rows = [
        (0, 0, 0.7, 0.2, 0.1), (0, 1, 0.3, 0.5, 0.2), (1, 1, 0.2, 0.6, 0.2), (1, 1, 0.1, 0.8, 0.1), (2, 0, 0.5, 0.3, 0.2),
        (None, 0, 1.0, 0.0, 0.0), (0, None, 1.0, 0.0, 0.0), (0, 0, None, 0.0, 0.0),
    ]
    df = spark.createDataFrame(rows, "y int, named int, a double, b double, c double")
    got = metrics.classification_report(df, "y", "named", {0: "a", 1: "b", 2: "c"}).first()
    assert got["accuracy"] == pytest.approx(3 / 5) and got["recall"] == pytest.approx(3 / 5)
    assert got["precision"] == pytest.approx((2 * 1 / 2 + 2 * 2 / 3 + 0) / 5)
    assert got["f1"] == pytest.approx((2 * 1 / 2 + 2 * 4 / 5 + 0) / 5)
    assert got["log_loss"] == pytest.approx(-sum(math.log(p) for p in (0.7, 0.3, 0.6, 0.8, 0.2)) / 5)
    # class 0: 5 of 6 pairs in order; class 1: all; class 2: 2 above, 2 ties of 4
    assert got["auc"] == pytest.approx((5 / 6 + 1 + 0.75) / 3)


def test_a_class_without_rows_and_an_empty_table(spark):
    df = spark.createDataFrame([(0, 0, 0.9, 0.1), (1, 1, 0.2, 0.8)], "y int, named int, a double, b double").withColumn("c", F.lit(0.0))
    got = metrics.classification_report(df, "y", "named", {0: "a", 1: "b", 2: "c"}).first()
    assert got["auc"] == 1.0 and got["f1"] == 1.0
    assert list(metrics.classification_report(df.limit(0), "y", "named", {0: "a", 1: "b"}).first()) == [None] * 6


def test_a_training_run_stores_the_report(spark, tmp_path):
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"), F.rand(3).alias("z"))
    df = df.withColumn("y", F.when(F.col("x") < 10, 0.0).otherwise(1.0)).withColumn("c", F.lit("one"))
    done = train_run(
        df.where("id % 4 > 0"), df.where("id % 4 = 0"), "y", "id", ["x", "z"], ["c"], str(tmp_path), candidates=2,
        learners=["gbt_class"], classification=True, rounds=1,
    )
    stored = {r["metric"]: r["value"] for r in done.metrics.collect()}
    assert set(stored) == set(metrics.CLASS_REPORT)
    assert stored["accuracy"] > 0.95 and stored["auc"] > 0.95 and 0 <= stored["log_loss"] < 0.3
