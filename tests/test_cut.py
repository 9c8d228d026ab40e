"""The first rows by narrowing histograms are those of a whole sort."""

from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vanecast.operators import cut
from vanecast.operators.ordered import sort_columns


@pytest.fixture(scope="module")
def data(spark):
    draw = np.random.default_rng(11)
    n = 4000
    pdf = pd.DataFrame({"id": draw.permutation(n), "x": draw.normal(size=n) * 10.0 ** draw.integers(-8, 9, n), "same": draw.integers(0, 3, n)})
    df = spark.createDataFrame(pdf).repartition(5).withColumns({
        "x": F.expr("CASE WHEN id % 40 = 0 THEN NULL WHEN id % 41 = 0 THEN double('NaN') WHEN id % 43 = 0 THEN double('inf') WHEN id % 47 = 0 THEN double('-inf') ELSE x END"),
        "big": F.col("id") % 2000 + (F.lit(1 << 62)).cast("long"),
        "neg": F.xxhash64("id"),
        "t": F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(secs=F.col("id") % 700),
        "d": F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 9).cast("int")),
        "s": F.concat(F.lit("k"), F.col("id") % 13),
        "flag": F.col("id") % 2 == 0,
    }).persist()
    yield df
    df.unpersist()


ORDERS = [
    ["x", "id"], [("x", "desc"), "id"], ["same", ("id", "desc")], ["big", "id"], [("big", "desc"), "id"], ["neg"],
    ["t", "x", "id"], [("t", "desc"), "id"], ["d", "id"], ["s", "id"], ["flag", ("s", "desc"), "id"], [("flag", "desc"), "x", "id"],
]


@pytest.mark.parametrize("order", ORDERS, ids=str)
def test_equals_a_whole_sort(spark, data, order, monkeypatch):
    monkeypatch.setattr(cut, "BORDER", 50)
    monkeypatch.setattr(cut, "BUCKETS", 16)
    want = [r["id"] for r in data.orderBy(*sort_columns(order)).select("id").collect()]
    for n in (101, 1900):
        got = cut.first_rows(data, order, n)
        assert got.columns == data.columns
        assert sorted(r["id"] for r in got.select("id").collect()) == sorted(want[:n]), n


def test_more_than_there_are_none_and_empty(spark, data, monkeypatch):
    monkeypatch.setattr(cut, "BORDER", 50)
    assert cut.first_rows(data, ["x", "id"], 10_000).count() == 4000
    assert cut.first_rows(data, ["x", "id"], 4000).count() == 4000
    assert cut.first_rows(data, ["x", "id"], 0).count() == 0
    assert cut.first_rows(data.limit(0), ["x", "id"], 500).count() == 0
    assert [r["id"] for r in cut.first_rows(data, ["id"], 3).collect()] == [0, 1, 2]


def test_sorts_only_the_border(spark, data, monkeypatch):
    """A sort that keeps rows per task sees the border alone, behind a filter."""
    monkeypatch.setattr(cut, "BORDER", 50)
    monkeypatch.setattr(cut, "BUCKETS", 2)
    plan = cut.first_rows(data, ["neg"], 1900)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.strip(" :+-") for line in plan.splitlines()]
    sorts = [i for i, line in enumerate(lines) if line.startswith("Sort ")]
    assert len(sorts) == 1 and lines[sorts[0] + 1].startswith("Filter"), plan
