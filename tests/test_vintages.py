"""Vintages grouped by target give what a join per source and offset gives."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vanecast.operators import weather

DAY = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def sources(spark):
    first, second = [], []
    for d in range(6):
        issue = DAY + timedelta(days=d, hours=8)
        for h in range(0, 72, 3):
            first.append((issue, issue + timedelta(hours=h), float(d * 100 + h), None if h % 9 == 0 else d))
            if d != 3:
                second.append((issue, issue + timedelta(hours=h), f"{d}/{h}"))
    first += [(None, DAY, 1.0, 1), (DAY, None, 1.0, 1), (None, None, 1.0, 1)]
    return (
        spark.createDataFrame(first, "issue timestamp, target timestamp, speed double, steps int"),
        spark.createDataFrame(second, "issue timestamp, target timestamp, note string"),
    )


@pytest.fixture(scope="module")
def times(spark):
    hours = [(i, DAY + timedelta(hours=i)) for i in range(0, 24 * 9)]
    return spark.createDataFrame(hours + hours[40:44] + [(-1, None)], "id int, t timestamp")


def one_by_one(df, sources, minutes, offsets):
    for i, source in enumerate(sources):
        latest = F.lit(source.agg(F.max("issue")).first()[0])
        for k in offsets:
            suffix = ("" if i == 0 else f"_src{i}") + ("" if k == 0 else f"_prev_day_{k}")
            df = weather.join_vintage(df, source, "t", minutes, weather.issue_published("t", latest, 8, k), suffix)
    return df


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", ["500000", "5"])  # broadcast and shuffle
def test_equals_a_join_per_source_and_offset(spark, sources, times, limit):
    keep = spark.conf.get("spark.vanecast.broadcastRows", None)
    spark.conf.set("spark.vanecast.broadcastRows", limit)
    try:
        got = weather.join_vintages(times, sources, "t", 240, [0, 1, 2])
        want = one_by_one(times, sources, 240, [0, 1, 2])
        assert got.columns == want.columns
        assert rows(got) == rows(want)
        assert sum(r["speed"] is not None for r in got.collect()) > 20
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert sum(line.lstrip(" :+-").startswith("Join") for line in plan.splitlines()) == 1
    finally:
        spark.conf.unset("spark.vanecast.broadcastRows") if keep is None else spark.conf.set("spark.vanecast.broadcastRows", keep)


def test_empty_tables(spark, sources, times):
    got = weather.join_vintages(times, [sources[0].limit(0), sources[1]], "t", 240, [0])
    assert got.count() == times.count() and got.where("speed is not null").count() == 0
    assert got.where("note_src1 is not null").count() > 20
    assert weather.join_vintages(times.limit(0), sources, "t", 240, [0]).count() == 0
    assert weather.join_vintages(times, [], "t", 240, [0]).columns == times.columns


def test_a_repeated_pair_is_an_error(spark, sources, times):
    twice = sources[0].unionByName(sources[0])
    with pytest.raises(Exception, match="several rows"):
        weather.join_vintages(times, [twice], "t", 240, [0]).collect()
