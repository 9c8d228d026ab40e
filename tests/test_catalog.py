"""Every registered query against its SQL, and the ones without SQL for rows and stable columns."""

import pytest

from check import compare, connect
from vanecast.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    result = compare(spark, con, name, sf_dir)
    assert result.startswith("ok" if name in ORACLES else "rows only"), result


SPLIT = [
    "g3_crosscount", "g12_feature_set", "w3_ts_mean", "w9_ts_rank", "w12_ewm_cov", "w14_row_lead", "j3_vintage_join",
    "j6_lookup_join", "a10_gini_table", "a16_roc", "a18_median_half", "a19_box_summary", "m3_uniform_sample",
    "j7_asof_fill", "w15_fill_grid", "w16_interpolate", "m8_oversample", "m10_stratified_split", "m11_time_split", "o9_first_rows_from_origin",
    "j4_multi_vintage_join", "m24_forecast_with_fallback", "m25_backtest_trained", "m26_backtest_four_hour", "m27_backtest_lookback",
]


@pytest.mark.parametrize("name", SPLIT)
def test_query_when_every_group_is_hot(spark, con, sf_dir, name):
    """The paths for big data give the same results: groups split, lookups joined by shuffle."""
    spark.conf.set("spark.vanecast.groupRows", "40")
    spark.conf.set("spark.vanecast.broadcastRows", "3")
    try:
        result = compare(spark, con, name, sf_dir)
    finally:
        spark.conf.unset("spark.vanecast.groupRows")
        spark.conf.unset("spark.vanecast.broadcastRows")
    assert result.startswith("ok"), result


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    rows = entry(spark)
    assert rows.count() == 5
    assert set(oracle_sql()) <= set(queries())
