"""Sampling, balancing and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vanecast.catalog.base import R, events, query, r, table
from vanecast.operators import sampling

_KEY = ["event_id"]


@query("m1_sample_history", "SELECT event_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000")
def m1_sample_history(spark, sf_dir):
    out = sampling.sample_history(events(spark, sf_dir), "timewindow", _KEY, size=1000, above=1000, time="ts")
    return out.select("event_id", "value")


@query("m2_random_rows")
def m2_random_rows(spark, sf_dir):
    return sampling.random_rows(events(spark, sf_dir), _KEY, 1000).select("event_id", "value")


@query(
    "m3_uniform_sample",
    """SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
    WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM events GROUP BY event_type))""",
)
def m3_uniform_sample(spark, sf_dir):
    return sampling.uniform_sample(events(spark, sf_dir), "event_type", _KEY, 10**9).select("event_type", "event_id")


@query(
    "m3_uniform_sample_halves",
    """SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY half ORDER BY event_id) AS rn FROM (
    SELECT event_id, ntile(2) OVER (ORDER BY value, event_id) AS half FROM events)) WHERE rn <= 700""",
)
def m3_uniform_sample_halves(spark, sf_dir):
    out = sampling.uniform_sample(events(spark, sf_dir), "value", _KEY, 700, classification=False)
    return out.select("event_id")


@query("m4_time_window", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 2000")
def m4_time_window(spark, sf_dir):
    return sampling.latest_rows(events(spark, sf_dir), "ts", _KEY, 2000).select("event_id")


@query("m5_uncertainty", f"SELECT event_id, {R('1 - 1 / (1 + exp(-(value - 50) / 20))')} AS uncertainty FROM events ORDER BY 1 - 1 / (1 + exp(-(value - 50) / 20)) DESC, event_id LIMIT 800")
def m5_uncertainty(spark, sf_dir):
    """Least certain rows: one minus the probability given to the true class."""
    p_true = 1 / (1 + F.exp(-(F.col("value") - 50) / 20))
    out = sampling.uncertain_rows(events(spark, sf_dir), 1 - p_true, _KEY, 800)
    return out.select("event_id", r("uncertainty").alias("uncertainty"))


@query(
    "m6_importance_sample",
    f"""WITH f AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS a, p_retailprice / 10.0 AS b FROM part),
    d AS (SELECT x.p_partkey, sqrt((x.a - y.a) ** 2 + (x.b - y.b) ** 2) AS d,
        row_number() OVER (PARTITION BY x.p_partkey ORDER BY (x.a - y.a) ** 2 + (x.b - y.b) ** 2) AS rn FROM f x JOIN f y ON x.p_partkey <> y.p_partkey),
    s AS (SELECT p_partkey, round(avg(d), 9) AS distance FROM d WHERE rn <= 2 GROUP BY p_partkey)
    SELECT {R('distance')} AS distance FROM s ORDER BY s.distance DESC LIMIT 300""",
)
def m6_importance_sample(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("double").alias("a"), (F.col("p_retailprice") / 10).alias("b"))
    out = sampling.sample_history(parts, "importance", ["p_partkey"], size=300, above=0, columns=["a", "b"])
    return out.select(r("distance").alias("distance"))


# nations as classes of suppliers: some have fewer than ten
@query("m7_fill_small_classes", "SELECT s_nationkey, greatest(count(*), 10) AS n, count(DISTINCT s_suppkey) AS kept FROM supplier GROUP BY s_nationkey")
def m7_fill_small_classes(spark, sf_dir):
    out = sampling.fill_small_classes(table(spark, sf_dir, "supplier"), "s_nationkey", ["s_suppkey"])
    return out.groupBy("s_nationkey").agg(F.count("*").alias("n"), F.count_distinct("s_suppkey").alias("kept"))


@query(
    "m8_oversample",
    "SELECT event_type, (SELECT max(n) FROM (SELECT count(*) AS n FROM events GROUP BY event_type)) AS n, count(*) AS kept FROM events GROUP BY event_type",
)
def m8_oversample(spark, sf_dir):
    out = sampling.oversample(events(spark, sf_dir).select("event_id", "event_type"), "event_type", _KEY)
    return out.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("kept"))


@query(
    "m9_undersample",
    """SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS rn FROM events)
    WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM events GROUP BY event_type))""",
)
def m9_undersample(spark, sf_dir):
    return sampling.undersample(events(spark, sf_dir), "event_type", _KEY).select("event_type", "event_id")


@query(
    "m10_stratified_split",
    """SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= ceil(0.2 * count(*) OVER (PARTITION BY event_type)) AS is_test FROM events""",
)
def m10_stratified_split(spark, sf_dir):
    return sampling.stratified_split(events(spark, sf_dir), "event_type", _KEY).select("event_id", "is_test")


@query(
    "m11_time_split",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) > CAST(floor((SELECT count(*) FROM events) * 0.8) AS BIGINT) AS is_test FROM events",
)
def m11_time_split(spark, sf_dir):
    return sampling.time_split(events(spark, sf_dir), "ts", _KEY).select("event_id", "is_test")


@query("m12_random_split")
def m12_random_split(spark, sf_dir):
    out = sampling.random_split(events(spark, sf_dir), _KEY)
    return out.groupBy("is_test").agg(F.count("*").alias("n"))
