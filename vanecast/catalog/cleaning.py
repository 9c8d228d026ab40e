"""Projection, filter and cleaning queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from vanecast.catalog.base import MASKED, Q15, R, TS, events, masked, query, r, table, ts
from vanecast.operators import clean, weather
from vanecast.operators.joins import scalar_join


@query(
    "p1_clean_names",
    'SELECT event_id AS event_id, value AS "value__kW_", user_id AS "user_id_______", event_type AS kind_type FROM events',
)
def p1_clean_names(spark, sf_dir):
    e = events(spark, sf_dir)
    messy = e.select(
        "event_id", F.col("value").alias("value (kW)"), F.col("user_id").alias(" user_id[]（）！＠＃ "), F.col("event_type").alias("kind/type")
    )
    return clean.clean_names(messy)


@query("p2_parse_time", f"SELECT o_orderkey, {TS('o_orderdate')} AS t FROM orders")
def p2_parse_time(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    bare = F.col("o_orderpriority").startswith("1")
    text = F.when(bare, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(ts("o_orderdate"))
    return o.select("o_orderkey", ts(clean.parse_time(text)).alias("t"))


@query(
    "p3_between_times",
    "SELECT event_id, value FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-20 18:00:00'",
)
def p3_between_times(spark, sf_dir):
    rows = clean.between_times(events(spark, sf_dir), "ts", datetime(2024, 1, 5, 6), datetime(2024, 1, 20, 18))
    return rows.select("event_id", "value")


@query("p4_newer_than", "SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'signup')")
def p4_newer_than(spark, sf_dir):
    e = events(spark, sf_dir)
    return clean.newer_than(e, "ts", e.where("event_type = 'signup'")).select("event_id")


@query(
    "p5_training_rows",
    f"""SELECT event_id, x AS label FROM (SELECT event_id, ts, {MASKED} AS x FROM events)
    WHERE ts < TIMESTAMP '2024-01-20 08:00:00' - INTERVAL 240 MINUTE AND x IS NOT NULL""",
)
def p5_training_rows(spark, sf_dir):
    rows = clean.training_rows(masked(events(spark, sf_dir)), "ts", "x", datetime(2024, 1, 20, 8), 240)
    return rows.select("event_id", F.col("x").alias("label"))


@query("p6_drop_null_target", "SELECT event_id, value AS x FROM events WHERE value >= 1")
def p6_drop_null_target(spark, sf_dir):
    return clean.drop_null_target(masked(events(spark, sf_dir)), "x").select("event_id", "x")


@query("p7_bound_infinities", "SELECT event_id, CASE WHEN value < 1 THEN 1e9 WHEN value > 100 THEN -1e9 ELSE value END AS x FROM events")
def p7_bound_infinities(spark, sf_dir):
    inf = float("inf")
    e = events(spark, sf_dir).withColumn("x", F.when(F.col("value") < 1, inf).when(F.col("value") > 100, -inf).otherwise(F.col("value")))
    return clean.bound_infinities(e, ["x"]).select("event_id", "x")


@query("p8_drop_ignored", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def p8_drop_ignored(spark, sf_dir):
    return clean.drop_ignored(table(spark, sf_dir, "customer"), ["c_name", "c_mktsegment", "c_custkey"], ["c_custkey"])


@query("p9_drop_constant", "SELECT event_id, user_id, value FROM events")
def p9_drop_constant(spark, sf_dir):
    e = events(spark, sf_dir).select(
        "event_id", "user_id", "value", F.lit("kW").alias("unit"), F.lit(None).cast("double").alias("empty"), F.lit(3).alias("site")
    )
    return clean.drop_constant(e)[0]


@query("p10_drop_duplicate_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_tax, l_discount FROM lineitem")
def p10_drop_duplicate_rows(spark, sf_dir):
    return clean.drop_duplicate_rows(table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_tax", "l_discount"))


@query(
    "p11_drop_empty_rows",
    """SELECT * FROM (SELECT CASE WHEN value < 1 THEN NULL ELSE value END AS a,
    CASE WHEN value < 2 THEN NULL ELSE user_id END AS b FROM events) WHERE a IS NOT NULL OR b IS NOT NULL""",
)
def p11_drop_empty_rows(spark, sf_dir):
    v = F.col("value")
    return clean.drop_empty_rows(events(spark, sf_dir).select(F.when(v >= 1, v).alias("a"), F.when(v >= 2, F.col("user_id")).alias("b")))


@query(
    "p12_percent_to_fraction",
    f"SELECT l_returnflag, l_linestatus, {R('sum(l_discount)', 4)} AS discount, count(*) AS n FROM lineitem GROUP BY ALL",
)
def p12_percent_to_fraction(spark, sf_dir):
    d = F.col("l_discount")
    percent = F.concat(F.round(d * 100).cast("int").cast("string"), F.lit("%"))
    text = F.when(F.col("l_returnflag") == "A", percent).otherwise(d.cast("string"))
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", text.alias("discount"))
    out = clean.percent_to_fraction(li)
    return out.groupBy("l_returnflag", "l_linestatus").agg(r(F.sum("discount"), 4).alias("discount"), F.count("*").alias("n"))


@query("p13_as_category", "SELECT event_id, CAST(user_id AS VARCHAR) AS user_id FROM events")
def p13_as_category(spark, sf_dir):
    return clean.as_category(events(spark, sf_dir), ["user_id"]).select("event_id", "user_id")


@query(
    "p14_rescale_unit",
    f"""WITH o AS (SELECT o_orderkey, o_totalprice AS big, o_totalprice / 1e9 AS small, o_custkey * 1.0 AS plain FROM orders),
    m AS (SELECT avg(big) AS mb, avg(small) AS ms, avg(plain) AS mp FROM o)
    SELECT o_orderkey,
    {R('CASE WHEN mb > 10000 THEN big / 1000 WHEN mb < 0.01 THEN big * 1000 ELSE big END')} AS big,
    {R('CASE WHEN ms > 10000 THEN small / 1000 WHEN ms < 0.01 THEN small * 1000 ELSE small END', 9)} AS small,
    {R('CASE WHEN mp > 10000 THEN plain / 1000 WHEN mp < 0.01 THEN plain * 1000 ELSE plain END')} AS plain FROM o, m""",
)
def p14_rescale_unit(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_totalprice").alias("big"), (F.col("o_totalprice") / 1e9).alias("small"), F.col("o_custkey").cast("double").alias("plain")
    )
    for c in ("big", "small", "plain"):
        o = clean.rescale_unit(o, c)
    return o.select("o_orderkey", r("big").alias("big"), r("small", 9).alias("small"), r("plain").alias("plain"))


@query("p15_drop_zero_columns", "SELECT l_orderkey, l_tax FROM lineitem")
def p15_drop_zero_columns(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return clean.drop_zero_columns(li.select("l_orderkey", "l_tax", (F.col("l_tax") - F.col("l_tax")).alias("nothing")))


@query("p16_drop_repeated_columns", "SELECT event_id, value, user_id FROM events")
def p16_drop_repeated_columns(spark, sf_dir):
    e = events(spark, sf_dir).select(
        "event_id", "value", "user_id", F.col("value").alias("again"), (F.col("user_id") + 0).alias("user_again")
    )
    return clean.drop_repeated_columns(e, ["event_id"])


@query("p17_keep_features", "SELECT user_id, event_type, value FROM events")
def p17_keep_features(spark, sf_dir):
    return clean.keep_features(events(spark, sf_dir), ["user_id", "event_type"], "value")


@query("p18_numeric_only", "SELECT p_partkey, p_size, p_retailprice FROM part")
def p18_numeric_only(spark, sf_dir):
    return clean.numeric_only(table(spark, sf_dir, "part"))


def _raw_vintages(spark, sf_dir):
    """Orders as raw forecast rows: the issue time holds a date for urgent ones, open orders have none."""
    o = table(spark, sf_dir, "orders")
    day, clock = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "HH:mm:ss")
    return o.select(
        "o_orderkey",
        day.alias("SC_DATE"),
        F.when(F.col("o_orderpriority").startswith("1"), F.concat_ws(" ", day, clock)).otherwise(clock).alias("SC_TIME"),
        F.when(F.col("o_orderstatus") != "O", ts(F.col("o_orderdate") + F.expr("INTERVAL '4' HOUR"))).alias("PRE_TIME"),
    )


@query("p19_issue_text", f"SELECT o_orderkey, {TS('o_orderdate')} AS issue FROM orders")
def p19_issue_text(spark, sf_dir):
    return _raw_vintages(spark, sf_dir).select("o_orderkey", weather.issue_text("SC_DATE", "SC_TIME").alias("issue"))


@query(
    "p20_drop_missing_keys",
    f"SELECT o_orderkey, {TS('o_orderdate')} AS issue, {TS('o_orderdate + INTERVAL 4 HOUR')} AS target FROM orders WHERE o_orderstatus <> 'O'",
)
def p20_drop_missing_keys(spark, sf_dir):
    keyed = weather.add_vintage_keys(_raw_vintages(spark, sf_dir), "SC_DATE", "SC_TIME", "PRE_TIME")
    return keyed.select("o_orderkey", ts("issue").alias("issue"), ts("target").alias("target"))


@query("p21_floor_time", f"SELECT event_id, {TS(Q15('ts'))} AS t FROM events")
def p21_floor_time(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", ts(clean.floor_time("ts")).alias("t"))


@query("p22_shift_minutes", f"SELECT event_id, {TS('ts + INTERVAL 240 MINUTE')} AS t FROM events")
def p22_shift_minutes(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", ts(clean.shift_minutes("ts", 240)).alias("t"))


@query(
    "p23_submit_window",
    "SELECT event_id FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-19 08:30:00' AND TIMESTAMP '2024-01-20 08:15:00'",
)
def p23_submit_window(spark, sf_dir):
    start, end = clean.submit_window(datetime(2024, 1, 20, 8, 7, 30), 24 * 60, lag_minutes=30, ahead_rows=1)
    return clean.between_times(events(spark, sf_dir), "ts", start, end).select("event_id")


_DAY = "date_trunc('day', ts)"


@query(
    "p24_issue_published",
    f"""SELECT event_id, {TS(f"least({_DAY} + INTERVAL 8 HOUR - INTERVAL 1 DAY - CASE WHEN hour(ts) < 8 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END, (SELECT date_trunc('day', max(ts)) - INTERVAL 3 DAY FROM events))")} AS issue
    FROM events""",
)
def p24_issue_published(spark, sf_dir):
    e = events(spark, sf_dir)
    latest = e.agg((F.date_trunc("day", F.max("ts")) - F.expr("INTERVAL '3' DAY")).alias("latest"))
    return scalar_join(e, latest).select("event_id", ts(weather.issue_published("ts", F.col("latest"), 8, 1)).alias("issue"))


_LEAD = {240: "l4h", 1440: "l1d", 14400: "l10d"}


@query(
    "p25_issue_by_lead",
    f"""SELECT event_id,
    {TS(f"{_DAY} + INTERVAL 8 HOUR + CASE WHEN hour(ts) < 8 THEN INTERVAL '-1' DAY ELSE INTERVAL 1 DAY END")} AS l4h,
    {TS(f"{_DAY} + INTERVAL 8 HOUR + CASE WHEN hour(ts) < 8 THEN INTERVAL 0 DAY ELSE INTERVAL 1 DAY END")} AS l1d,
    {TS(f"{_DAY} + INTERVAL 8 HOUR")} AS l10d FROM events""",
)
def p25_issue_by_lead(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", *[ts(weather.issue_by_lead("ts", n)).alias(name) for n, name in _LEAD.items()])


@query(
    "p26_issue_evening",
    f"""SELECT event_id,
    {TS(f"{_DAY} + INTERVAL 20 HOUR - CASE WHEN hour(ts) < 16 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END")} AS l4h,
    {TS(f"{_DAY} + INTERVAL 20 HOUR + CASE WHEN hour(ts) >= 20 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END")} AS l1d FROM events""",
)
def p26_issue_evening(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id", ts(weather.issue_evening("ts", 240)).alias("l4h"), ts(weather.issue_evening("ts", 1440)).alias("l1d")
    )


@query("p27_round_probability", f"SELECT event_id, round(1 / (1 + exp(-(value - 50) / 20)), 5) + 0.0 AS p FROM events")
def p27_round_probability(spark, sf_dir):
    p = 1 / (1 + F.exp(-(F.col("value") - 50) / 20))
    return events(spark, sf_dir).select("event_id", clean.round_probability(p).alias("p"))


@query("p28_constant_fill", "SELECT event_id, CASE WHEN value >= 1 THEN value ELSE 7.5 END AS x, 0 AS label FROM events")
def p28_constant_fill(spark, sf_dir):
    e = masked(events(spark, sf_dir)).select("event_id", "x")
    return clean.constant_fill(clean.constant_fill(e, "x", 7.5), "label", 0)


@query("p29_time_text", f"SELECT event_id, {TS('ts')} AS t FROM events")
def p29_time_text(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", clean.time_text("ts").alias("t"))
