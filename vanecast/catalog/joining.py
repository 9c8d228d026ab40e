"""Grid, join and set-operation queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from vanecast.catalog.base import MASKED, Q15, R, SERIES_SQL, TS, events, masked, query, r, rounded, series, table, ts
from vanecast.operators import joins, timegrid, weather
from vanecast.operators.clean import floor_time, parse_time
from vanecast.operators.knn import neighbour_distance

# -- derived inputs ----------------------------------------------------------------

TOWER_SQL = f"SELECT {Q15('ts')} AS t, avg(value) AS power FROM events WHERE event_type <> 'error' GROUP BY ALL"
FANS_SQL = f"SELECT {Q15('ts')} AS t, avg(value) AS fan FROM events WHERE event_type = 'error' GROUP BY ALL"


def tower(spark, sf_dir):
    e = events(spark, sf_dir).where("event_type <> 'error'")
    return e.groupBy(floor_time("ts").alias("t")).agg(F.avg("value").alias("power"))


def fans(spark, sf_dir):
    e = events(spark, sf_dir).where("event_type = 'error'")
    return e.groupBy(floor_time("ts").alias("t")).agg(F.avg("value").alias("fan"))


# forecasts: every quarter hour is forecast by the 08:00 issues of its own and the two earlier days
VINTAGES_SQL = f"""SELECT date_trunc('day', t) + INTERVAL 8 HOUR - to_days(CAST(k AS INTEGER)) AS issue, t AS target, speed + k AS speed,
    n * 1.0 AS humidity FROM (SELECT {Q15('ts')} AS t, avg(value) AS speed, count(*) AS n FROM events GROUP BY ALL), range(3) AS x(k)"""


def vintages(spark, sf_dir):
    q = events(spark, sf_dir).groupBy(floor_time("ts").alias("t")).agg(F.avg("value").alias("speed"), F.count("*").alias("n"))
    q = q.select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("k"))
    issue = F.date_trunc("day", "t") + F.expr("INTERVAL '8' HOUR") - F.make_dt_interval(days=F.col("k"))
    return q.select(issue.alias("issue"), F.col("t").alias("target"), (F.col("speed") + F.col("k")).alias("speed"), F.col("n").cast("double").alias("humidity"))


def ISSUE(time: str, k: int = 0) -> str:
    return (
        f"least(date_trunc('day', {time}) + INTERVAL 8 HOUR - INTERVAL {k} DAY - "
        f"CASE WHEN hour({time}) < 8 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END, (SELECT max(issue) FROM v))"
    )


# -- grids ------------------------------------------------------------------------------

_GRID_SQL = """SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS t
    FROM (SELECT event_type, min(t) AS lo, max(t) AS hi FROM s GROUP BY event_type)"""


@query(
    "j7_asof_fill",
    f"""WITH e AS (SELECT event_type, ts, avg({MASKED}) AS x, avg(user_id) AS y FROM events GROUP BY ALL),
    s AS (SELECT event_type, {Q15('ts')} AS t FROM events), g AS ({_GRID_SQL})
    SELECT g.event_type, {TS('g.t')} AS t, {R('e.x')} AS x, {R('e.y')} AS y
    FROM g ASOF LEFT JOIN e ON g.event_type = e.event_type AND g.t >= e.ts""",
)
def j7_asof_fill(spark, sf_dir):
    e = masked(events(spark, sf_dir)).withColumnRenamed("ts", "t")
    grid = timegrid.group_grid(e, ["event_type"], "t")
    out = timegrid.asof_fill(grid, e, ["event_type"], "t", ["x", "y"])
    return out.select("event_type", ts("t").alias("t"), r("x").alias("x"), r("y").alias("y"))


@query(
    "w15_fill_grid",
    f"""WITH e AS (SELECT ts, avg(value) AS x FROM events GROUP BY ts),
    g AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-02-01 00:00:00', INTERVAL 15 MINUTE)) AS t)
    SELECT {TS('g.t')} AS t, {R('e.x')} AS x FROM g ASOF LEFT JOIN e ON g.t >= e.ts""",
)
def w15_fill_grid(spark, sf_dir):
    e = events(spark, sf_dir).select(F.col("ts").alias("t"), F.col("value").alias("x"))
    grid = timegrid.grid_between(spark.range(1).select(), datetime(2024, 1, 1), datetime(2024, 2, 1), "t")
    return timegrid.asof_fill(grid, e, [], "t", ["x"]).select(ts("t").alias("t"), r("x").alias("x"))


@query(
    "w16_interpolate",
    f"""WITH s AS ({SERIES_SQL}), k AS (SELECT event_type, t, CASE WHEN y >= 20 THEN y END AS y FROM s),
    g AS ({_GRID_SQL}),
    j AS (SELECT g.event_type, g.t, k.y, CASE WHEN k.y IS NOT NULL THEN g.t END AS kt FROM g LEFT JOIN k ON g.event_type = k.event_type AND g.t = k.t),
    n AS (SELECT event_type, t,
        last_value(y IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY t ROWS UNBOUNDED PRECEDING) AS py,
        last_value(kt IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY t ROWS UNBOUNDED PRECEDING) AS pt,
        first_value(y IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ny,
        first_value(kt IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nt FROM j)
    SELECT event_type, {TS('t')} AS t,
    {R('CASE WHEN ny IS NULL OR pt = nt THEN py ELSE py + (ny - py) * (epoch(t) - epoch(pt)) / (epoch(nt) - epoch(pt)) END', 9)} AS y FROM n""",
)
def w16_interpolate(spark, sf_dir):
    s = series(spark, sf_dir).withColumn("y", F.when(F.col("y") >= 20, F.col("y")))
    out = timegrid.interpolate(s, ["event_type"], "t", ["y"])
    return out.select("event_type", ts("t").alias("t"), r("y", 9).alias("y"))


@query(
    "u6_date_range",
    f"SELECT user_id, {TS('t')} AS t FROM (SELECT user_id, unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS t FROM events GROUP BY user_id)",
)
def u6_date_range(spark, sf_dir):
    ends = events(spark, sf_dir).groupBy("user_id").agg(F.date_trunc("day", F.min("ts")).alias("lo"), F.date_trunc("day", F.max("ts")).alias("hi"))
    steps = timegrid.time_range(F.col("lo"), F.col("hi"), 24 * 60)
    return ends.select("user_id", F.explode(steps).alias("t")).select("user_id", ts("t").alias("t"))


# -- joins ------------------------------------------------------------------------------------


@query(
    "j1_full_outer",
    f"WITH a AS ({TOWER_SQL}), b AS ({FANS_SQL}) SELECT {TS('t')} AS t, {R('power')} AS power, {R('fan')} AS fan FROM a FULL JOIN b USING (t)",
)
def j1_full_outer(spark, sf_dir):
    out = joins.full_outer_on_time(tower(spark, sf_dir), fans(spark, sf_dir), "t")
    return out.select(ts("t").alias("t"), r("power").alias("power"), r("fan").alias("fan"))


@query(
    "j2_left_join",
    f"WITH a AS ({TOWER_SQL}), b AS ({FANS_SQL}) SELECT {TS('t')} AS t, {R('power')} AS power, {R('fan')} AS fan FROM a LEFT JOIN b USING (t)",
)
def j2_left_join(spark, sf_dir):
    out = joins.left_on_time(tower(spark, sf_dir), fans(spark, sf_dir), "t")
    return out.select(ts("t").alias("t"), r("power").alias("power"), r("fan").alias("fan"))


@query(
    "j3_vintage_join",
    f"""WITH v AS ({VINTAGES_SQL}), a AS ({TOWER_SQL}) SELECT {TS('t')} AS t, {R('power')} AS power, {R('v.speed')} AS speed, v.humidity
    FROM a LEFT JOIN v ON v.target = a.t + INTERVAL 240 MINUTE AND v.issue = {ISSUE('a.t')}""",
)
def j3_vintage_join(spark, sf_dir):
    v = vintages(spark, sf_dir)
    latest = F.lit(v.agg(F.max("issue")).first()[0])
    out = weather.join_vintage(tower(spark, sf_dir), v, "t", 240, weather.issue_published("t", latest))
    return out.select(ts("t").alias("t"), r("power").alias("power"), r("speed").alias("speed"), "humidity")


@query(
    "j4_multi_vintage_join",
    f"""WITH v AS ({VINTAGES_SQL}), a AS ({TOWER_SQL}),
    o AS (SELECT issue, target, speed * 2 AS speed FROM v)
    SELECT {TS('t')} AS t, {R('v0.speed')} AS speed, {R('v1.speed')} AS speed_prev_day_1, {R('o0.speed')} AS speed_src1, {R('o1.speed')} AS speed_src1_prev_day_1
    FROM a LEFT JOIN v v0 ON v0.target = a.t + INTERVAL 240 MINUTE AND v0.issue = {ISSUE('a.t')}
    LEFT JOIN v v1 ON v1.target = a.t + INTERVAL 240 MINUTE AND v1.issue = {ISSUE('a.t', 1)}
    LEFT JOIN o o0 ON o0.target = a.t + INTERVAL 240 MINUTE AND o0.issue = {ISSUE('a.t')}
    LEFT JOIN o o1 ON o1.target = a.t + INTERVAL 240 MINUTE AND o1.issue = {ISSUE('a.t', 1)}""",
)
def j4_multi_vintage_join(spark, sf_dir):
    v = vintages(spark, sf_dir).drop("humidity")
    other = v.withColumn("speed", F.col("speed") * 2)
    out = weather.join_vintages(tower(spark, sf_dir), [v, other], "t", 240, [0, 1])
    names = ["speed", "speed_prev_day_1", "speed_src1", "speed_src1_prev_day_1"]
    return out.select(ts("t").alias("t"), *[r(n).alias(n) for n in names])


@query(
    "j5_join_by_target",
    f"""WITH v AS ({VINTAGES_SQL}), a AS ({TOWER_SQL}),
    p AS (SELECT DISTINCT {ISSUE('t')} AS issue, t + INTERVAL 240 MINUTE AS target FROM a),
    m AS (SELECT target, avg(speed) AS speed FROM v SEMI JOIN p USING (issue, target) GROUP BY target)
    SELECT {TS('t')} AS t, {R('power')} AS power, {R('speed')} AS speed FROM a LEFT JOIN m ON m.target = a.t + INTERVAL 240 MINUTE""",
)
def j5_join_by_target(spark, sf_dir):
    v = vintages(spark, sf_dir).drop("humidity")
    latest = F.lit(v.agg(F.max("issue")).first()[0])
    out = weather.join_by_target(tower(spark, sf_dir), v, "t", 240, weather.issue_published("t", latest))
    return out.select(ts("t").alias("t"), r("power").alias("power"), r("speed").alias("speed"))


@query(
    "j6_lookup_join",
    f"""WITH s AS (SELECT l_partkey, avg(l_quantity) AS mean FROM lineitem GROUP BY l_partkey)
    SELECT l_returnflag, {R('avg(mean)', 4)} AS mean, count(*) AS n FROM lineitem LEFT JOIN s USING (l_partkey) GROUP BY l_returnflag""",
)
def j6_lookup_join(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_returnflag")
    stats = li.groupBy("l_partkey").agg(F.avg("l_quantity").alias("mean"))
    out = joins.lookup_join(li, stats, ["l_partkey"])
    return out.groupBy("l_returnflag").agg(r(F.avg("mean"), 4).alias("mean"), F.count("*").alias("n"))


@query(
    "j8_label_by_time",
    f"""WITH s AS ({SERIES_SQL}) SELECT a.event_type, {TS('a.t')} AS t, {R('a.y')} AS y, {R('b.y')} AS label
    FROM s a LEFT JOIN s b ON a.event_type = b.event_type AND b.t = a.t + INTERVAL 240 MINUTE""",
)
def j8_label_by_time(spark, sf_dir):
    out = joins.lead_label(series(spark, sf_dir), ["event_type"], "t", "y", 240)
    return out.select("event_type", ts("t").alias("t"), r("y").alias("y"), r("label").alias("label"))


@query(
    "j9_join_actuals",
    f"""WITH s AS ({SERIES_SQL}), p AS (SELECT event_type, t + INTERVAL 1 DAY AS t, y AS y_pred FROM s)
    SELECT p.event_type, {TS('p.t')} AS t, {R('y_pred')} AS y_pred, {R('s.y')} AS y_true FROM p LEFT JOIN s ON p.event_type = s.event_type AND p.t = s.t""",
)
def j9_join_actuals(spark, sf_dir):
    s = series(spark, sf_dir)
    p = s.select("event_type", (F.col("t") + F.expr("INTERVAL '1' DAY")).alias("t"), F.col("y").alias("y_pred"))
    out = p.join(s.withColumnRenamed("y", "y_true"), ["event_type", "t"], "left")
    return out.select("event_type", ts("t").alias("t"), r("y_pred").alias("y_pred"), r("y_true").alias("y_true"))


@query("j10_semi_join", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def j10_semi_join(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.keep_matching(table(spark, sf_dir, "orders"), keys, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("j11_scalar_join", f"SELECT event_id, {R('value - (SELECT avg(value) FROM events)')} AS off_mean FROM events")
def j11_scalar_join(spark, sf_dir):
    e = events(spark, sf_dir)
    out = joins.scalar_join(e, e.agg(F.avg("value").alias("mean")))
    return out.select("event_id", r(F.col("value") - F.col("mean")).alias("off_mean"))


@query(
    "j12_neighbour_distance",
    f"""WITH d AS (SELECT a.vec_id, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS d,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) AS rn
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
    SELECT vec_id, {R('avg(d)')} AS distance FROM d WHERE rn <= 10 GROUP BY vec_id""",
)
def j12_neighbour_distance(spark, sf_dir):
    out = neighbour_distance(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 10)
    return out.select("vec_id", r("distance").alias("distance"))


@query("j13_anti_join", "SELECT url FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels)")
def j13_anti_join(spark, sf_dir):
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"))
    return joins.missing_from(table(spark, sf_dir, "pages"), known, ["page_id"]).select("url")


# -- set operations -------------------------------------------------------------------------------


@query("u1_union_all", "SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier")
def u1_union_all(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return c.unionByName(s)


@query(
    "u2_union_missing_columns",
    "SELECT c_nationkey AS nation, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS supplier FROM customer UNION ALL SELECT s_nationkey, NULL, s_name FROM supplier",
)
def u2_union_missing_columns(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_name").alias("supplier"))
    return c.unionByName(s, allowMissingColumns=True)


@query(
    "u3_difference",
    """SELECT 'missing' AS kind, page_id AS k FROM pages WHERE page_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL SELECT 'extra', doc_id FROM labels WHERE doc_id NOT IN (SELECT page_id FROM pages)""",
)
def u3_difference(spark, sf_dir):
    """Both directions of the subset check between two key sets."""
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("k"))
    d = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("k"))
    missing = joins.missing_from(p, d, ["k"]).select(F.lit("missing").alias("kind"), "k")
    return missing.unionByName(joins.missing_from(d, p, ["k"]).select(F.lit("extra").alias("kind"), "k"))


@query("u4_refit_union", "SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-24 00:00:00' THEN 'train' ELSE 'validation' END AS part FROM events")
def u4_refit_union(spark, sf_dir):
    e = events(spark, sf_dir)
    early = F.col("ts") < F.expr("TIMESTAMP '2024-01-24 00:00:00'")
    train = e.where(early).select("event_id", F.lit("train").alias("part"))
    return train.unionByName(e.where(~early).select("event_id", F.lit("validation").alias("part")))


@query("u5_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def u5_distinct(spark, sf_dir):
    return events(spark, sf_dir).select("user_id", "event_type").distinct()
