"""Forecast, back-test and flagship queries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from vanecast.catalog.base import R, SERIES_SQL, TS, events, query, r, series, ts
from vanecast.operators.metrics import history_mean
from vanecast.operators.timegrid import grid_between
from vanecast.plans import forecast
from vanecast.plans.backtest import backtest_trained
from vanecast.plans.forecast import TASKS, Origins
from vanecast.plans.skill import forecast_skill

# The first origin is 08:00 a week after the first day of the series, the last one its last time.
WARM_UP_HOURS = 7 * 24 + 8
DAILY, FOUR_HOURLY = 24, 4


def origins_of(s, step_hours: int) -> Origins:
    ends = s.agg(F.date_trunc("day", F.min("t")).alias("lo"), F.max("t").alias("hi")).first()
    if ends["lo"] is None:
        return Origins(datetime(1970, 1, 1), timedelta(hours=step_hours), 0)
    first = ends["lo"] + timedelta(hours=WARM_UP_HOURS)
    count = (ends["hi"] - first) // timedelta(hours=step_hours) + 1
    return Origins(first, timedelta(hours=step_hours), max(count, 0))


def backtest_sql(step_hours: int, rows: int, subs: int = 1, lookback_days: int | None = None) -> str:
    """Seasonal-naive back-test written as plain joins."""
    since = "" if lookback_days is None else f"AND s.t >= o.origin - INTERVAL {lookback_days} DAY"
    seen = "p.y" if lookback_days is None else f"CASE WHEN p.t >= w.origin - INTERVAL {lookback_days} DAY THEN p.y END"
    return f"""SELECT event_type, origin, exec_point, date_time, y_pred, y_true FROM (
    WITH s AS ({SERIES_SQL}),
    o AS (SELECT unnest(generate_series(date_trunc('day', min(t))::TIMESTAMP + INTERVAL {WARM_UP_HOURS} HOUR, max(t), INTERVAL {step_hours} HOUR)) AS origin FROM s),
    m AS (SELECT g.event_type, o.origin, avg(s.y) AS mean FROM (SELECT DISTINCT event_type FROM s) g CROSS JOIN o
        LEFT JOIN s ON s.event_type = g.event_type AND s.t < o.origin {since} GROUP BY ALL),
    x AS (SELECT *, unnest(generate_series(origin, origin + INTERVAL {15 * (subs - 1)} MINUTE, INTERVAL 15 MINUTE)) AS exec_point FROM m),
    w AS (SELECT *, unnest(generate_series(exec_point, exec_point + INTERVAL {15 * (rows - 1)} MINUTE, INTERVAL 15 MINUTE)) AS date_time FROM x)
    SELECT w.event_type, w.origin, w.exec_point, w.date_time, coalesce({seen}, w.mean) AS y_pred, a.y AS y_true FROM w
    LEFT JOIN s p ON p.event_type = w.event_type AND p.t = w.date_time - to_days(CAST(floor((epoch(w.date_time) - epoch(w.origin)) / 86400) AS INTEGER) + 1)
    LEFT JOIN s a ON a.event_type = w.event_type AND a.t = w.date_time)"""


def _shown(sql: str, task: str | None = None) -> str:
    head = f"'{task}' AS task, " if task else ""
    return f"""SELECT {head}event_type, {TS('origin')} AS origin, {TS('exec_point')} AS exec_point, {TS('date_time')} AS date_time,
    {R('y_pred')} AS y_pred, {R('y_true')} AS y_true FROM ({sql})"""


def _show(df, *extra):
    return df.select(
        *extra, "event_type", *[ts(c).alias(c) for c in ("origin", "exec_point", "date_time")], r("y_pred").alias("y_pred"), r("y_true").alias("y_true")
    )


def _run(spark, sf_dir, step_hours, rows, subs=1, lookback=None):
    s = series(spark, sf_dir)
    return forecast.backtest_naive(s, ["event_type"], "t", "y", origins_of(s, step_hours), rows, subs, lookback)


# Base times run from the second day of the series to its last quarter.
_BASE_SQL = """SELECT date_trunc('day', min(t))::TIMESTAMP + INTERVAL 1 DAY AS lo, max(t) AS hi FROM s"""


def base_times(s):
    """First and last base time; nothing for an empty series."""
    ends = s.agg(F.date_trunc("day", F.min("t")).alias("lo"), F.max("t").alias("hi")).first()
    if ends["lo"] is None:
        return datetime(1970, 1, 2), datetime(1970, 1, 1)
    return ends["lo"] + timedelta(days=1), ends["hi"]


@query(
    "m24_forecast_with_fallback",
    f"""WITH s AS ({SERIES_SQL}), b AS ({_BASE_SQL}), m AS (SELECT event_type, avg(y) AS mean FROM s, b WHERE t < lo GROUP BY event_type),
    g AS (SELECT event_type, mean, lo, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS t FROM m, b)
    SELECT g.event_type, {TS('g.t')} AS base_time, {TS('g.t + INTERVAL 240 MINUTE')} AS date_time, {R('coalesce(s.y, g.mean)')} AS power,
    {TS('lo + INTERVAL 240 MINUTE')} AS exec_point FROM g LEFT JOIN s ON s.event_type = g.event_type AND s.t = g.t""",
)
def m24_forecast_with_fallback(spark, sf_dir):
    """Predict the value at the base time; where it was not measured, the mean of the first day."""
    s = series(spark, sf_dir)
    start, end = base_times(s)
    mean = s.where(F.col("t") < F.lit(start)).groupBy("event_type").agg(F.avg("y").alias("mean"))
    grid = grid_between(mean.select("event_type"), start, end, "t")
    predictions = s.where(F.col("t") >= F.lit(start)).withColumnRenamed("y", "y_pred")
    out = forecast.with_fallback(grid, predictions, mean, "t", 240, ["event_type", "t"])
    return forecast.forecast_text(out).withColumn("power", r("power"))


@query(
    "m24_forecast_history_mean",
    f"""WITH s AS ({SERIES_SQL}), b AS ({_BASE_SQL}) SELECT {TS('t')} AS base_time, {TS('t + INTERVAL 240 MINUTE')} AS date_time,
    {R('(SELECT avg(value) FROM events)')} AS power, {TS('lo + INTERVAL 240 MINUTE')} AS exec_point
    FROM (SELECT lo, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS t FROM b)""",
)
def m24_forecast_history_mean(spark, sf_dir):
    """Without any input rows the whole grid gets the history mean."""
    e = events(spark, sf_dir)
    start, end = base_times(series(spark, sf_dir))
    grid = grid_between(spark.range(1).select(), start, end, "t")
    nothing = e.where("false").select(F.col("ts").alias("t"), F.col("value").alias("y_pred"))
    out = forecast.with_fallback(grid, nothing, history_mean(e, "ts", "value"), "t", 240, ["t"])
    return forecast.forecast_text(out).withColumn("power", r("power"))


_ROWS = {name: task.rows for name, task in TASKS.items() if name != "Forecast4Hour"}


@query("m25_backtest_daily", " UNION ALL ".join(_shown(backtest_sql(24, n), name) for name, n in _ROWS.items()))
def m25_backtest_daily(spark, sf_dir):
    longest = _run(spark, sf_dir, DAILY, max(_ROWS.values()))
    return _show(forecast.tasks_within(longest, _ROWS), "task")


@query("m26_backtest_four_hour", _shown(backtest_sql(4, 16, 16)))
def m26_backtest_four_hour(spark, sf_dir):
    return _show(_run(spark, sf_dir, FOUR_HOURLY, 16, 16))


@query("m27_backtest_lookback", _shown(backtest_sql(24, 96, 1, 365)))
def m27_backtest_lookback(spark, sf_dir):
    return _show(_run(spark, sf_dir, DAILY, 96, lookback=timedelta(days=365)))


@query("m27_backtest_short_lookback", _shown(backtest_sql(24, 288, 1, 2)))
def m27_backtest_short_lookback(spark, sf_dir):
    return _show(_run(spark, sf_dir, DAILY, 288, lookback=timedelta(days=2)))


def trained_sql(step_hours: int, rows: int, subs: int = 1, lookback_days: int | None = None, two: bool = False, penalty: float = 0.0) -> str:
    """Back-test with a regression per origin: of the value at the base time, or of it and the one a day before."""
    ahead = f"INTERVAL {15 * rows} MINUTE"
    since = "" if lookback_days is None else f"AND {{}} >= o.origin - INTERVAL {lookback_days} DAY"
    features = "SELECT x.event_type, x.t, x.y AS x1, d.y AS x2 FROM s x LEFT JOIN s d ON d.event_type = x.event_type AND d.t = x.t - INTERVAL 1 DAY"
    if two:
        square = {i: f"(regr_sxx(y, x{i}) + {penalty})" for i in (1, 2)}
        det = f"({square[1]} * {square[2]} - regr_sxy(x1, x2) ** 2)"
        fit = f"""(regr_sxy(y, x1) * {square[2]} - regr_sxy(y, x2) * regr_sxy(x1, x2)) / {det} AS w1,
            (regr_sxy(y, x2) * {square[1]} - regr_sxy(y, x1) * regr_sxy(x1, x2)) / {det} AS w2, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2"""
        known, predicted = "x1 IS NOT NULL AND x2 IS NOT NULL", "my + w1 * (p.x1 - m1) + w2 * (p.x2 - m2)"
    else:
        fit, known = "CASE WHEN regr_sxx(y, x1) > 0 THEN regr_slope(y, x1) ELSE 0 END AS w1, CASE WHEN regr_sxx(y, x1) > 0 THEN regr_intercept(y, x1) ELSE avg(y) END AS w0", "x1 IS NOT NULL"
        predicted = "w0 + w1 * p.x1"
    return f"""SELECT event_type, origin, exec_point, date_time, y_pred, y_true FROM (
    WITH s AS ({SERIES_SQL}), f AS ({features}),
    o AS (SELECT unnest(generate_series(date_trunc('day', min(t))::TIMESTAMP + INTERVAL {WARM_UP_HOURS} HOUR, max(t), INTERVAL {step_hours} HOUR)) AS origin FROM s),
    m AS (SELECT g.event_type, o.origin, avg(s.y) AS mean FROM (SELECT DISTINCT event_type FROM s) g CROSS JOIN o
        LEFT JOIN s ON s.event_type = g.event_type AND s.t < o.origin {since.format('s.t')} GROUP BY ALL),
    b AS (SELECT f.*, l.t AS lt, l.y FROM f JOIN s l ON l.event_type = f.event_type AND l.t = f.t + {ahead} WHERE {known}),
    c AS (SELECT event_type, origin, {fit} FROM b JOIN o ON lt < o.origin {since.format('lt')} GROUP BY ALL),
    x AS (SELECT m.*, c.* EXCLUDE (event_type, origin), unnest(generate_series(m.origin, m.origin + INTERVAL {15 * (subs - 1)} MINUTE, INTERVAL 15 MINUTE)) AS exec_point
        FROM m LEFT JOIN c ON c.event_type = m.event_type AND c.origin = m.origin),
    w AS (SELECT *, unnest(generate_series(exec_point, exec_point + INTERVAL {15 * (rows - 1)} MINUTE, INTERVAL 15 MINUTE)) AS date_time FROM x)
    SELECT w.event_type, w.origin, w.exec_point, w.date_time, coalesce({predicted}, w.mean) AS y_pred, a.y AS y_true FROM w
    LEFT JOIN f p ON p.event_type = w.event_type AND p.t = w.date_time - {ahead}
    LEFT JOIN s a ON a.event_type = w.event_type AND a.t = w.date_time)"""


def _trained_shown(sql: str) -> str:
    return f"""SELECT event_type, {TS('origin')} AS origin, {TS('exec_point')} AS exec_point, {TS('date_time')} AS date_time,
    {R('y_pred', 4)} AS y_pred, {R('y_true', 4)} AS y_true FROM ({sql})"""


def _run_trained(spark, sf_dir, step_hours, rows, subs=1, lookback=None, two=False, penalty=0.0):
    s, features = series(spark, sf_dir), ["y"]
    if two:
        before = s.select("event_type", (F.col("t") + F.expr("INTERVAL '1' DAY")).alias("t"), F.col("y").alias("day_before"))
        s, features = s.join(before, ["event_type", "t"], "left"), ["y", "day_before"]
    out = backtest_trained(s, ["event_type"], "t", features, "y", origins_of(s, step_hours), rows, subs, lookback, penalty)
    times = [ts(c).alias(c) for c in ("origin", "exec_point", "date_time")]
    return out.select("event_type", *times, r("y_pred", 4).alias("y_pred"), r("y_true", 4).alias("y_true"))


@query("m25_backtest_trained", _trained_shown(trained_sql(24, 96)))
def m25_backtest_trained(spark, sf_dir):
    """A regression of the value a day later on the value now, trained at each daily origin."""
    return _run_trained(spark, sf_dir, DAILY, 96)


@query("m25_backtest_trained_ridge", _trained_shown(trained_sql(24, 288, two=True, penalty=250.0)))
def m25_backtest_trained_ridge(spark, sf_dir):
    """Three days ahead from the value now and a day before, with a penalty."""
    return _run_trained(spark, sf_dir, DAILY, 288, two=True, penalty=250.0)


@query("m26_backtest_trained_four_hour", _trained_shown(trained_sql(4, 16, 16)))
def m26_backtest_trained_four_hour(spark, sf_dir):
    return _run_trained(spark, sf_dir, FOUR_HOURLY, 16, 16)


@query("m27_backtest_trained_lookback", _trained_shown(trained_sql(24, 96, 1, 3)))
def m27_backtest_trained_lookback(spark, sf_dir):
    """Each origin learns from the labels of the three days before it."""
    return _run_trained(spark, sf_dir, DAILY, 96, lookback=timedelta(days=3))


def _summary_sql(sql: str) -> str:
    return f"""SELECT event_type, {TS('origin')} AS origin, {R('sqrt(sum((y_true - y_pred) ** 2))', 9)} AS rse,
    {R('coalesce(1 - sum((y_true - y_pred) ** 2) / nullif(var_pop(y_true) * count(*), 0), -1)', 4)} AS r2, count(*) AS n
    FROM ({sql}) WHERE y_true IS NOT NULL GROUP BY event_type, origin"""


def _summary(df):
    out = forecast.summarize(df, ["event_type", "origin"])
    return out.select("event_type", ts("origin").alias("origin"), r("rse", 9).alias("rse"), r("r2", 4).alias("r2"), "n")


@query("m28_backtest_summary", _summary_sql(backtest_sql(24, 96)))
def m28_backtest_summary(spark, sf_dir):
    return _summary(_run(spark, sf_dir, DAILY, 96))


@query("a14_rse_per_backtest", _summary_sql(backtest_sql(4, 16, 16)))
def a14_rse_per_backtest(spark, sf_dir):
    return _summary(_run(spark, sf_dir, FOUR_HOURLY, 16, 16))


FLAGSHIP_SQL = f"""WITH s AS ({SERIES_SQL}),
    g AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) AS t FROM (SELECT event_type, min(t) AS lo, max(t) AS hi FROM s GROUP BY event_type)),
    f AS (SELECT g.event_type, g.t, s.y FROM g ASOF LEFT JOIN s ON g.event_type = s.event_type AND g.t >= s.t),
    w AS (SELECT event_type, t, CASE WHEN count(y) OVER r = 4 THEN avg(y) OVER r END AS smooth,
        y - lag(y, 1) OVER (PARTITION BY event_type ORDER BY t) AS change FROM f
        WINDOW r AS (PARTITION BY event_type ORDER BY t ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
    k AS (SELECT w.event_type, b.y AS y, coalesce(w.smooth, (SELECT avg(y) FROM s m WHERE m.event_type = w.event_type)) AS p, w.change
        FROM w JOIN s b ON b.event_type = w.event_type AND b.t = w.t + INTERVAL 240 MINUTE)
    SELECT event_type, {R('avg((y - p) ** 2)', 4)} AS mse, {R('sqrt(avg((y - p) ** 2))', 4)} AS rmse, {R('avg(abs(y - p))', 4)} AS mae,
    {R('1 - sum((y - p) ** 2) / (var_pop(y) * count(*))')} AS r2, count(*) AS n, {R('stddev_samp(change)', 4)} AS change_std FROM k GROUP BY event_type"""


@query("flagship_forecast_skill", FLAGSHIP_SQL)
def flagship_forecast_skill(spark, sf_dir):
    out = forecast_skill(events(spark, sf_dir), ["event_type"], "ts", "value")
    return out.select("event_type", *[r(c, 4).alias(c) for c in ("mse", "rmse", "mae")], r("r2").alias("r2"), "n", r("change_std", 4).alias("change_std"))
