"""Aggregation, metric, curve and top-k queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from vanecast.catalog.base import MASKED, Q15, R, TS, events, masked, query, r, rounded, table, ts
from vanecast.operators import metrics, sampling, timegrid, weather
from vanecast.operators.clean import floor_time

# -- summaries ------------------------------------------------------------------------


@query(
    "a1_mean_per_time",
    f"SELECT {TS(Q15('ts'))} AS t, {R('avg(value)')} AS value, {R('avg(user_id)')} AS user_id FROM events GROUP BY {Q15('ts')}",
)
def a1_mean_per_time(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("t", floor_time("ts"))
    out = timegrid.mean_per_time(e, ["t"], ["value", "user_id"])
    return out.select(ts("t").alias("t"), r("value").alias("value"), r("user_id").alias("user_id"))


@query(
    "a2_first_per_key",
    f"""SELECT event_type, {TS('t')} AS t, event_id, value FROM (SELECT *, {Q15('ts')} AS t,
    row_number() OVER (PARTITION BY event_type, {Q15('ts')} ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""",
)
def a2_first_per_key(spark, sf_dir):
    e = events(spark, sf_dir).select("event_type", floor_time("ts").alias("t"), "ts", "event_id", "value")
    out = timegrid.first_per_key(e, ["event_type", "t"], ["ts", "event_id"])
    return out.select("event_type", ts("t").alias("t"), "event_id", "value")


@query(
    "a3_distinct_counts",
    "SELECT count(DISTINCT l_orderkey) AS l_orderkey, count(DISTINCT l_discount) AS l_discount, count(DISTINCT l_returnflag) AS l_returnflag FROM lineitem",
)
def a3_distinct_counts(spark, sf_dir):
    return metrics.distinct_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_discount", "l_returnflag"])


@query(
    "a4_column_kinds",
    """SELECT unnest(['quality', 'toxic', 'doc_id']) AS name, unnest([CASE WHEN count(DISTINCT quality) <= 2 THEN 'categorical' ELSE 'numeric' END,
    CASE WHEN count(DISTINCT toxic) <= 2 THEN 'categorical' ELSE 'numeric' END, CASE WHEN count(DISTINCT doc_id) <= 2 THEN 'categorical' ELSE 'numeric' END]) AS kind FROM labels""",
)
def a4_column_kinds(spark, sf_dir):
    return metrics.column_kinds(table(spark, sf_dir, "labels"), ["quality", "toxic", "doc_id"])


@query(
    "a5_missing_values",
    "SELECT count(*) FILTER (value < 1) + count(*) FILTER (value < 2) AS nulls FROM events",
)
def a5_missing_values(spark, sf_dir):
    v = F.col("value")
    return weather.missing_values(events(spark, sf_dir).select(F.when(v >= 1, v).alias("a"), F.when(v >= 2, v).alias("b")), ["a", "b"])


@query("a6_class_counts", "SELECT event_type, count(*) AS n, count(*) = min(count(*)) OVER () AS rarest FROM events GROUP BY event_type")
def a6_class_counts(spark, sf_dir):
    e = events(spark, sf_dir)
    rarest = sampling.rarest_class(e, "event_type").select(F.col("n").alias("least"))
    out = sampling.class_counts(e, "event_type").crossJoin(F.broadcast(rarest))
    return out.select("event_type", "n", (F.col("n") == F.col("least")).alias("rarest"))


@query(
    "a7_time_range",
    f"""SELECT {TS('least((SELECT min(ts) FROM events), (SELECT min(o_orderdate) FROM orders))')} AS first,
    {TS('greatest((SELECT max(ts) FROM events), (SELECT max(o_orderdate) FROM orders))')} AS last""",
)
def a7_time_range(spark, sf_dir):
    ends = [events(spark, sf_dir).agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))]
    ends.append(table(spark, sf_dir, "orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")))
    both = ends[0].unionByName(ends[1]).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return both.select(ts("lo").alias("first"), ts("hi").alias("last"))


@query(
    "a8_history_mean",
    f"SELECT {R('avg(value)')} AS mean, {R('''avg(value) FILTER (ts < TIMESTAMP '2024-01-20 00:00:00')''')} AS before FROM events",
)
def a8_history_mean(spark, sf_dir):
    e = events(spark, sf_dir)
    past = metrics.history_mean(e, "ts", "value", datetime(2024, 1, 20)).select(r("mean").alias("before"))
    return metrics.history_mean(e, "ts", "value").select(r("mean").alias("mean")).crossJoin(F.broadcast(past))


# -- gini ------------------------------------------------------------------------------------

_GINI_COLUMNS = {"user_id": "user_id", "hour": "hour(ts)", "x": MASKED}
_GINI_AREA = "(sum(a * (n - {r} + 1)) / sum(a) - (max(n) + 1) / 2) / max(n)"


def _gini_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, event_id, value AS a, CAST({c} AS DOUBLE) AS p FROM events" for n, c in _GINI_COLUMNS.items()
    )
    area = _GINI_AREA
    return f"""WITH l AS (SELECT * FROM ({long}) WHERE p IS NOT NULL),
    k AS (SELECT feature, a, count(*) OVER (PARTITION BY feature) AS n,
        rank() OVER (PARTITION BY feature ORDER BY p) + (count(*) OVER (PARTITION BY feature, p) - 1) / 2 AS r,
        rank() OVER (PARTITION BY feature ORDER BY a) + (count(*) OVER (PARTITION BY feature, a) - 1) / 2 AS b FROM l)
    SELECT feature, {R(f"abs({area.format(r='r')} / ({area.format(r='b')}))")} AS gini FROM k GROUP BY feature"""


def _gini(spark, sf_dir):
    e = masked(events(spark, sf_dir)).select("event_id", "value", "user_id", F.hour("ts").alias("hour"), "x")
    return metrics.gini_table(e, "value", list(_GINI_COLUMNS))


@query(
    "a9_gini",
    f"""WITH k AS (SELECT value AS a, count(*) OVER () AS n,
        row_number() OVER (ORDER BY CAST(user_id AS DOUBLE), event_id NULLS FIRST, value NULLS FIRST) AS r,
        row_number() OVER (ORDER BY value NULLS FIRST, event_id NULLS FIRST) AS b FROM events WHERE user_id IS NOT NULL)
    SELECT {R(f"abs({_GINI_AREA.format(r='r')} / ({_GINI_AREA.format(r='b')}))")} AS gini FROM k HAVING count(*) > 0""",
)
def a9_gini(spark, sf_dir):
    """Every event has a place of its own: (user, event) against (value, event)."""
    e = events(spark, sf_dir)
    return metrics.gini_table(e, "value", ["user_id"], key="event_id").select(r("gini").alias("gini"))


@query("a10_gini_table", _gini_sql())
def a10_gini_table(spark, sf_dir):
    return _gini(spark, sf_dir).select("feature", r("gini").alias("gini"))


@query("o2_top_features", f"SELECT * FROM ({_gini_sql()}) WHERE feature <> 'user_id' ORDER BY gini DESC LIMIT 10")
def o2_top_features(spark, sf_dir):
    return metrics.top_features(_gini(spark, sf_dir), ["user_id"]).select("feature", r("gini").alias("gini"))


# -- regression and classification metrics ------------------------------------------------------

_Y, _P = "l_extendedprice", "(l_quantity * 1500)"


@query(
    "a11_regression_metrics",
    f"""SELECT l_returnflag, {R(f'avg(({_Y} - {_P}) ** 2)', 2)} AS mse, {R(f'sqrt(avg(({_Y} - {_P}) ** 2))', 4)} AS rmse,
    {R(f'avg(abs({_Y} - {_P}))', 4)} AS mae, {R(f'1 - sum(({_Y} - {_P}) ** 2) / (var_pop({_Y}) * count(*))')} AS r2 FROM lineitem GROUP BY l_returnflag""",
)
def a11_regression_metrics(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", (F.col("l_quantity") * 1500).alias("p"))
    out = metrics.evaluate(li, "l_extendedprice", "p", by=["l_returnflag"])
    return out.select("l_returnflag", r("mse", 2).alias("mse"), r("rmse", 4).alias("rmse"), r("mae", 4).alias("mae"), r("r2").alias("r2"))


# labelled documents: quality is the class, a logistic function of the length its probability
SCORED_SQL = "SELECT quality AS y, toxic AS named, round(1 / (1 + exp(-(n_chars - 800) / 400.0)), 5) AS p FROM labels JOIN documents USING (doc_id)"


def scored(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    p = F.round(1 / (1 + F.exp(-(F.col("n_chars") - 800) / 400.0)), 5)
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        F.col("quality").alias("y"), F.col("toxic").alias("named"), p.alias("p"), (1 - p).alias("q")
    )


# rank form of the area: mean rank of positives
_AUC = """SELECT (sum(CASE WHEN y = {c} THEN rk END) - count(*) FILTER (y = {c}) * (count(*) FILTER (y = {c}) + 1) / 2)
    / (count(*) FILTER (y = {c}) * count(*) FILTER (y <> {c})) AS auc
    FROM (SELECT y, rank() OVER (ORDER BY {s}) + (count(*) OVER (PARTITION BY {s}) - 1) / 2 AS rk FROM d)"""


@query(
    "a12_classification_metrics",
    f"""WITH d AS ({SCORED_SQL}),
    k AS (SELECT cls, count(*) FILTER (y = cls) AS s, count(*) FILTER (named = cls) AS m, count(*) FILTER (y = cls AND named = cls) AS h
        FROM d, (VALUES (0), (1)) v(cls) GROUP BY cls),
    l AS (SELECT -avg(ln(greatest(2.220446049250313e-16, least(1 - 2.220446049250313e-16, CASE WHEN y = 1 THEN p ELSE 1 - p END)))) AS ll FROM d),
    a AS (SELECT avg(auc) AS auc FROM ({_AUC.format(c=1, s='p')} UNION ALL {_AUC.format(c=0, s='1 - p')}))
    SELECT {R('sum(h) / sum(s)')} AS accuracy, {R('sum(s * CASE WHEN m = 0 THEN 0 ELSE h / m END) / sum(s)')} AS precision,
    {R('sum(s * CASE WHEN s = 0 THEN 0 ELSE h / s END) / sum(s)')} AS recall, {R('sum(s * CASE WHEN s + m = 0 THEN 0 ELSE 2 * h / (s + m) END) / sum(s)')} AS f1,
    {R('(SELECT ll FROM l)')} AS log_loss, {R('(SELECT auc FROM a)')} AS auc FROM k""",
)
def a12_classification_metrics(spark, sf_dir):
    out = metrics.classification_report(scored(spark, sf_dir), "y", "named", {0: "q", 1: "p"})
    return rounded(out, [], list(metrics.CLASS_REPORT))


@query(
    "a13_capacity_error",
    f"""WITH d AS (SELECT l_returnflag, round(l_discount * 100) AS y, round(l_tax * 100) AS p FROM lineitem)
    SELECT l_returnflag, {R('avg(CASE WHEN y = 0 THEN abs(p) / 147 ELSE abs(p - y) / abs(y) END)')} AS error,
    {R('sum(CASE WHEN y = 0 THEN NULL WHEN abs(p - y) / abs(y) > 0.25 THEN abs(y - CASE WHEN y > p THEN 1.25 * p ELSE 0.75 * p END) ELSE 0 END)', 4)} AS excess
    FROM d GROUP BY l_returnflag""",
)
def a13_capacity_error(spark, sf_dir):
    d = table(spark, sf_dir, "lineitem").select("l_returnflag", F.round(F.col("l_discount") * 100).alias("y"), F.round(F.col("l_tax") * 100).alias("p"))
    y, p = F.col("y"), F.col("p")
    out = d.groupBy("l_returnflag").agg(metrics.capacity_error(y, p).alias("error"), F.sum(metrics.deviation_excess(y, p)).alias("excess"))
    return out.select("l_returnflag", r("error").alias("error"), r("excess", 4).alias("excess"))


@query("a15_confusion", f"WITH d AS ({SCORED_SQL}) SELECT y AS actual, named AS predicted, count(*) AS n, {R('count(*) / sum(count(*)) OVER (PARTITION BY y)')} AS share FROM d GROUP BY y, named")
def a15_confusion(spark, sf_dir):
    out = metrics.confusion_share(scored(spark, sf_dir), "y", "named")
    return out.select("actual", "predicted", "n", r("share").alias("share"))


@query(
    "a16_roc",
    f"""WITH d AS ({SCORED_SQL}), c AS (SELECT p AS score, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y <> 1) AS neg FROM d GROUP BY p)
    SELECT score, {R('sum(neg) OVER w / (SELECT sum(neg) FROM c)')} AS fpr, {R('sum(pos) OVER w / (SELECT sum(pos) FROM c)')} AS tpr
    FROM c WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)""",
)
def a16_roc(spark, sf_dir):
    return rounded(metrics.roc_points(scored(spark, sf_dir), F.col("y") == 1, "p"), ["score"], ["fpr", "tpr"])


@query(
    "a16_auc_table",
    f"""WITH d AS ({SCORED_SQL}), one AS ({_AUC.format(c=1, s='p')}), zero AS ({_AUC.format(c=0, s='1 - p')}),
    pooled AS (SELECT CASE WHEN y = 1 THEN 1 ELSE 0 END AS y, p AS s FROM d UNION ALL SELECT CASE WHEN y = 0 THEN 1 ELSE 0 END, 1 - p FROM d),
    counts AS (SELECT round(s, 9) AS s, sum(y) AS pos, count(*) - sum(y) AS neg FROM pooled GROUP BY round(s, 9)),
    steps AS (SELECT neg * (sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) - pos / 2) AS area, pos, neg FROM counts)
    SELECT '0' AS cls, {R('auc')} AS auc FROM zero UNION ALL SELECT '1', {R('auc')} FROM one
    UNION ALL SELECT 'macro', {R('((SELECT auc FROM one) + (SELECT auc FROM zero)) / 2')}
    UNION ALL SELECT 'micro', {R('sum(area) / (sum(pos) * sum(neg))')} FROM steps""",
)
def a16_auc_table(spark, sf_dir):
    d = scored(spark, sf_dir).withColumn("q", F.round("q", 9))
    return metrics.auc_table(d, "y", {0: "q", 1: "p"}).select("cls", r("auc").alias("auc"))


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a17_correlation",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {R(f'corr({a}, {b})')} AS corr FROM lineitem" for a in _CORR for b in _CORR),
)
def a17_correlation(spark, sf_dir):
    return metrics.correlation_table(table(spark, sf_dir, "lineitem"), _CORR).select("a", "b", r("corr").alias("corr"))


@query("a18_median_half", "SELECT event_id, ntile(2) OVER (ORDER BY value, event_id) - 1 AS half FROM events")
def a18_median_half(spark, sf_dir):
    return sampling.median_half(events(spark, sf_dir), "value", ["event_id"]).select("event_id", "half")


@query(
    "a19_box_summary",
    f"""SELECT l_returnflag, min(l_extendedprice) AS low, {R('quantile_cont(l_extendedprice, 0.25)', 4)} AS q1, {R('quantile_cont(l_extendedprice, 0.5)', 4)} AS median,
    {R('quantile_cont(l_extendedprice, 0.75)', 4)} AS q3, max(l_extendedprice) AS high, count(*) AS n FROM lineitem GROUP BY l_returnflag""",
)
def a19_box_summary(spark, sf_dir):
    out = metrics.box_summary(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_extendedprice")
    return out.select("l_returnflag", "low", r("q1", 4).alias("q1"), r("median", 4).alias("median"), r("q3", 4).alias("q3"), "high", "n")


_KDE_STATS = "SELECT min(value) AS lo, max(value) AS hi, stddev_samp(value) * pow(count(*), -0.2) AS h, count(*) AS n FROM events"


@query(
    "a20_density",
    f"""WITH s AS ({_KDE_STATS}), g AS (SELECT i, lo - 3 * h + i * (hi - lo + 6 * h) / 99 AS x, h FROM s, range(100) t(i))
    SELECT {R('x')} AS x, {R('avg(exp(-(value - x) * (value - x) / (2 * h * h))) / (max(h) * sqrt(2 * pi()))', 9)} AS density
    FROM g, events GROUP BY x""",
)
def a20_density(spark, sf_dir):
    out = metrics.density_grid(events(spark, sf_dir), "value")
    return out.select(r("x").alias("x"), r("density", 9).alias("density"))


@query(
    "a21_histogram",
    f"""WITH m AS (SELECT min(value) AS lo, (max(value) - min(value)) / 50 AS w, count(*) AS t FROM events)
    SELECT CAST(least(49, floor((value - lo) / w)) AS INTEGER) AS bin, count(*) AS n, {R('count(*) / (max(t) * max(w))', 9)} AS density FROM events, m GROUP BY 1""",
)
def a21_histogram(spark, sf_dir):
    return metrics.histogram(events(spark, sf_dir), "value").select("bin", "n", r("density", 9).alias("density"))


@query(
    "a23_profile",
    """SELECT unnest(['x', 'kind', 'zero']) AS name, unnest([count(*) - count(x), 0, 0]) AS nulls,
    unnest([count(DISTINCT x), count(DISTINCT kind), 1]) AS distinct_values, unnest([count(DISTINCT x) <= 1, count(DISTINCT kind) <= 1, true]) AS is_constant,
    unnest([coalesce(bool_and(x = 0), false), false, true]) AS is_zero FROM (SELECT CASE WHEN value < 1 THEN NULL ELSE value END AS x, event_type AS kind FROM events)""",
)
def a23_profile(spark, sf_dir):
    e = masked(events(spark, sf_dir)).select("x", F.col("event_type").alias("kind"), (F.col("value") * 0).alias("zero"))
    return metrics.profile(e, ["x", "kind", "zero"])


# -- sort and top-k -------------------------------------------------------------------------------


@query("o1_sort_by_time", f"SELECT event_id, {TS('ts')} AS t FROM events ORDER BY ts, event_id")
def o1_sort_by_time(spark, sf_dir):
    return events(spark, sf_dir).orderBy("ts", "event_id").select("event_id", ts("ts").alias("t"))


@query("o4_latest_rows", "SELECT event_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 500")
def o4_latest_rows(spark, sf_dir):
    return sampling.latest_rows(events(spark, sf_dir), "ts", ["event_id"], 500).select("event_id", "value")


@query(
    "o5_uncertain_rows",
    f"SELECT l_orderkey, l_partkey, {R('abs(l_extendedprice - l_quantity * 1500)', 4)} AS uncertainty FROM lineitem ORDER BY abs(l_extendedprice - l_quantity * 1500) DESC, l_orderkey, l_partkey LIMIT 500",
)
def o5_uncertain_rows(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    out = sampling.uncertain_rows(li, F.abs(F.col("l_extendedprice") - F.col("l_quantity") * 1500), ["l_orderkey", "l_partkey"], 500)
    return out.select("l_orderkey", "l_partkey", r("uncertainty", 4).alias("uncertainty"))


_KNN_SQL = """SELECT vec_id, avg(d) AS distance FROM (SELECT a.vec_id, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS d,
    row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) AS rn
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE rn <= 5 GROUP BY vec_id"""


@query("o6_density_rows", f"SELECT vec_id, {R('distance')} AS distance FROM ({_KNN_SQL}) ORDER BY distance DESC, vec_id LIMIT 100")
def o6_density_rows(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    columns = [f"e{i}" for i in range(64)]
    wide = emb.select("vec_id", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(columns)])
    out = sampling.density_sample(wide, "vec_id", columns, 100, 5)
    return out.select("vec_id", r("distance").alias("distance"))


@query(
    "o9_first_rows_from_origin",
    """SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn
    FROM events WHERE ts >= TIMESTAMP '2024-01-20 08:00:00') WHERE rn <= 96""",
)
def o9_first_rows_from_origin(spark, sf_dir):
    from vanecast.operators.ordered import first_rows_per_group

    late = events(spark, sf_dir).where("ts >= TIMESTAMP '2024-01-20 08:00:00'")
    return first_rows_per_group(late, ["event_type"], ["ts", "event_id"], F.lit(96)).select("event_type", "event_id")
