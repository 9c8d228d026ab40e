"""Streaming queries: the given tables as file streams, and the batch twins of their aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from vanecast.catalog.base import Q15, R, TS, events, query, r, table, ts
from vanecast.catalog.joining import ISSUE, VINTAGES_SQL, vintages
from vanecast.operators import summary, weather
from vanecast.plans import model
from vanecast.session import scratch_path
from vanecast.sources import readers, sinks
from vanecast.streaming import jobs


def stream_of(spark, sf_dir, name):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return jobs.new_files(spark, sf_dir, schema, "parquet", f"{name}.parquet")


def paths(spark, label):
    return scratch_path(spark, label), scratch_path(spark, f"{label}-checkpoint")


@query("st1_new_files", "SELECT event_id, user_id, value FROM events")
def st1_new_files(spark, sf_dir):
    """Two deliveries into one folder; each run of the query reads only what is new."""
    e = events(spark, sf_dir).select("event_id", "user_id", "value")
    folder, (out, checkpoint) = scratch_path(spark, "arrivals"), paths(spark, "ingested")
    for part in ("value < 20", "value >= 20"):
        sinks.append_csv(e.where(part), folder)
        jobs.to_table(jobs.new_files(spark, folder, e.schema), out, checkpoint)
    return spark.read.schema(e.schema).parquet(out)


_QUARTERS = f"SELECT {TS(Q15('ts'))} AS start, event_type, {R('avg(value)')} AS mean, count(*) AS n FROM events GROUP BY ALL"


def _quarters(df):
    return df.select(ts("start").alias("start"), "event_type", r("mean").alias("mean"), "n")


@query("st2_quarter_means", _QUARTERS)
def st2_quarter_means(spark, sf_dir):
    return _quarters(jobs.quarter_means(events(spark, sf_dir), "ts", ["event_type"], "value"))


def _to_the_end(spark, sf_dir, label, windows):
    """Windows of the whole event stream: a delivery after the last file closes those still open."""
    closing, (out, checkpoint) = scratch_path(spark, f"{label}-closing"), paths(spark, label)
    rows = stream_of(spark, sf_dir, "events")
    sinks.append(spark.createDataFrame([], rows.schema), closing)
    last = events(spark, sf_dir).agg(F.max("ts").alias("last")).first()["last"]
    result = windows(jobs.event_time(jobs.with_closing(rows, spark, closing), "ts"))
    end = F.lit(last).cast("timestamp") + F.expr("INTERVAL '1' DAY")  # farther than the delay and the longest window
    jobs.to_table_closed(result, out, checkpoint, lambda: sinks.append(jobs.closing_row(rows.schema, spark, "ts", end), closing))
    return spark.read.schema(result.schema).parquet(out)


@query("st2_quarter_means_stream", _QUARTERS)
def st2_quarter_means_stream(spark, sf_dir):
    return _quarters(_to_the_end(spark, sf_dir, "quarters", lambda rows: jobs.quarter_means(rows, "ts", ["event_type"], "value")))


_SLIDING = f"""WITH q AS (SELECT event_type, {Q15('ts')} AS q, sum(value) AS s, count(*) AS c FROM events GROUP BY ALL),
    w AS (SELECT event_type, q + to_minutes(CAST(15 * (k + 1) AS INTEGER)) AS until, s, c FROM q, range(16) r(k))
    SELECT {TS('until')} AS until, event_type, {R('sum(s) / sum(c)')} AS mean, CAST(sum(c) AS BIGINT) AS n FROM w GROUP BY until, event_type"""


@query("st3_sliding_means", _SLIDING)
def st3_sliding_means(spark, sf_dir):
    out = jobs.sliding_means(events(spark, sf_dir), "ts", ["event_type"], "value")
    return out.select(ts("until").alias("until"), "event_type", r("mean").alias("mean"), "n")


@query("st3_sliding_means_stream", _SLIDING)
def st3_sliding_means_stream(spark, sf_dir):
    out = _to_the_end(spark, sf_dir, "sliding", lambda rows: jobs.sliding_means(rows, "ts", ["event_type"], "value"))
    return out.select(ts("until").alias("until"), "event_type", r("mean").alias("mean"), "n")


@query("st4_label_append", f"SELECT user_id, {TS('ts')} AS date_time, value AS power FROM events")
def st4_label_append(spark, sf_dir):
    """Every event is delivered twice; each label is stored once."""
    e = events(spark, sf_dir).select("user_id", "ts", "value")
    folder = scratch_path(spark, "twice")
    sinks.append(e.unionByName(e), folder)
    labels = jobs.label_stream(jobs.new_files(spark, folder, e.schema, "parquet"), "ts", ["user_id"], "value")
    out, checkpoint = paths(spark, "labels")
    jobs.append_once(labels, out, checkpoint)
    return spark.read.parquet(out).select("user_id", ts("date_time").alias("date_time"), "power")


@query(
    "st5_score_monitor",
    f"""SELECT l_returnflag, count(*) AS n, {R('1 - sum((l_extendedprice - l_quantity * 1500) ** 2) / (var_pop(l_extendedprice) * count(*))')} AS r2,
    1 - sum((l_extendedprice - l_quantity * 1500) ** 2) / (var_pop(l_extendedprice) * count(*)) < 0.85 AS drift FROM lineitem GROUP BY l_returnflag""",
)
def st5_score_monitor(spark, sf_dir):
    rows = stream_of(spark, sf_dir, "lineitem").withColumn("p", F.col("l_quantity") * 1500)
    out, checkpoint = paths(spark, "status")
    jobs.keep_status(jobs.score_monitor(rows, "l_returnflag", "l_extendedprice", "p"), out, checkpoint)
    return jobs.latest_status(spark, out, "l_returnflag").select("l_returnflag", "n", r("r2").alias("r2"), "drift")


_IDLE_R2 = "1 - sum((value - 25) ** 2) / (var_pop(value) * count(*))"


@query(
    "st5_idle_keys",
    f"""SELECT user_id, n, r2, drift, last + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AS expired, {TS('last')} AS last FROM (
    SELECT user_id, count(*) AS n, CASE WHEN var_pop(value) > 0 THEN {R(_IDLE_R2)} END AS r2,
    CASE WHEN var_pop(value) > 0 THEN {_IDLE_R2} < 0.85 END AS drift, max(ts) AS last FROM events GROUP BY user_id)""",
)
def st5_idle_keys(spark, sf_dir):
    """Scores per user; users without an event in the last day are reported as expired and forgotten."""
    rows = stream_of(spark, sf_dir, "events").withColumn("p", F.lit(25.0))
    out, checkpoint = paths(spark, "idle")
    scored = jobs.score_monitor_until_idle(rows, "user_id", "ts", "value", "p", ttl="1 day")
    jobs.keep_status(scored, out, checkpoint, key="user_id")
    return jobs.latest_status(spark, out, "user_id").select(
        "user_id", "n", r("r2").alias("r2"), "drift", "expired", ts("last").alias("last")
    )


@query(
    "st6_stream_static_join",
    f"""WITH v AS ({VINTAGES_SQL}) SELECT event_id, {R('v.speed')} AS speed FROM events e LEFT JOIN v
    ON v.target = {Q15('e.ts')} + INTERVAL 240 MINUTE AND v.issue = {ISSUE(Q15('e.ts'))}""",
)
def st6_stream_static_join(spark, sf_dir):
    v = vintages(spark, sf_dir).drop("humidity")
    latest = F.lit(v.agg(F.max("issue")).first()[0])
    rows = stream_of(spark, sf_dir, "events").withColumn("t", F.window("ts", "15 minutes")["start"].cast("timestamp"))
    joined = jobs.join_static(rows.select("event_id", "t"), v, "t", 240, weather.issue_published("t", latest)).select("event_id", "speed")
    out, checkpoint = paths(spark, "joined")
    jobs.to_table(joined, out, checkpoint)
    return spark.read.schema(joined.schema).parquet(out).select("event_id", r("speed").alias("speed"))


@query(
    "st7_retrain_on_drift",
    f"""SELECT CAST(0 AS BIGINT) AS seq, 'incremental' AS training_type, 'success' AS state, true AS drift, o_orderkey, {R('a + b * o_custkey', 2)} AS y_pred
    FROM orders, (SELECT regr_slope(o_totalprice, o_custkey) AS b, regr_intercept(o_totalprice, o_custkey) AS a FROM orders)""",
)
def st7_retrain_on_drift(spark, sf_dir):
    """New orders against the customers' balances: the batch drifts, so a model is trained, stored and used."""
    store = summary.SummaryStore(spark, scratch_path(spark, "balances"))
    store.start(summary.summarise(table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("amount")), ["amount"]))
    rows = stream_of(spark, sf_dir, "orders").select("o_custkey", F.col("o_totalprice").alias("amount"))
    out, checkpoint = paths(spark, "runs")
    trained = scratch_path(spark, "trained")

    def train(batch, number):
        sinks.save_model(model.fit(batch, "linear", ["o_custkey"], "amount"), f"{trained}/{number}")

    jobs.retrain_on_drift(rows, lambda b, n: summary.check_batch(store, n, b, "ttest", ["amount"]), train, out, checkpoint)
    runs = spark.read.parquet(out).select("seq", "training_type", "state", "drift")
    newest = runs.where("drift").agg(F.max("seq")).first()[0]
    scored = model.predict(readers.load_model(f"{trained}/{newest}"), table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    return runs.crossJoin(scored.select("o_orderkey", r("y_pred", 2).alias("y_pred")))
