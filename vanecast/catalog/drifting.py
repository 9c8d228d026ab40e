"""Drift queries: the first half of the month is history, the second half is new."""

from __future__ import annotations

from pyspark.sql import functions as F

from vanecast.catalog.aggregates import SCORED_SQL, scored
from vanecast.catalog.base import R, events, query, r, rounded, table
from vanecast.operators import drift, summary
from vanecast.session import materialize, scratch_path

_CUT = "ts < TIMESTAMP '2024-01-16 00:00:00'"


def halves(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("hour", F.hour("ts"))
    return e.where(_CUT), e.where(f"NOT ({_CUT})")


@query("a22_contingency", f"SELECT event_type AS category, count(*) FILTER ({_CUT}) AS n0, count(*) FILTER (NOT ({_CUT})) AS n1 FROM events GROUP BY event_type")
def a22_contingency(spark, sf_dir):
    return drift.contingency(*halves(spark, sf_dir), "event_type")


_CHI = f"""WITH c AS (SELECT event_type, count(*) FILTER ({_CUT}) AS n0, count(*) FILTER (NOT ({_CUT})) AS n1 FROM events GROUP BY event_type),
    t AS (SELECT sum(n0) AS t0, sum(n1) AS t1, sum(n0) + sum(n1) AS t FROM c)
    SELECT sum((n0 - (n0 + n1) * t0 / t) ** 2 / ((n0 + n1) * t0 / t) + (n1 - (n0 + n1) * t1 / t) ** 2 / ((n0 + n1) * t1 / t)) AS statistic,
    CAST(count(*) - 1 AS DOUBLE) AS dof FROM c, t"""


@query("dr1_chi_square", f"SELECT 'event_type' AS name, {R('statistic')} AS statistic, dof FROM ({_CHI})")
def dr1_chi_square(spark, sf_dir):
    return rounded(drift.chi_square(*halves(spark, sf_dir), "event_type"), ["name", "dof"], ["statistic"])


def _welch(c: str) -> str:
    a, b = f"FILTER ({_CUT})", f"FILTER (NOT ({_CUT}))"
    q0, q1 = f"(var_samp({c}) {a} / count(*) {a})", f"(var_samp({c}) {b} / count(*) {b})"
    return f"""SELECT '{c}' AS name, {R(f'(avg({c}) {a} - avg({c}) {b}) / sqrt({q0} + {q1})')} AS statistic,
    {R(f'({q0} + {q1}) ** 2 / ({q0} ** 2 / (count(*) {a} - 1) + {q1} ** 2 / (count(*) {b} - 1))', 4)} AS dof FROM (SELECT ts, value, user_id FROM events)"""


@query("dr2_welch", f"{_welch('value')} UNION ALL {_welch('user_id')}")
def dr2_welch(spark, sf_dir):
    out = drift.welch(*halves(spark, sf_dir), ["value", "user_id"])
    return out.select("name", r("statistic").alias("statistic"), r("dof", 4).alias("dof"))


@query(
    "dr3_js_distance",
    f"""WITH m AS (SELECT min(value) AS lo, (max(value) - min(value)) / 50 AS w, count(*) FILTER ({_CUT}) AS t0, count(*) FILTER (NOT ({_CUT})) AS t1 FROM events),
    b AS (SELECT least(49, floor((value - lo) / w)) AS bin, count(*) FILTER ({_CUT}) / max(t0) AS p, count(*) FILTER (NOT ({_CUT})) / max(t1) AS q FROM events, m GROUP BY 1)
    SELECT 'value' AS name, {R('sqrt(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)')} AS statistic FROM b""",
)
def dr3_js_distance(spark, sf_dir):
    return rounded(drift.js_distance(*halves(spark, sf_dir), "value"), ["name"], ["statistic"])


@query("dr4_text_clusters")
def dr4_text_clusters(spark, sf_dir):
    """English documents are history, the other languages are new."""
    d = table(spark, sf_dir, "documents")
    known = F.col("lang") == "en"
    return rounded(drift.cluster_distance(d.where(known), d.where(~known), "text"), ["name"], ["statistic"])


@query("dr5_performance", f"WITH d AS ({SCORED_SQL}) SELECT {R('avg(CASE WHEN y = named THEN 1.0 ELSE 0.0 END)')} AS statistic, avg(CASE WHEN y = named THEN 1.0 ELSE 0.0 END) < 0.85 AS drift FROM d")
def dr5_performance(spark, sf_dir):
    return rounded(drift.performance(scored(spark, sf_dir), "y", "named", classification=True), ["drift"], ["statistic"])


def _r2_sql(where: str) -> str:
    return f"SELECT 1 - sum((l_extendedprice - l_quantity * 1500) ** 2) / (var_pop(l_extendedprice) * count(*)) AS s FROM lineitem WHERE {where}"


@query(
    "dr6_performance_change",
    f"""WITH h AS ({_r2_sql("l_shipdate < TIMESTAMP '1998-01-01 00:00:00'")}), n AS ({_r2_sql("l_shipdate >= TIMESTAMP '1998-01-01 00:00:00'")})
    SELECT {R('n.s')} AS statistic, {R('h.s')} AS history_statistic, n.s < 0.5 OR n.s < h.s AS drift FROM n, h""",
)
def dr6_performance_change(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("p", F.col("l_quantity") * 1500)
    early = F.expr("l_shipdate < TIMESTAMP '1998-01-01 00:00:00'")
    out = drift.performance_change(li.where(early), li.where(~early), "l_extendedprice", "p", threshold=0.5)
    return rounded(out, ["drift"], ["statistic", "history_statistic"])


def stored(spark, sf_dir, numeric=(), categorical=()):
    """Summaries of both halves; the history comes in two deliveries and is read back from its store."""
    history, new = halves(spark, sf_dir)
    store = summary.SummaryStore(spark, scratch_path(spark, "history-states"))
    for number, part in enumerate(("hour < 12", "hour >= 12")):
        store.advance(number, summary.summarise(history.where(part), numeric, categorical))
    # written, as the tests read it several times
    return store.state(1), materialize(summary.summarise(new, numeric, categorical), "new-summary")


@query(
    "dr3_stored_distance",
    f"""WITH l AS (SELECT c, v, ts FROM (SELECT ts, value, CAST(user_id AS DOUBLE) AS user_id FROM events) UNPIVOT (v FOR c IN (value, user_id))),
    m AS (SELECT c, pow(2, ceil(log2((max(v) - min(v)) / 64))) AS w, count(*) FILTER ({_CUT}) AS t0, count(*) FILTER (NOT ({_CUT})) AS t1 FROM l GROUP BY c),
    b AS (SELECT c, floor(v / w) AS bin, count(*) FILTER ({_CUT}) / max(t0) AS p, count(*) FILTER (NOT ({_CUT})) / max(t1) AS q FROM l JOIN m USING (c) GROUP BY 1, 2)
    SELECT c AS name, {R('sqrt(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)')} AS statistic FROM b GROUP BY c""",
)
def dr3_stored_distance(spark, sf_dir):
    """Histograms of a stored history and of new rows, on steps both share."""
    return rounded(summary.js_distance(*stored(spark, sf_dir, ["value", "user_id"])), ["name"], ["statistic"])


@query(
    "dr7_stored_detect",
    f"""SELECT name, 'ttest' AS method, statistic FROM ({_welch('value')} UNION ALL {_welch('user_id')}) UNION ALL SELECT 'event_type', 'chi', {R('statistic')} FROM ({_CHI})""",
)
def dr7_stored_detect(spark, sf_dir):
    """Tests of all columns out of one stored summary per side."""
    history, new = stored(spark, sf_dir, ["value", "user_id"], ["event_type"])
    out = summary.detect(history, new, "ttest").unionByName(summary.detect(history, new, "chi"))
    return rounded(out, ["name", "method"], ["statistic"])


@query(
    "dr7_detect",
    f"""SELECT name, 'ttest' AS method, statistic FROM ({_welch('value')} UNION ALL {_welch('user_id')}) UNION ALL SELECT 'event_type', 'chi', {R('statistic')} FROM ({_CHI})""",
)
def dr7_detect(spark, sf_dir):
    history, new = halves(spark, sf_dir)
    out = drift.detect(history, new, "ttest", ["value", "user_id"]).unionByName(drift.detect(history, new, "chi", ["event_type"]))
    return rounded(out, ["name", "method"], ["statistic"])


@query("dr7_detect_flags")
def dr7_detect_flags(spark, sf_dir):
    """All tests with p-values and flags; SQL has no tail functions for the p-values."""
    history, new = halves(spark, sf_dir)
    shifted = new.withColumn("moved", F.col("value") * 1.2)
    past = history.withColumn("moved", F.col("value"))
    out = drift.detect(past, shifted, "ttest", ["value", "moved"])
    out = out.unionByName(drift.detect(past, shifted, "kl", ["value", "moved"])).unionByName(drift.detect(past, shifted, "chi", ["event_type"]))
    return rounded(out, ["name", "method", "dof", "drift"], ["statistic", "p"])
