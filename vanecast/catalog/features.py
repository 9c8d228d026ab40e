"""Scalar, group-statistic and window feature queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from vanecast.catalog.base import CLIP, MASKED, R, events, masked, query, r, rounded, table
from vanecast.functions import calendar, registry, scalar
from vanecast.functions.registry import Feature, FeatureSet
from vanecast.operators import groupstat
from vanecast.operators.groupstat import GroupStat
from vanecast.operators.window import Ewm, Rolling, ewm_features, rolling_features, row_lead

# -- row-local ----------------------------------------------------------------------

# centred value: negative, zero and positive arguments
_Z = "(value - 50)"
_ONE = {
    "f1_sine": ("sine", f"sin{_Z}"),
    "f2_cosine": ("cosine", f"cos{_Z}"),
    "f3_pow": ("pow", CLIP(f"{_Z} * {_Z}")),
    "f4_log": ("log", f"CASE WHEN {_Z} = 0 THEN -1e7 ELSE ln(abs(CASE WHEN {_Z} = 0 THEN 1 ELSE {_Z} END)) END"),
    "f5_sigmoid": ("sigmoid", f"1 / (1 + exp(-{_Z}))"),
    "f6_relu": ("relu", f"greatest({_Z}, 0)"),
    "f7_tanh": ("tanh", f"tanh{_Z}"),
}


def _one(name: str, op: str, sql: str) -> None:
    @query(name, f"SELECT event_id, {R(sql)} AS feature FROM events")
    def run(spark, sf_dir):
        e = events(spark, sf_dir).withColumn("z", F.col("value") - 50)
        return e.select("event_id", r(registry.ONE_NUMBER[op]("z")).alias("feature"))


for _name, (_op, _sql) in _ONE.items():
    _one(_name, _op, _sql)


@query(
    "f8_softmax",
    f"""WITH m AS (SELECT max(value) AS top FROM events),
    e AS (SELECT event_id, exp(value - top) AS e FROM events, m)
    SELECT event_id, {R('e / (SELECT sum(e) FROM e)', 9)} AS feature FROM e""",
)
def f8_softmax(spark, sf_dir):
    out = registry.softmax(events(spark, sf_dir), "value", "feature")
    return out.select("event_id", r("feature", 9).alias("feature"))


# two columns of line items, grouped to keep the result small but computed on every row
_TWO = {
    "f9_add": ("add", "l_discount + l_tax"),
    "f10_sub": ("sub", "l_discount - l_tax"),
    "f11_mul": ("mul", CLIP("l_extendedprice * l_extendedprice")),
    "f12_div": (
        "div",
        "CASE WHEN l_tax = 0 THEN CASE WHEN l_discount = 0 THEN NULL ELSE 1e7 END ELSE "
        + CLIP("l_discount / CASE WHEN l_tax = 0 THEN 1 ELSE l_tax END")
        + " END",
    ),
    "f13_std": ("std", "abs(l_discount - l_tax) / sqrt(2)"),
    "f14_maximize": ("maximize", "greatest(l_discount, l_tax)"),
}


def _two(name: str, op: str, sql: str) -> None:
    @query(
        name,
        f"""SELECT l_discount, l_tax, {R(f'min({sql})', 4)} AS low, {R(f'max({sql})', 4)} AS high,
        count({sql}) AS known, {R(f'avg({sql})', 4)} AS mean FROM lineitem GROUP BY l_discount, l_tax""",
    )
    def run(spark, sf_dir):
        a, b = ("l_extendedprice", "l_extendedprice") if op == "mul" else ("l_discount", "l_tax")
        rows = table(spark, sf_dir, "lineitem").withColumn("v", registry.TWO_NUMBERS[op](a, b))
        out = rows.groupBy("l_discount", "l_tax").agg(
            F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("known"), F.avg("v").alias("mean")
        )
        return out.select("l_discount", "l_tax", r("low", 4).alias("low"), r("high", 4).alias("high"), "known", r("mean", 4).alias("mean"))


for _name, (_op, _sql) in _TWO.items():
    _two(_name, _op, _sql)

_CALENDAR = """year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour, minute(ts) AS minute,
    second(ts) AS second, isodow(ts) - 1 AS dayofweek, dayofyear(ts) AS dayofyear, quarter(ts) AS quarter"""


@query("f15_calendar", f"SELECT event_id, {_CALENDAR} FROM events")
def f15_calendar(spark, sf_dir):
    return calendar.add_calendar(events(spark, sf_dir), "ts").select("event_id", *calendar.PARTS)


@query(
    "f16_varying_calendar",
    f"""SELECT part, values FROM (UNPIVOT (SELECT count(DISTINCT year) AS year, count(DISTINCT month) AS month,
    count(DISTINCT day) AS day, count(DISTINCT hour) AS hour, count(DISTINCT minute) AS minute,
    count(DISTINCT second) AS second, count(DISTINCT dayofweek) AS dayofweek, count(DISTINCT dayofyear) AS dayofyear,
    count(DISTINCT quarter) AS quarter FROM (SELECT {_CALENDAR} FROM events)) ON COLUMNS(*) INTO NAME part VALUE values)
    WHERE values >= 2""",
)
def f16_varying_calendar(spark, sf_dir):
    e = events(spark, sf_dir)
    parts = calendar.varying_parts(e, "ts")
    counts = calendar.add_calendar(e, "ts", parts).agg(*[F.count_distinct(p).alias(p) for p in parts])
    cells = ", ".join(f"'{p}', `{p}`" for p in parts)
    return counts.select(F.expr(f"stack({len(parts)}, {cells}) as (part, values)"))


@query(
    "f17_normalize",
    f"""SELECT event_id, {R('-1 + 2 * (value - (SELECT min(value) FROM events)) / (SELECT max(value) - min(value) FROM events)')}
    AS feature FROM events""",
)
def f17_normalize(spark, sf_dir):
    out = registry.normalize(events(spark, sf_dir), "value", "feature", -1.0, 1.0)
    return out.select("event_id", r("feature").alias("feature"))


# -- group statistics: fitted on the first half of the month, applied to all rows ------------

_TRAIN = "ts < TIMESTAMP '2024-01-16 00:00:00'"


def _train(e):
    return e.where("ts < TIMESTAMP '2024-01-16 00:00:00'")


def _stat(name: str, spec: GroupStat, agg: str) -> None:
    keys = ", ".join(spec.keys)
    on = " AND ".join(f"e.{k} = s.{k}" for k in spec.keys)
    number = "s.feature" if spec.op in ("count", "crosscount", "nunique") else R("s.feature")

    @query(
        name,
        f"""WITH e AS (SELECT event_id, ts, user_id, event_type, hour(ts) AS hour, value FROM events),
        s AS (SELECT {keys}, {agg} AS feature FROM e WHERE {_TRAIN} GROUP BY {keys})
        SELECT e.event_id, {number} AS feature FROM e LEFT JOIN s ON {on}""",
    )
    def run(spark, sf_dir):
        e = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", F.hour("ts").alias("hour"), "value")
        out = groupstat.fit_stats(_train(e), {"feature": spec}).transform(e)
        whole = spec.op in ("count", "crosscount", "nunique")
        return out.select("event_id", F.col("feature") if whole else r("feature").alias("feature"))


_stat("g1_count", GroupStat("count", ("user_id",)), "count(*)")
_stat("g3_crosscount", GroupStat("crosscount", ("user_id", "event_type")), "count(*)")
_stat("g4_nunique", GroupStat("nunique", ("user_id",), "hour"), "count(DISTINCT hour)")
_stat("g6_aggmean", GroupStat("aggmean", ("user_id",), "value"), "avg(value)")
_stat("g7_aggmin", GroupStat("aggmin", ("user_id", "hour"), "value"), "min(value)")
_stat("g8_aggmax", GroupStat("aggmax", ("user_id", "hour"), "value"), "max(value)")
_stat("g9_aggstd", GroupStat("aggstd", ("user_id", "event_type"), "value"), "stddev_samp(value)")


@query(
    "g2_frequency_encoder",
    f"""WITH s AS (SELECT user_id, count(*) / (SELECT count(*) FROM events WHERE {_TRAIN}) AS f FROM events WHERE {_TRAIN} GROUP BY user_id),
    t AS (SELECT event_type, count(*) / (SELECT count(*) FROM events WHERE {_TRAIN}) AS f FROM events WHERE {_TRAIN} GROUP BY event_type)
    SELECT event_id, {R('coalesce(s.f, 0)', 9)} AS user_id_freq, {R('coalesce(t.f, 0)', 9)} AS event_type_freq
    FROM events e LEFT JOIN s ON e.user_id = s.user_id LEFT JOIN t ON e.event_type = t.event_type""",
)
def g2_frequency_encoder(spark, sf_dir):
    e = events(spark, sf_dir)
    out = groupstat.encode_frequency(e, groupstat.fit_frequency(_train(e), ["user_id", "event_type"], normalize=True))
    return rounded(out, ["event_id"], ["user_id_freq", "event_type_freq"], 9)


_COMBINED = "event_type || '_' || coalesce(CASE WHEN value >= 1 THEN CAST(user_id AS VARCHAR) END, 'nan')"


@query(
    "g5_combine",
    f"""WITH e AS (SELECT event_id, {_COMBINED} AS k FROM events),
    c AS (SELECT k, row_number() OVER (ORDER BY k) - 1 AS code FROM (SELECT DISTINCT k FROM e))
    SELECT event_id, code AS feature FROM e JOIN c USING (k)""",
)
def g5_combine(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("u", F.when(F.col("value") >= 1, F.col("user_id")))
    codes = groupstat.fit_combined(e, "event_type", "u")
    return groupstat.combine(e, codes, "event_type", "u", "feature").select("event_id", "feature")


_CLASSES = f"""SELECT k, row_number() OVER (ORDER BY k) - 1 AS code FROM (
    SELECT DISTINCT coalesce(CASE WHEN value >= 1 THEN event_type END, '__NAN__') AS k FROM events WHERE {_TRAIN} AND event_type <> 'view')"""


@query(
    "g10_label_encode",
    f"""WITH c AS ({_CLASSES}), e AS (SELECT event_id, coalesce(CASE WHEN value >= 1 THEN event_type END, '__NAN__') AS k FROM events)
    SELECT event_id, coalesce(code, (SELECT count(*) FROM c)) AS code FROM e LEFT JOIN c USING (k)""",
)
def g10_label_encode(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("kind", F.when(F.col("value") >= 1, F.col("event_type")))
    classes = groupstat.fit_labels(_train(e).where("event_type <> 'view'"), "kind")
    return groupstat.encode_labels(e, classes, "kind").select("event_id", F.col("kind").alias("code"))


@query(
    "g11_label_decode",
    f"""WITH c AS ({_CLASSES}), e AS (SELECT event_id, coalesce(CASE WHEN value >= 1 THEN event_type END, '__NAN__') AS k FROM events)
    SELECT event_id, CASE WHEN c.k <> '__NAN__' THEN c.k END AS kind FROM e LEFT JOIN c USING (k)""",
)
def g11_label_decode(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("kind", F.when(F.col("value") >= 1, F.col("event_type")))
    classes = groupstat.fit_labels(_train(e).where("event_type <> 'view'"), "kind")
    coded = groupstat.encode_labels(e, classes, "kind").select("event_id", F.col("kind").alias("code"))
    return groupstat.decode_labels(coded, classes, "code", "kind").select("event_id", "kind")


@query(
    "g12_feature_set",
    f"""WITH e AS (SELECT event_id, ts, user_id, event_type, value, CASE WHEN value = 0 THEN -1e7 ELSE ln(CASE WHEN value = 0 THEN 1 ELSE value END) END AS lv FROM events),
    s AS (SELECT user_id, avg(lv) AS m, count(*) AS n FROM e WHERE {_TRAIN} GROUP BY user_id)
    SELECT event_id, {R('lv')} AS log__value, {R('s.m')} AS aggmean__user_id__log__value, s.n AS count__user_id,
    {R('lv - lag(lv, 2) OVER (PARTITION BY event_type ORDER BY ts, event_id)')} AS diff__log__value__2
    FROM e LEFT JOIN s ON e.user_id = s.user_id""",
)
def g12_feature_set(spark, sf_dir):
    e = events(spark, sf_dir)
    logged = Feature("log", ("value",))
    features = [
        logged,
        Feature("aggmean", ("user_id", logged)),
        Feature("count", ("user_id",)),
        Feature("diff", (logged,), 2),
    ]
    fitted = FeatureSet(features, ["event_type"], ["ts", "event_id"]).fit(_train(e))
    names = [f.name for f in features]
    out = fitted.transform(e)
    return out.select("event_id", *[F.col(n) if n.startswith("count") else r(n).alias(n) for n in names])


# -- rolling -----------------------------------------------------------------------------

_W = "PARTITION BY event_type ORDER BY ts, event_id"


def _rolling(name: str, spec: Rolling, sql: str) -> None:
    @query(
        name,
        f"WITH e AS (SELECT event_id, event_type, ts, {MASKED} AS x, CAST(user_id AS DOUBLE) AS y FROM events) "
        f"SELECT event_id, {R(sql)} AS feature FROM e",
    )
    def run(spark, sf_dir):
        e = masked(events(spark, sf_dir)).select("event_id", "event_type", "ts", "x", "y")
        out = rolling_features(e, ["event_type"], ["ts", "event_id"], {"feature": spec})
        return out.select("event_id", r("feature").alias("feature"))


def _over(agg: str, n: int) -> str:
    return f"{agg} OVER ({_W} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _when_full(agg: str, seen: str, n: int) -> str:
    return f"CASE WHEN {_over(f'count({seen})', n)} = {n} THEN {agg} END"


_X2, _Y2 = "CASE WHEN y IS NOT NULL THEN x END", "CASE WHEN x IS NOT NULL THEN y END"
_rolling("w1_diff", Rolling("diff", "x", 3), f"x - lag(x, 3) OVER ({_W})")
_rolling("w2_delay", Rolling("delay", "x", 4), f"lag(x, 4) OVER ({_W})")
_rolling("w3_ts_mean", Rolling("ts_mean", "x", 5), _when_full(_over("avg(x)", 5), "x", 5))
_rolling("w4_ts_std", Rolling("ts_std", "x", 5), _when_full(_over("stddev_samp(x)", 5), "x", 5))
_rolling("w5_ts_cov", Rolling("ts_cov", "x", 6, "y"), _when_full(_over(f"covar_samp({_X2}, {_Y2})", 6), _X2, 6))
_rolling(
    "w6_ts_corr",
    Rolling("ts_corr", "x", 6, "y"),
    _when_full(
        f"{_over(f'covar_samp({_X2}, {_Y2})', 6)} / nullif({_over(f'stddev_samp({_X2})', 6)} * {_over(f'stddev_samp({_Y2})', 6)}, 0)",
        _X2,
        6,
    ),
)
_rolling("w7_ts_max", Rolling("ts_max", "x", 5), _when_full(_over("max(x)", 5), "x", 5))
_rolling("w8_ts_min", Rolling("ts_min", "x", 5), _when_full(_over("min(x)", 5), "x", 5))
_rolling(
    "w9_ts_rank",
    Rolling("ts_rank", "x", 7),
    _when_full(
        f"len(list_filter({_over('list(x)', 7)}, lambda v: v < x)) + (len(list_filter({_over('list(x)', 7)}, lambda v: v = x)) + 1) / 2",
        "x",
        7,
    ),
)

# -- exponentially weighted: decayed sums over the last K rows as lists ---------------------

_SPAN = 5
_D = 1 - 2 / (_SPAN + 1)
_K = math.ceil(math.log(1e-17) / math.log(_D))


def _decayed(term: str, power: int = 1) -> str:
    """Sum over the frame lists of term * weight**power; terms use a (x) and b (y) of one row."""
    return (
        f"list_sum(list_transform(lx, lambda a, i: CASE WHEN a IS NULL OR ly[i] IS NULL THEN 0.0 "
        f"ELSE {term} * pow({_D!r}, {power} * (len(lx) - i)) END))"
    )


def _ewm(name: str, spec: Ewm, sql: str, y: str = "x") -> None:
    frame = f"OVER ({_W} ROWS BETWEEN {_K - 1} PRECEDING AND CURRENT ROW)"

    @query(
        name,
        f"""WITH e AS (SELECT event_id, event_type, ts, {MASKED} AS x, CAST(user_id AS DOUBLE) AS y FROM events),
        l AS (SELECT event_id, list(x) {frame} AS lx, list({y}) {frame} AS ly FROM e),
        s AS (SELECT event_id, {_decayed('1.0')} AS w, {_decayed('1.0', 2)} AS w2, {_decayed('a')} AS sx,
              {_decayed('ly[i]')} AS sy, {_decayed('a * a')} AS sxx, {_decayed('ly[i] * ly[i]')} AS syy,
              {_decayed('a * ly[i]')} AS sxy FROM l)
        SELECT event_id, CASE WHEN w > 0 THEN {R(sql)} END AS feature FROM s""",
    )
    def run(spark, sf_dir):
        e = masked(events(spark, sf_dir)).select("event_id", "event_type", "ts", "x", "y")
        out = ewm_features(e, ["event_type"], ["ts", "event_id"], {"feature": spec})
        return out.select("event_id", r("feature").alias("feature"))


def _moment(a: str, b: str) -> str:
    return f"(s{a}{b} / w - (s{a} / w) * (s{b} / w))"


# one known value has w * w = w2: no spread yet
_BIAS = "(w * w / CASE WHEN w * w - w2 < 1e-9 THEN NULL ELSE w * w - w2 END)"
_ewm("w10_ewm_mean", Ewm("mean", "x", _SPAN), "sx / nullif(w, 0)")
_ewm("w11_ewm_std", Ewm("std", "x", _SPAN), f"sqrt(greatest({_moment('x', 'x')}, 0) * {_BIAS})")
_ewm("w12_ewm_cov", Ewm("cov", "x", _SPAN, "y"), f"{_moment('x', 'y')} * {_BIAS}", "y")
_ewm(
    "w13_ewm_corr",
    Ewm("corr", "x", _SPAN, "y"),
    f"CASE WHEN w * w - w2 < 1e-9 THEN NULL ELSE {_moment('x', 'y')} / nullif(sqrt({_moment('x', 'x')} * {_moment('y', 'y')}), 0) END",
    "y",
)


@query("w14_row_lead", f"SELECT event_id, lead(value, 16) OVER ({_W}) AS label FROM events")
def w14_row_lead(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "event_type", "ts", "value")
    return row_lead(e, ["event_type"], ["ts", "event_id"], "value", 16).select("event_id", "label")


@query(
    "x1_operator_registry",
    f"""SELECT event_id, {R('sin(value)')} AS sine__value, {R('value + user_id')} AS add__value__user_id,
    {R(_when_full(_over('avg(value)', 3), 'value', 3))} AS ts_mean__value__3 FROM events""",
)
def x1_operator_registry(spark, sf_dir):
    e = events(spark, sf_dir)
    named = [Feature("sine", ("value",)), Feature("add", ("value", "user_id")), Feature("ts_mean", ("value",), 3)]
    out = FeatureSet(named, ["event_type"], ["ts", "event_id"]).fit(e).transform(e)
    return rounded(out, ["event_id"], [f.name for f in named])


@query(
    "x4_grouped_map",
    f"""WITH d AS (SELECT event_type, date_trunc('day', ts) AS day, sum(value) AS total FROM events GROUP BY ALL)
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day,
    {R("total - median(total) OVER (PARTITION BY event_type)", 4)} AS feature FROM d""",
)
def x4_grouped_map(spark, sf_dir):
    """A custom per-group transform; groups are daily totals, so their size is bounded by the time span."""
    from vanecast.operators.custom import per_group

    days = events(spark, sf_dir).groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.sum("value").alias("total"))

    def off_median(pdf):
        return pdf.assign(feature=pdf["total"] - pdf["total"].median())[["event_type", "day", "feature"]]

    out = per_group(days, ["event_type"], off_median, "event_type string, day string, feature double")
    return rounded(out, ["event_type", "day"], ["feature"], 4)
