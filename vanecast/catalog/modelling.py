"""Feature search and model queries on order totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from vanecast.catalog.base import R, query, r, rounded, table
from vanecast.functions.registry import Feature, FeatureSet
from vanecast.operators import metrics, sampling
from vanecast.operators.metrics import mse
from vanecast.plans import features, model
from vanecast.plans.boosting import fit_boosted
from vanecast.plans.train import train_run
from vanecast.session import materialize, scratch_path
from vanecast.sources.sinks import save_run

# candidates of one search round, as many as the baseline's
ROUND_CANDIDATES = 128
NUMERIC, CATEGORICAL = ["quantity", "lines", "discount", "tax"], ["flag", "status"]
ORDER_SQL = """SELECT l_orderkey, max(l_returnflag) AS flag, min(l_linestatus) AS status, count(*) AS lines, sum(l_quantity) AS quantity,
    avg(l_discount) AS discount, avg(l_tax) AS tax, sum(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey"""


def order_rows(spark, sf_dir):
    """One row per order: totals of its lines; the price is the target."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_returnflag").alias("flag"), F.min("l_linestatus").alias("status"), F.count("*").alias("lines"),
        F.sum("l_quantity").alias("quantity"), F.avg("l_discount").alias("discount"), F.avg("l_tax").alias("tax"),
        F.sum("l_extendedprice").alias("price"),
    )


def kept_orders(spark, sf_dir):
    """The order rows written once, for learners that read them many times."""
    return materialize(order_rows(spark, sf_dir), "orders")


def split(rows):
    marked = sampling.random_split(rows, ["l_orderkey"])
    return marked.where("NOT is_test").drop("is_test"), marked.where("is_test").drop("is_test")


def expensive(rows):
    """Class for the classifiers: 1 for orders above 100000."""
    return rows.withColumn("dear", (F.col("price") > 100_000).cast("int"))


@query("m13_enumerate_features")
def m13_enumerate_features(spark, sf_dir):
    """Candidates from the columns' kinds, found in the data."""
    rows = order_rows(spark, sf_dir)
    kinds = metrics.column_kinds(rows, [*NUMERIC, *CATEGORICAL]).collect()
    by = {k: [r["name"] for r in kinds if r["kind"] == k] for k in ("numeric", "categorical")}
    found = features.enumerate_features(sorted(by["numeric"]), sorted(by["categorical"]), ordered=True)
    return spark.createDataFrame([(f.name, f.op, f.depth) for f in found], "feature string, op string, depth int")


_CANDIDATES = [
    Feature("log", ("quantity",)),
    Feature("mul", ("quantity", "lines")),
    Feature("div", ("quantity", "lines")),
    Feature("aggmean", ("flag", "quantity")),
    Feature("crosscount", ("flag", "status")),
]
_VALUES = """SELECT l_orderkey, price, ln(quantity) AS log__quantity, quantity * lines AS mul__quantity__lines, quantity / lines AS div__quantity__lines,
    avg(quantity) OVER (PARTITION BY flag) AS aggmean__flag__quantity, count(*) OVER (PARTITION BY flag, status) AS crosscount__flag__status FROM o"""


def _gini_sql() -> str:
    long = " UNION ALL ".join(
        f"SELECT '{f.name}' AS feature, l_orderkey, price AS a, CAST(round({f.name}, 9) AS DOUBLE) AS p FROM v" for f in _CANDIDATES
    )
    area = "(sum(a * (n - {r} + 1)) / sum(a) - (max(n) + 1) / 2) / max(n)"
    return f"""WITH o AS ({ORDER_SQL}), v AS ({_VALUES}), k AS (SELECT feature, a, count(*) OVER (PARTITION BY feature) AS n,
        rank() OVER (PARTITION BY feature ORDER BY p) + (count(*) OVER (PARTITION BY feature, p) - 1) / 2 AS r,
        rank() OVER (PARTITION BY feature ORDER BY a) + (count(*) OVER (PARTITION BY feature, a) - 1) / 2 AS b FROM ({long}))
    SELECT feature, {R(f"abs({area.format(r='r')} / ({area.format(r='b')}))", 5)} AS gini FROM k GROUP BY feature"""


@query("m14_candidate_scores", _gini_sql())
def m14_candidate_scores(spark, sf_dir):
    """All candidates in one job. Values are rounded first, so that sums taken in another order rank alike."""
    rows = order_rows(spark, sf_dir)
    values = FeatureSet(_CANDIDATES).fit(rows).transform(rows)
    names = [f.name for f in _CANDIDATES]
    values = materialize(values.select("l_orderkey", "price", *[F.round(n, 9).alias(n) for n in names]), "candidates")
    return metrics.gini_table(values, "price", names).select("feature", r("gini", 5).alias("gini"))


@query("m14_search_round")
def m14_search_round(spark, sf_dir):
    """A whole round of the search up to the model: 128 candidates enumerated, computed and scored."""
    rows = materialize(order_rows(spark, sf_dir), "orders")
    found = features.enumerate_features(NUMERIC, CATEGORICAL, ordered=True, limit=ROUND_CANDIDATES)
    scores = features.score_features(rows, found, "price", ["flag"], ["l_orderkey"])
    return metrics.top_features(scores, NUMERIC).select("feature", r("gini").alias("gini"))


@query("m15_materialize_features", f"WITH o AS ({ORDER_SQL}) SELECT l_orderkey, crosscount__flag__status, " + ", ".join(f"{R(f.name)} AS {f.name}" for f in _CANDIDATES[:4]) + f" FROM ({_VALUES})")
def m15_materialize_features(spark, sf_dir):
    rows = order_rows(spark, sf_dir)
    out = FeatureSet(_CANDIDATES).fit(rows).transform(rows)
    return rounded(out, ["l_orderkey", "crosscount__flag__status"], [f.name for f in _CANDIDATES[:4]])


@query("m16_select_by_importance")
def m16_select_by_importance(spark, sf_dir):
    train, validation = split(kept_orders(spark, sf_dir))
    fitted = FeatureSet(_CANDIDATES).fit(train)
    choose = model.selector("price")
    score, used = choose(fitted.transform(train), fitted.transform(validation), NUMERIC, [f.name for f in _CANDIDATES])
    places = {n: i + 1 for i, n in enumerate(used)}
    return spark.createDataFrame([(f.name, places.get(f.name), round(score, 4)) for f in _CANDIDATES], "feature string, place int, score double")


@query("m17_feature_search")
def m17_feature_search(spark, sf_dir):
    train, validation = split(kept_orders(spark, sf_dir))
    base = model.validation_score(model.fit(train, "gbt", ["discount"], "price"), validation, "price")
    found = features.search_features(train, validation, "price", NUMERIC, CATEGORICAL, model.selector("price"), base)
    log = spark.createDataFrame(found.log, "round int, candidates int, left_out int, scored int, kept int, score double")
    return log.withColumn("score", r("score", 4))


def _scores(spark, sf_dir, learners, target, classification):
    train, validation = split(expensive(kept_orders(spark, sf_dir)))
    out = []
    for name, params in learners:
        fitted = model.fit(train, name, NUMERIC, target, **params)
        out.append((name, round(model.validation_score(fitted, validation, target, classification), 4)))
    return spark.createDataFrame(out, "learner string, score double")


@query("m18_boosted_trees")
def m18_boosted_trees(spark, sf_dir):
    one = _scores(spark, sf_dir, [("gbt", {"stepSize": 0.3})], "price", False)
    return one.unionByName(_scores(spark, sf_dir, [("gbt_class", {}), ("forest_class", {})], "dear", True))


@query("m18_boosted_classes")
def m18_boosted_classes(spark, sf_dir):
    """Cheap, middling and dear orders: training and held-out loss of every round that a class keeps."""
    train, validation = split(kept_orders(spark, sf_dir))
    graded = F.when(F.col("price") < 60_000, 0).when(F.col("price") < 180_000, 1).otherwise(2)
    found = fit_boosted(train.withColumn("grade", graded), NUMERIC, "grade", validation.withColumn("grade", graded), rounds=10, stepSize=0.3)
    out = spark.createDataFrame(found.log, "grade int, round int, training double, held_out double")
    return out.select("grade", "round", r("training", 4).alias("training"), r("held_out", 4).alias("held_out"))


@query("m19_linear_models")
def m19_linear_models(spark, sf_dir):
    return _scores(spark, sf_dir, [("linear", {})], "price", False).unionByName(_scores(spark, sf_dir, [("logistic", {})], "dear", True))


@query("m20_model_search")
def m20_model_search(spark, sf_dir):
    train, validation = split(kept_orders(spark, sf_dir))
    trials = model.draw_trials(["linear", "tree", "forest", "gbt"], 8)
    _, log = model.search_models(train, validation, NUMERIC, "price", trials, mse)
    return spark.createDataFrame(log, "trial int, learner string, settings string, loss double").withColumn("loss", r("loss", 2))


@query("m20_halving_search")
def m20_halving_search(spark, sf_dir):
    """Nine trials on growing samples; the log names the trials that were given more rows."""
    train, validation = split(kept_orders(spark, sf_dir))
    trials = model.draw_trials(["linear", "tree", "forest"], 9)
    _, log = model.halving_search(train, validation, NUMERIC, "price", trials, mse)
    out = spark.createDataFrame(log, "rung int, trial int, learner string, settings string, rows long, loss double")
    return out.withColumn("loss", r("loss", 2))


@query("m21_train_run")
def m21_train_run(spark, sf_dir):
    train, validation = split(kept_orders(spark, sf_dir))
    done = train_run(train, validation, "price", "l_orderkey", NUMERIC, CATEGORICAL, scratch_path(spark, "run"))
    return done.metrics


# least squares with one input has a closed form in SQL
LINE_SQL = f"""WITH o AS ({ORDER_SQL}), f AS (SELECT regr_slope(price, quantity) AS b, regr_intercept(price, quantity) AS a FROM o)"""
LINE = R("a + b * quantity", 2)


def line(rows):
    return model.fit(rows, "linear", ["quantity"], "price")


@query("m22_batch_score", f"{LINE_SQL} SELECT l_orderkey, {LINE} AS y_pred FROM o, f")
def m22_batch_score(spark, sf_dir):
    rows = order_rows(spark, sf_dir)
    return model.predict(line(rows), rows).select("l_orderkey", r("y_pred", 2).alias("y_pred"))


@query(
    "m22_stored_run",
    f"""WITH o AS ({ORDER_SQL}), v AS (SELECT *, avg(quantity) OVER (PARTITION BY flag) AS x FROM o),
    f AS (SELECT regr_slope(price, x) AS b, regr_intercept(price, x) AS a FROM v) SELECT l_orderkey, {R('a + b * x', 2)} AS y_pred FROM v, f""",
)
def m22_stored_run(spark, sf_dir):
    """A model on a derived feature, stored with its fitted lookup, loaded again and given raw rows."""
    rows = kept_orders(spark, sf_dir)
    fitted = FeatureSet([Feature("aggmean", ("flag", "quantity"))]).fit(rows)
    path = scratch_path(spark, "stored-run")
    save_run(spark, path, model.fit(fitted.transform(rows), "linear", ["aggmean__flag__quantity"], "price"), fitted)
    return model.predict_run(spark, path, rows).select("l_orderkey", r("y_pred", 2).alias("y_pred"))


@query("m23_class_probability")
def m23_class_probability(spark, sf_dir):
    rows = expensive(order_rows(spark, sf_dir))
    fitted = model.fit(split(rows)[0], "logistic", NUMERIC, "dear")
    return model.predict_probability(fitted, rows, 2).select("l_orderkey", "p0", "p1")


def _importances(spark, sf_dir):
    train, _ = split(kept_orders(spark, sf_dir))
    return model.importance_table(spark, model.fit(train, "gbt", NUMERIC, "price"))


@query("a24_importance_table")
def a24_importance_table(spark, sf_dir):
    return _importances(spark, sf_dir).select("feature", r("importance", 2).alias("importance"))


@query("o3_important_features")
def o3_important_features(spark, sf_dir):
    """Features with positive importance, most important first, at most twenty."""
    return _importances(spark, sf_dir).where("importance > 0").orderBy(F.col("importance").desc(), "feature").limit(20).select("feature")


@query("x2_custom_metric", f"SELECT l_returnflag, {R('max(abs(l_extendedprice - l_quantity * 1500))', 4)} AS worst, {R('avg(l_extendedprice - l_quantity * 1500)', 4)} AS bias FROM lineitem GROUP BY l_returnflag")
def x2_custom_metric(spark, sf_dir):
    """Any aggregate of (actual, predicted) is a metric."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", (F.col("l_quantity") * 1500).alias("p"))
    own = {"worst": lambda y, p: F.max(F.abs(y - p)), "bias": lambda y, p: F.avg(y - p)}
    return rounded(metrics.evaluate(li, "l_extendedprice", "p", own, ["l_returnflag"]), ["l_returnflag"], ["worst", "bias"], 4)


@query("x3_custom_learner")
def x3_custom_learner(spark, sf_dir):
    """A learner registered by name takes part in the search."""
    from pyspark.ml.regression import GeneralizedLinearRegression

    model.LEARNERS.setdefault("gamma", lambda **p: GeneralizedLinearRegression(**{"family": "gamma", "link": "log", **p}))
    train, validation = split(kept_orders(spark, sf_dir))
    _, log = model.search_models(train, validation, NUMERIC, "price", [("gamma", {}), ("linear", {})], mse)
    return spark.createDataFrame(log, "trial int, learner string, settings string, loss double").withColumn("loss", r("loss", 2))
