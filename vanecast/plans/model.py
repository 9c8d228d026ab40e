"""Learners, model search, training runs and batch scoring on Spark ML."""

from __future__ import annotations

import itertools
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRestModel, RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanecast.operators.clean import round_probability
from vanecast.operators.drift import accuracy
from vanecast.operators.groupstat import decode_labels
from vanecast.operators.metrics import r2
from vanecast.plans.boosting import DEPTH, RATE, class_probabilities, fit_boosted
from vanecast.session import materialize
from vanecast.sources.readers import folder_exists, load_run

LEARNERS: dict[str, Callable[..., Estimator]] = {
    "gbt": lambda **p: GBTRegressor(**{"maxDepth": DEPTH, "stepSize": RATE, "seed": 42, "maxIter": 20, **p}),
    "linear": lambda **p: LinearRegression(**p),
    "gbt_class": lambda **p: GBTClassifier(**{"maxDepth": DEPTH, "stepSize": RATE, "seed": 42, "maxIter": 20, **p}),
    "forest_class": lambda **p: RandomForestClassifier(**{"maxDepth": DEPTH, "seed": 42, "numTrees": 20, **p}),
    "logistic": lambda **p: LogisticRegression(**p),
    "forest": lambda **p: RandomForestRegressor(**{"maxDepth": DEPTH, "seed": 42, "numTrees": 20, **p}),
    "tree": lambda **p: DecisionTreeRegressor(**{"maxDepth": DEPTH, "seed": 42, **p}),
}
REGRESSORS, CLASSIFIERS = ("gbt", "linear"), ("gbt_class", "forest_class", "logistic")

# Ranges of the settings a search draws from, per learner; the first value is the default.
SPACES: dict[str, dict[str, tuple]] = {
    "gbt": {"maxIter": (20, 40, 80), "maxDepth": (5, 3, 7), "stepSize": (RATE, 0.1, 0.3)},
    "linear": {"regParam": (0.0, 0.01, 0.1), "elasticNetParam": (0.0, 0.5, 1.0)},
    "forest": {"numTrees": (20, 50), "maxDepth": (5, 8)},
    "tree": {"maxDepth": (5, 3, 8)},
    "gbt_class": {"maxIter": (20, 40, 80), "maxDepth": (5, 3, 7), "stepSize": (RATE, 0.1, 0.3)},
    "forest_class": {"numTrees": (20, 50), "maxDepth": (5, 8)},
    "logistic": {"regParam": (0.0, 0.01, 0.1)},
    "boosted": {"rounds": (20, 40, 80), "maxDepth": (5, 3, 7), "stepSize": (RATE, 0.1, 0.3)},
}


def draw_trials(learners: Sequence[str], count: int, seed: int = 42) -> list[tuple[str, dict]]:
    """``count`` distinct trials: every learner's default first, then settings drawn in turn."""
    rng = random.Random(seed)
    grids = {}
    for learner in learners:
        space = SPACES[learner]
        grid = [dict(zip(space, values)) for values in itertools.product(*space.values())]
        rest = grid[1:]
        rng.shuffle(rest)
        grids[learner] = [grid[0], *rest]
    turns = itertools.zip_longest(*[[(name, params) for params in grids[name]] for name in learners])
    return [t for turn in turns for t in turn if t is not None][:count]


def build_pipeline(learner: str, features: Sequence[str], target: str, **params) -> Pipeline:
    """Missing inputs become the training mean; then the named learner."""
    filled = [f"__f_{f}" for f in features]
    return Pipeline(
        stages=[
            Imputer(inputCols=list(features), outputCols=filled, strategy="mean"),
            VectorAssembler(inputCols=filled, outputCol="__features", handleInvalid="skip"),
            LEARNERS[learner](featuresCol="__features", labelCol=target, **params),
        ]
    )


def as_doubles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def prepare(train: DataFrame, features: Sequence[str], target: str) -> tuple[DataFrame, list[str]]:
    """Typed rows, written as a learner reads them once per pass, and the inputs it can use."""
    rows = materialize(as_doubles(train, [*features, target]).select(*features, target), "fit")
    # an input without any known value has no mean to fill in
    known = rows.agg(*[F.count(f).alias(f) for f in features]).first()
    return rows, [f for f in features if known[f]]


def fit(train: DataFrame, learner: str, features: Sequence[str], target: str, **params) -> PipelineModel:
    if learner == "boosted":  # any number of classes, stops early
        return fit_boosted(train, features, target, **params).model
    rows, usable = prepare(train, features, target)
    return build_pipeline(learner, usable, target, **params).fit(rows)


def predict(model: PipelineModel, df: DataFrame, name: str = "y_pred") -> DataFrame:
    """Input columns plus the prediction."""
    inputs = model.stages[0].getInputCols()
    typed = as_doubles(df, inputs)
    return model.transform(typed).select(*df.columns, F.col("prediction").alias(name))


def predict_run(spark: SparkSession, path: str, rows: DataFrame, name: str = "y_pred") -> DataFrame:
    """Score raw rows with a stored run: rebuild its features, predict, and decode a classifier's codes."""
    model, features = load_run(spark, path)
    scored = predict(model, features.transform(rows), name)
    if folder_exists(spark, f"{path}/classes"):
        coded = scored.withColumn("__code", F.col(name).cast("long")).drop(name)
        scored = decode_labels(coded, spark.read.parquet(f"{path}/classes"), "__code", name).drop("__code")
    return scored.select(*rows.columns, name)


def predict_probability(model: PipelineModel, df: DataFrame, classes: int) -> DataFrame:
    """Input columns plus one probability per class, rounded to five digits."""
    p = class_probabilities() if isinstance(model.stages[-1], OneVsRestModel) else vector_to_array("probability")
    scored = model.transform(as_doubles(df, model.stages[0].getInputCols()))
    return scored.select(*df.columns, *[round_probability(p[i]).alias(f"p{i}") for i in range(classes)])


def validation_score(model: PipelineModel, validation: DataFrame, target: str, classification: bool = False) -> float:
    metric = accuracy if classification else r2
    y, p = F.col(target).cast("double"), F.col("y_pred")
    return predict(model, validation).agg(metric(y, p)).first()[0]


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    """Inputs of a tree model with positive importance, largest first."""
    names = model.stages[0].getInputCols()
    last = model.stages[-1]
    models = last.models if isinstance(last, OneVsRestModel) else [last]
    values = sum(m.featureImportances.toArray() for m in models) / len(models)
    return sorted([(n, float(v)) for n, v in zip(names, values) if v > 0], key=lambda r: (-r[1], r[0]))


def importance_table(spark, model: PipelineModel, top: int = 100) -> DataFrame:
    """Importance in percent of the largest, for the ``top`` inputs."""
    ranked = importances(model)[:top]
    largest = ranked[0][1] if ranked else 1.0
    return spark.createDataFrame([(n, 100 * v / largest) for n, v in ranked], "feature string, importance double")


def selector(target: str, learner: str = "gbt", classification: bool = False, **params):
    """Model-based choice for the feature search: (score, used candidates by importance)."""

    def select(train: DataFrame, validation: DataFrame, originals: list[str], candidates: list[str]):
        model = fit(train, learner, [*originals, *candidates], target, **params)
        used = [n for n, _ in importances(model) if n in candidates]
        return validation_score(model, validation, target, classification), used

    return select


def search_models(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    target: str,
    trials: Sequence[tuple[str, Mapping]],
    loss: Callable,
    parallelism: int = 2,
) -> tuple[PipelineModel, list[tuple[int, str, str, float]]]:
    """Fit every trial (learner, settings), then refit the one with the least loss on all rows.

    ``loss`` is an aggregate column of (actual, predicted). Fits of different
    trials overlap; each is a distributed job. The rows are typed and written once for all trials.
    """
    train = materialize(train.select(*features, target), "trials-train")
    validation = materialize(validation.select(*features, target), "trials-validation")

    rows, usable = prepare(train, features, target) if any(learner != "boosted" for learner, _ in trials) else (train, [])

    def run(number: int) -> tuple[int, str, str, float]:
        learner, params = trials[number]
        if learner == "boosted":
            model = fit(train, learner, features, target, **params)
        else:
            model = build_pipeline(learner, usable, target, **params).fit(rows)
        value = predict(model, validation).agg(loss(F.col(target).cast("double"), F.col("y_pred"))).first()[0]
        return number, learner, str(dict(params)), value

    with ThreadPoolExecutor(parallelism) as pool:
        log = list(pool.map(run, range(len(trials))))
    best = min((r for r in log if r[3] is not None), key=lambda r: (r[3], r[0]))
    learner, params = trials[best[0]]
    return fit(train.unionByName(validation), learner, features, target, **params), log


def halving_search(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    target: str,
    trials: Sequence[tuple[str, Mapping]],
    loss: Callable,
    factor: int = 3,
    least_rows: int = 1000,
    parallelism: int = 2,
    seed: int = 42,
) -> tuple[PipelineModel, list[tuple[int, int, str, str, int, float]]]:
    """Successive halving: every trial sees a small sample, the best ``1 / factor`` of them one ``factor`` times as large.

    Samples are nested, drawn by a hash of the row, so a repeated search takes the same rows.
    The first sample is as small as the number of rungs allows but not below ``least_rows``;
    in the last rung the trials that are left see all rows. A trial whose loss is undefined
    goes; ties stay in the order of the trials. Returns the best trial refitted on all rows
    and the log (rung, trial, learner, settings, rows, loss).
    """
    if not trials or factor < 2:
        raise ValueError("a search takes trials and a factor of 2 or more")
    share = F.pmod(F.xxhash64(F.lit(seed), *features, target), F.lit(1 << 30)) / F.lit(float(1 << 30))
    train = materialize(train.select(*features, target).withColumn("__share", share), "halving-train")
    validation = materialize(validation.select(*features, target), "halving-validation")
    total = train.count()
    rungs = 1
    while factor**rungs <= len(trials) and total / factor**rungs >= least_rows:
        rungs += 1
    left, log, scored = list(range(len(trials))), [], []
    for rung in range(rungs):
        part = train.drop("__share") if rung == rungs - 1 else train.where(F.col("__share") < factor ** (rung + 1 - rungs)).drop("__share")
        part = materialize(part, "rung")
        seen = part.count()

        def run(number: int, part=part) -> tuple[int, float | None]:
            learner, params = trials[number]
            model = fit(part, learner, features, target, **params)
            return number, predict(model, validation).agg(loss(F.col(target).cast("double"), F.col("y_pred"))).first()[0]

        with ThreadPoolExecutor(parallelism) as pool:
            scored = list(pool.map(run, left))
        log += [(rung, n, trials[n][0], str(dict(trials[n][1])), seen, value) for n, value in scored]
        scored = sorted((value, n) for n, value in scored if value is not None)
        if not scored:
            raise ValueError("no trial has a loss")
        left = sorted(n for _, n in scored[: max(1, -(-len(left) // factor))])
    learner, params = trials[scored[0][1]]
    return fit(train.drop("__share").unionByName(validation), learner, features, target, **params), log
