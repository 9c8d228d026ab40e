"""One training run: baseline, feature search, model search, metrics, artefacts, run log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanecast.functions.registry import Feature, FeatureSet
from vanecast.operators.drift import accuracy
from vanecast.operators.metrics import CLASS_REPORT, as_rows, capacity_error, classification_report, evaluate, mae, mse, r2, rmse
from vanecast.plans.features import search_features, transform_parts
from vanecast.plans.model import CLASSIFIERS, REGRESSORS, fit, predict, predict_probability, search_models, selector, validation_score
from vanecast.session import materialize
from vanecast.sources.sinks import append, log_run, save_run

METRICS = {"mse": mse, "rmse": rmse, "mae": mae, "r2": r2, "capacity_error": capacity_error}


def error_share(y: Column, p: Column) -> Column:
    """Share of wrong classes, the loss of a classifier's search."""
    return 1 - accuracy(y, p)


@dataclass
class TrainedRun:
    model: PipelineModel
    features: FeatureSet
    chosen: list[Feature]
    baseline: float
    metrics: DataFrame
    validation: DataFrame


def train_run(
    train: DataFrame,
    validation: DataFrame,
    target: str,
    key: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    out: str,
    model_id: int = 1,
    rounds: int = 1,
    candidates: int | None = None,
    learners: Sequence[str] | None = None,
    classification: bool = False,
    group: Sequence[str] = (),
    order: Sequence[str] = (),
    classes: DataFrame | None = None,
    **params,
) -> TrainedRun:
    """Train on ``train``, choose on ``validation``, write everything below ``out``.

    A classifier's target holds codes from 0; ``classes`` (class, ``code``) decodes
    them when the stored run scores rows. ``group`` and ``order`` add window features.
    """
    spark = train.sparkSession
    learners = learners or (CLASSIFIERS if classification else REGRESSORS)
    first, loss = ("gbt_class", error_share) if classification else ("gbt", mse)
    train, validation = materialize(train, "train"), materialize(validation, "validation")
    base = fit(train, first, numeric, target, **params)
    baseline = validation_score(base, validation, target, classification)
    choose = selector(target, first, classification, **params)
    found = search_features(
        train, validation, target, numeric, categorical, choose, baseline, rounds, group, order, limit=candidates
    )
    fitted = FeatureSet(found.features, group, order).fit(train)
    columns = [*numeric, *[f.name for f in found.features]]
    wide_train, wide_validation = transform_parts(fitted, train, validation)
    trials = [(name, params if name.startswith("gbt") else {}) for name in learners]
    model, log = search_models(wide_train, wide_validation, columns, target, trials, loss)
    best = min((r for r in log if r[3] is not None), key=lambda r: (r[3], r[0]))
    # measured on rows the model has not seen; the stored one is fitted on all
    name, settings = trials[best[0]]
    measured = fit(wide_train, name, columns, target, **settings)
    scored = predict(measured, wide_validation)
    if classification:
        codes = int(wide_train.agg(F.max(target)).first()[0]) + 1
        chances = {float(i): f"p{i}" for i in range(codes)}
        likely = predict_probability(measured, scored, codes).select(F.col(target).cast("double").alias("y"), "y_pred", *chances.values())
        report = classification_report(materialize(likely, "likely"), "y", "y_pred", chances)
        metrics = as_rows(report, CLASS_REPORT, f"run-{model_id}")
    else:
        metrics = as_rows(evaluate(scored, target, "y_pred", METRICS), list(METRICS), f"run-{model_id}")
    save_run(spark, f"{out}/model-{model_id}", model, fitted, classes)
    append(metrics, f"{out}/metrics")
    append(scored.select(key, F.col(target).alias("y_true"), "y_pred"), f"{out}/validation")
    log_run(spark, f"{out}/runs", model_id, "train", "", model_id, "success")
    return TrainedRun(model, fitted, found.features, baseline, metrics, scored)
