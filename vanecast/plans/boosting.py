"""Boosted trees for many classes with early stopping, on Spark ML's boosting of two classes.

One model per class learns that class against the rest, all on one written table of
assembled inputs. A share of the rows, or the rows the caller names, is held out of the
trees: their loss after every round decides how many rounds each class keeps. The models
become one stage that predicts the class of the largest margin, so a fitted pipeline is
stored and scored like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, OneVsRestModel
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.session import materialize

# Fixed values of the boosted baseline: about 31 leaves per tree, learning rate 0.05.
DEPTH, RATE = 5, 0.05
MAX_CLASSES = 256  # a model per class
HELD_OUT = 0.2


@dataclass
class Boosted:
    """A fitted pipeline and the losses (class, round, training, held out) of the rounds that were kept."""

    model: PipelineModel
    log: list[tuple[int, int, float, float | None]]

    @property
    def rounds(self) -> list[int]:
        """Rounds that each class keeps."""
        return [m.getNumTrees for m in self.model.stages[-1].models]


def fit_boosted(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    validation: DataFrame | None = None,
    rounds: int = 20,
    tolerance: float = 0.01,
    parallelism: int = 2,
    **params,
) -> Boosted:
    """Fit classes coded 0, 1, ... in ``target``; a class stops when the held-out loss falls by less than ``tolerance``.

    Without ``validation`` a fifth of the rows is held out by a hash of their values, so a
    repeated run holds out the same ones. Rows without a target are not used; missing inputs
    become the mean of the training rows.
    """
    held = F.pmod(F.xxhash64(F.lit(42), *features, target), F.lit(1000)) < int(1000 * HELD_OUT)
    typed = [F.col(c).cast("double").alias(c) for c in (*features, target)]
    rows = train.select(*typed, (F.lit(False) if validation is not None else held).alias("__held"))
    if validation is not None:
        rows = rows.unionByName(validation.select(*typed, F.lit(True).alias("__held")))
    rows = materialize(rows.where(F.col(target).isNotNull()), "boosting")
    learnt = rows.where("NOT __held")
    seen = learnt.agg(F.max(target).alias("top"), F.count_distinct(target).alias("n"), *[F.count(f).alias(f"f_{i}") for i, f in enumerate(features)]).first()
    if seen["top"] is None or seen["top"] >= MAX_CLASSES:
        raise ValueError(f"classes are codes from 0 to {MAX_CLASSES - 1}, found up to {seen['top']}")
    usable = [f for i, f in enumerate(features) if seen[f"f_{i}"]]  # an input without any known value has no mean
    filled = [f"__f_{f}" for f in usable]
    imputer = Imputer(inputCols=usable, outputCols=filled, strategy="mean").fit(learnt)
    assembler = VectorAssembler(inputCols=filled, outputCol="__features", handleInvalid="skip")
    ready = materialize(assembler.transform(imputer.transform(rows)).select("__features", target, "__held"), "assembled")
    early = {} if ready.where("__held").isEmpty() else {"validationIndicatorCol": "__held", "validationTol": tolerance}
    settings = {"maxDepth": DEPTH, "stepSize": RATE, "seed": 42, "maxIter": rounds, **early, **params}

    def one(code: int) -> tuple[GBTClassificationModel, list[tuple[int, int, float, float | None]]]:
        own = ready.withColumn("__own", (F.col(target) == code).cast("double"))
        learner = GBTClassifier(featuresCol="__features", labelCol="__own", **settings)
        model = learner.fit(own)
        kept = model.getNumTrees
        losses = [model.evaluateEachIteration(own.where(part)) if early or part != "__held" else [None] * kept for part in ("NOT __held", "__held")]
        return model, [(code, i + 1, a, b) for i, (a, b) in enumerate(zip(*losses, strict=True))]

    with ThreadPoolExecutor(parallelism) as pool:
        fitted = list(pool.map(one, range(int(seen["top"]) + 1)))
    best = OneVsRestModel([m for m, _ in fitted])
    best = best.setFeaturesCol("__features").setPredictionCol("prediction").setRawPredictionCol("rawPrediction")
    best.set(best.classifier, GBTClassifier())  # part of what is stored
    return Boosted(PipelineModel([imputer, assembler, best]), [row for _, log in fitted for row in log])


def class_probabilities(margins: str = "rawPrediction"):
    """Probabilities of the classes from their margins: each one's logistic share, brought to a sum of 1."""
    own = F.transform(vector_to_array(margins), lambda m: 1 / (1 + F.exp(-2 * m)))
    return F.transform(own, lambda p: p / F.aggregate(own, F.lit(0.0), lambda a, b: a + b))
