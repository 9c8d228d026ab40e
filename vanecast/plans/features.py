"""Feature search: enumerate candidates, score them in one job, keep what helps a model."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.functions.registry import EWM_OPS, ONE_NUMBER, TWO_NUMBERS, Feature, FeatureSet
from vanecast.operators.metrics import gini_table
from vanecast.operators.window import ROLLING_OPS
from vanecast.session import materialize

# Depth of nested features, candidates a round hands to the model, row counts of windows.
MAX_DEPTH, TOP_PER_ROUND = 3, 10
SPANS = (1, 2, 3, 4, 5)
# Operators of two series.
PAIR_WINDOWS = ("ts_cov", "ts_corr", "ewm_cov", "ewm_corr")


def enumerate_features(
    numeric: Sequence[str | Feature],
    categorical: Sequence[str],
    ordered: bool = False,
    spans: Sequence[int] = SPANS,
    limit: int | None = None,
    max_depth: int = MAX_DEPTH,
) -> list[Feature]:
    """All candidates by operand kinds, in a fixed order, the kinds taking turns; the first ``limit`` if one is given."""
    pairs = [(a, b) for i, a in enumerate(numeric) for b in numeric[i + 1 :]]
    grouped = [(c, n) for c in categorical for n in numeric]
    crossed = [(a, b) for i, a in enumerate(categorical) for b in categorical[i + 1 :]]
    windows = [*ROLLING_OPS, *EWM_OPS] if ordered else []
    kinds = [
        [Feature(op, (x,)) for x in numeric for op in ONE_NUMBER],
        [Feature(op, p) for p in pairs for op in TWO_NUMBERS],
        [Feature("count", (c,)) for c in categorical],
        [Feature(op, p) for p in crossed for op in ("crosscount", "nunique", "combine")],
        [Feature(op, p) for p in grouped for op in ("aggmean", "aggmin", "aggmax", "aggstd")],
        [Feature(op, (x,), n) for x in numeric for n in spans for op in windows if op not in PAIR_WINDOWS],
        [Feature(op, p, n) for p in pairs for n in spans for op in windows if op in PAIR_WINDOWS],
    ]
    out: dict[str, Feature] = {}
    longest = max((len(k) for k in kinds), default=0)
    for i in range(longest):
        for kind in kinds:
            if i < len(kind) and kind[i].depth < max_depth:
                out.setdefault(kind[i].name, kind[i])
    return list(out.values())[:limit]


def score_features(train: DataFrame, features: Sequence[Feature], target: str, group: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """Gini of every candidate: one transform and one scoring job."""
    values = FeatureSet(features, group, order).fit(train).transform(train)
    names = [f.name for f in features]
    return gini_table(materialize(values.select(target, *names), "candidates"), target, names)  # counted, then ranked


def transform_parts(fitted: FeatureSet, train: DataFrame, validation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features of both parts; with ordered features, over the rows of both together."""
    if not fitted.order:
        return materialize(fitted.transform(train), "train"), materialize(fitted.transform(validation), "validation")
    both = train.withColumn("__part", F.lit(0)).unionByName(validation.withColumn("__part", F.lit(1)))
    wide = materialize(fitted.transform(both), "parts")
    return wide.where("__part = 0").drop("__part"), wide.where("__part = 1").drop("__part")


@dataclass
class SearchResult:
    """Chosen features, the best score and one log row (round, candidates, left out, scored, kept, score) per round."""

    features: list[Feature] = field(default_factory=list)
    score: float | None = None
    log: list[tuple[int, int, int, int, int, float | None]] = field(default_factory=list)


def search_features(
    train: DataFrame,
    validation: DataFrame,
    target: str,
    numeric: Sequence[str],
    categorical: Sequence[str],
    select: Callable[[DataFrame, DataFrame, list[str], list[str]], tuple[float, list[str]]],
    baseline: float,
    rounds: int = 2,
    group: Sequence[str] = (),
    order: Sequence[str] = (),
    limit: int | None = None,
    top: int = TOP_PER_ROUND,
    keep: int | None = None,
) -> SearchResult:
    """Repeat: enumerate, score by gini, let the model choose; keep a round only if it beats the best score.

    ``select(train, validation, originals, candidates)`` fits a model and returns
    its validation score (higher is better) and the candidates it used, best first.
    ``limit`` bounds the candidates of a round, ``keep`` those that stay; the log
    counts what a limit left out. Window features are computed on the rows of both
    parts in order, since a split by rows would cut their frames.
    """
    train, validation = materialize(train, "search-train"), materialize(validation, "search-validation")
    result = SearchResult(score=baseline)
    operands: list[str | Feature] = list(numeric)
    tried: set[str] = set()
    for number in range(1, rounds + 1):
        possible = [f for f in enumerate_features(operands, categorical, bool(order)) if f.name not in tried]
        fresh = possible[:limit]
        if not fresh:
            break
        tried |= {f.name for f in fresh}
        scores = score_features(train, fresh, target, group, order)
        best = scores.orderBy(F.col("gini").desc_nulls_last(), "feature").limit(top).collect()
        by_name = {f.name: f for f in fresh}
        candidates = [by_name[r["feature"]] for r in best]
        fitted = FeatureSet([*result.features, *candidates], group, order).fit(train)
        wide_train, wide_validation = transform_parts(fitted, train, validation)
        known = [*numeric, *[f.name for f in result.features]]
        score, used = select(wide_train, wide_validation, known, [f.name for f in candidates])
        kept = [by_name[n] for n in used][:keep] if score > result.score else []
        if kept:
            result.features += kept
            result.score = score
            operands = [*numeric, *kept]
        result.log.append((number, len(fresh), len(possible) - len(fresh), len(candidates), len(kept), result.score))
    return result
