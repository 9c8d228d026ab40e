"""Drift between history and new rows.

Every test reduces both sides to counts or moments; p-values are computed on
the one result row per column. A p-value below the threshold, or a distance
above it, means drift.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanecast.functions.distributions import chi_square_tail, t_two_sided
from vanecast.operators.centres import settled_counts
from vanecast.operators.joins import scalar_join
from vanecast.operators.metrics import r2

# Fixed values.
BINS, CLUSTERS, CLUSTER_SEED = 50, 3, 42
WORDS = "\\W+"
# Bounds of the text clusters: seeds hold clusters x places doubles; rounds of k-means.
MOST_PLACES, MOST_MOVES = 1 << 20, 200
BLOCK_BYTES = 8 << 20  # text whose vectors are in one block
P_THRESHOLD, SCORE_THRESHOLD = 0.05, 0.85

RESULT = "name string, method string, statistic double, dof double, p double, drift boolean"


def both_sides(history: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """History (side 0) and new rows (side 1) in one table."""
    return history.select(*columns, F.lit(0).alias("side")).unionByName(new.select(*columns, F.lit(1).alias("side")))


def contingency(history: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """Rows (category, n0, n1): the two datasets against the categories."""
    return (
        both_sides(history, new, [column])
        .where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("category"))
        .agg(F.count(F.when(F.col("side") == 0, 1)).alias("n0"), F.count(F.when(F.col("side") == 1, 1)).alias("n1"))
    )


def chi_square(history: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """Homogeneity statistic and degrees of freedom; two categories get the continuity correction."""
    table = contingency(history, new, column)
    sums = table.agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"), F.count(F.lit(1)).alias("k"))
    t = (F.col("t0") + F.col("t1")).cast("double")
    cells = []
    for side in ("0", "1"):
        expected = F.try_divide((F.col("n0") + F.col("n1")).cast("double") * F.col(f"t{side}"), t)
        gap = F.abs(F.col(f"n{side}") - expected)
        gap = F.when(F.col("k") == 2, F.greatest(gap - 0.5, F.lit(0.0))).otherwise(gap)
        cells.append(F.try_divide(gap * gap, expected))
    return (
        scalar_join(table, sums)
        .agg(F.sum(cells[0] + cells[1]).alias("statistic"), (F.max("k") - 1).cast("double").alias("dof"))
        .select(F.lit(column).alias("name"), "statistic", "dof")
    )


def welch(history: DataFrame, new: DataFrame, columns: Sequence[str]) -> DataFrame:
    """t and degrees of freedom without equal variances, all columns in one pass."""
    aggs = []
    for c in columns:
        for side in (0, 1):
            x = F.when(F.col("side") == side, F.col(c).cast("double"))
            aggs += [
                F.avg(x).alias(f"{c}__m{side}"), F.var_samp(x).alias(f"{c}__v{side}"), F.count(x).alias(f"{c}__n{side}"),
            ]
    cells = ", ".join(
        f"'{c}', `{c}__m0`, `{c}__v0`, `{c}__n0`, `{c}__m1`, `{c}__v1`, `{c}__n1`" for c in columns
    )
    rows = both_sides(history, new, columns).agg(*aggs).select(
        F.expr(f"stack({len(columns)}, {cells}) as (name, m0, v0, n0, m1, v1, n1)")
    )
    q0, q1 = F.try_divide(F.col("v0"), F.col("n0")), F.try_divide(F.col("v1"), F.col("n1"))
    dof = F.try_divide(
        (q0 + q1) * (q0 + q1), F.try_divide(q0 * q0, F.col("n0") - 1) + F.try_divide(q1 * q1, F.col("n1") - 1)
    )
    return rows.select("name", F.try_divide(F.col("m0") - F.col("m1"), F.sqrt(q0 + q1)).alias("statistic"), dof.alias("dof"))


def distance_of_shares(counts: DataFrame) -> Column:
    """Jensen-Shannon distance (base 2) as an aggregate over rows with counts n0, n1 and totals t0, t1."""
    p, q = F.try_divide(F.col("n0"), F.col("t0")), F.try_divide(F.col("n1"), F.col("t1"))
    m = (p + q) / 2
    part = lambda s: F.when(s > 0, s * F.log2(F.try_divide(s, m))).otherwise(F.lit(0.0))
    return F.sqrt(F.greatest(F.sum(part(p) + part(q)) / 2, F.lit(0.0)))


def js_distance(history: DataFrame, new: DataFrame, column: str, bins: int = BINS) -> DataFrame:
    """Distance between histograms on common edges (range of both sides, last bin closed)."""
    rows = both_sides(history, new, [column]).where(F.col(column).isNotNull())
    ends = rows.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    place = F.coalesce(F.try_divide(F.col(column) - F.col("lo"), (F.col("hi") - F.col("lo")) / bins), F.lit(0.0))
    counts = (
        scalar_join(rows, ends)
        .groupBy(F.least(F.lit(bins - 1), F.floor(place)).alias("bin"))
        .agg(F.count(F.when(F.col("side") == 0, 1)).alias("n0"), F.count(F.when(F.col("side") == 1, 1)).alias("n1"))
    )
    totals = counts.agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    return scalar_join(counts, totals).agg(distance_of_shares(counts).alias("statistic")).select(
        F.lit(column).alias("name"), "statistic"
    )


def hashed_width(texts: DataFrame, column: str) -> int:
    """Places for hashed words: a power of two of at least twice the distinct words, so few words share one."""
    words = F.explode(F.split(F.lower(F.col(column)), WORDS))
    known = texts.select(words.alias("w")).agg(F.approx_count_distinct("w", 0.02)).first()[0]
    return min(MOST_PLACES, 1 << max(10, (2 * known).bit_length()))


def text_clusters(history: DataFrame, new: DataFrame, column: str, clusters: int = CLUSTERS, features: int | None = None) -> DataFrame:
    """Rows (cluster, n0, n1): both sides assigned to clusters fitted on the history texts, so a number means the same on both.

    Words are hashed to as many places as the history's vocabulary needs; no vocabulary is gathered. Centres move
    until they rest; texts are weighted by idf and have length one, so long texts weigh as much as short ones.
    """
    text = F.coalesce(F.col(column).cast("string"), F.lit("")).alias("__text")
    past = history.select(text)
    width = hashed_width(past, "__text") if features is None else features
    weigh = Pipeline(
        stages=[
            RegexTokenizer(inputCol="__text", outputCol="__words", pattern=WORDS),
            HashingTF(inputCol="__words", outputCol="__tf", numFeatures=width),
            IDF(inputCol="__tf", outputCol="__idf"),
            Normalizer(inputCol="__idf", outputCol="__unit"),
        ]
    ).fit(past)
    # only the seeds come from the driver's k-means; its rounds would gather dense centres there
    seeds = KMeans(featuresCol="__unit", predictionCol="cluster", k=clusters, seed=CLUSTER_SEED, maxIter=0)
    vectors = weigh.transform(past).select("__unit").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = seeds.fit(vectors).clusterCenters()
    finally:
        vectors.unpersist()
    rows = past.withColumn("side", F.lit(0)).unionByName(new.select(text, F.lit(1).alias("side")))
    parts = weigh.transform(rows).select("side", F.unwrap_udt("__unit").alias("v")).select("side", "v.indices", "v.values")
    size = rows.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    found = settled_counts(parts, first, MOST_MOVES, max(1, -(-size // BLOCK_BYTES)))
    return history.sparkSession.createDataFrame(found, "cluster int, n0 long, n1 long")


def cluster_distance(history: DataFrame, new: DataFrame, column: str) -> DataFrame:
    counts = text_clusters(history, new, column)
    totals = counts.agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    return scalar_join(counts, totals).agg(distance_of_shares(counts).alias("statistic")).select(
        F.lit(column).alias("name"), "statistic"
    )


def accuracy(y: Column, p: Column) -> Column:
    return F.avg(F.when(y == p, 1.0).otherwise(0.0))


def score(df: DataFrame, actual: str, predicted: str, classification: bool = False) -> DataFrame:
    metric = accuracy if classification else r2
    return df.agg(metric(F.col(actual), F.col(predicted)).alias("statistic"))


def performance(
    new: DataFrame, actual: str, predicted: str, classification: bool = False, threshold: float = SCORE_THRESHOLD
) -> DataFrame:
    """Drift when the model's accuracy or R2 on new rows is below the threshold."""
    return score(new, actual, predicted, classification).withColumn("drift", F.col("statistic") < threshold)


def performance_change(
    history: DataFrame, new: DataFrame, actual: str, predicted: str, classification: bool = False,
    threshold: float = SCORE_THRESHOLD,
) -> DataFrame:
    """As ``performance``; otherwise drift when the new score is below the one on history."""
    past = score(history, actual, predicted, classification).withColumnRenamed("statistic", "history_statistic")
    return scalar_join(score(new, actual, predicted, classification), past).withColumn(
        "drift", (F.col("statistic") < threshold) | (F.col("statistic") < F.col("history_statistic"))
    )


def with_p(stats: DataFrame, method: str, tail: Callable[[float, float], float], threshold: float) -> DataFrame:
    """Add the tail probability and the flag to rows (name, statistic, dof)."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p = [tail(s, d) if pd.notna(s) and pd.notna(d) else None for s, d in zip(b["statistic"], b["dof"])]
            yield b.assign(p=pd.Series(p, index=b.index, dtype="float64"))

    out = stats.select("name", F.lit(method).alias("method"), "statistic", "dof")
    out = out.mapInPandas(add, "name string, method string, statistic double, dof double, p double")
    p = F.nanvl(F.col("p"), F.lit(None))
    return out.withColumn("p", p).withColumn("drift", F.coalesce(F.col("p") < threshold, F.lit(False)))


def with_distance(stats: DataFrame, method: str, threshold: float) -> DataFrame:
    """Flag rows (name, statistic) whose distance is above the threshold."""
    none = F.lit(None).cast("double")
    return stats.select(
        "name", F.lit(method).alias("method"), "statistic", none.alias("dof"), none.alias("p"),
        F.coalesce(F.col("statistic") > threshold, F.lit(False)).alias("drift"),
    )


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def detect(
    history: DataFrame | None,
    new: DataFrame,
    method: str,
    columns: Sequence[str] = (),
    *,
    actual: str | None = None,
    predicted: str | None = None,
    classification: bool = False,
    threshold: float | None = None,
) -> DataFrame:
    """One row per column (or one for a performance test): statistic, p and the drift flag.

    Without history every method reports drift.
    """
    p_limit = P_THRESHOLD if threshold is None else threshold
    score_limit = SCORE_THRESHOLD if threshold is None else threshold
    none = F.lit(None).cast("double")
    if history is None:
        return new.sparkSession.createDataFrame([(c, method, None, None, None, True) for c in (columns or ["*"])], RESULT)
    if method == "chi":
        parts = [with_p(chi_square(history, new, c), method, chi_square_tail, p_limit) for c in columns]
        return _stack(parts)
    if method == "ttest":
        return with_p(welch(history, new, columns), method, t_two_sided, p_limit)
    if method == "kl":
        return _stack([with_distance(js_distance(history, new, c), method, p_limit) for c in columns])
    if method == "Clustering":
        return _stack([with_distance(cluster_distance(history, new, c), method, p_limit) for c in columns])
    if method in ("ddm", "eddm"):
        one = (
            performance(new, actual, predicted, classification, score_limit)
            if method == "ddm"
            else performance_change(history, new, actual, predicted, classification, score_limit)
        )
        return one.select(
            F.lit(actual).alias("name"), F.lit(method).alias("method"), "statistic", none.alias("dof"), none.alias("p"), "drift"
        )
    raise ValueError(f"unknown drift method {method}")
