"""Samples, class balancing and splits, all with a reproducible total order.

Places inside a class come from ``OrderedRows``, so a class holding a third of
all rows is numbered by many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanecast.operators.cut import first_rows
from vanecast.operators.joins import lookup_join
from vanecast.operators.knn import neighbour_distance
from vanecast.operators.ordered import OrderedRows, OrderItem, first_rows_per_group
from vanecast.session import materialize

# Fixed value: classes smaller than this are filled up when no mode is chosen.
SMALL_CLASS = 10
# A task makes at most this many copies of one row at a time.
COPIES_PER_TASK = 100_000


def top_rows(df: DataFrame, order: Sequence[OrderItem], n: int) -> DataFrame:
    """First ``n`` rows of the total order, as a set."""
    return first_rows(df, order, n)


def random_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in hash order of the key: random but the same on every run and retry."""
    hashed = df.withColumn("__h", F.xxhash64(F.lit(seed), *key))
    return top_rows(hashed, ["__h", *key], n).drop("__h")


def median_half(df: DataFrame, target: str, key: Sequence[str], name: str = "half") -> DataFrame:
    """0 for the lower and 1 for the upper half by (target, key); the lower half gets the odd row."""
    placed = OrderedRows(df, [], [target, *key]).positions("__place")
    n = df.count()
    return placed.withColumn(name, F.when(F.col("__place") <= math.ceil(n / 2), 0).otherwise(1)).drop("__place")


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def rarest_class(df: DataFrame, target: str) -> DataFrame:
    counts = class_counts(df, target)
    return counts.agg(F.min(F.struct("n", target)).alias("m")).select(f"m.{target}", "m.n")


def _shuffled(df: DataFrame, key: Sequence[str], seed: int | None) -> tuple[DataFrame, list[str], list[str]]:
    """Order columns: by key, or by seeded hash of the key."""
    if seed is None:
        return df, list(key), []
    return df.withColumn("__h", F.xxhash64(F.lit(seed), *key)), ["__h", *key], ["__h"]


def uniform_sample(
    df: DataFrame, target: str, key: Sequence[str], size: int, classification: bool = True, seed: int | None = None
) -> DataFrame:
    """The same number of rows of every class, or of each half of the target."""
    by, rows = (target, df) if classification else ("__half", median_half(df, target, key, "__half"))
    smallest = rows.groupBy(by).count().agg(F.min("count")).first()[0] or 0
    rows, order, extra = _shuffled(rows, key, seed)
    out = first_rows_per_group(rows, [by], order, F.lit(min(size, smallest)))
    return out.drop(*extra, "__half")


def latest_rows(df: DataFrame, time: str, key: Sequence[str], n: int) -> DataFrame:
    return top_rows(df, [(time, "desc"), *[(k, "desc") for k in key]], n)


def uncertain_rows(df: DataFrame, uncertainty: Column, key: Sequence[str], n: int) -> DataFrame:
    """The ``n`` rows with the largest residual, or the lowest probability of their class."""
    scored = df.withColumn("uncertainty", uncertainty)
    return top_rows(scored, [("uncertainty", "desc"), *key], n)


def density_sample(
    df: DataFrame, key: str, columns: Sequence[str], n: int, k: int = 10, order: str = "sparse"
) -> DataFrame:
    """``n`` rows by mean distance to their ``k`` nearest neighbours, sparse or dense first."""
    if order not in ("sparse", "dense"):
        raise ValueError("order is 'sparse' or 'dense'")
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    scored = materialize(neighbour_distance(df.withColumn("__vec", vector), key, "__vec", k).drop("__vec"), "distances")
    direction = "desc" if order == "sparse" else "asc"
    return top_rows(scored, [("distance", direction), key], n)


def sample_history(
    df: DataFrame,
    method: str,
    key: Sequence[str],
    size: int,
    above: int | None = None,
    *,
    target: str | None = None,
    time: str | None = None,
    columns: Sequence[str] | None = None,
    uncertainty: Column | None = None,
    classification: bool = False,
    seed: int = 42,
) -> DataFrame:
    """``size`` rows by the named method; if ``above`` is given, tables of up to that many rows stay whole."""
    methods = {
        "random": lambda: random_rows(df, key, size, seed),
        "uniform": lambda: uniform_sample(df, target, key, size, classification, seed),
        "timewindow": lambda: latest_rows(df, time, key, size),
        "uncertainty": lambda: uncertain_rows(df, uncertainty, key, size),
        "importance": lambda: density_sample(df, key[0], columns, size, min(10, len(columns))),
    }
    if method not in methods:
        raise ValueError(f"unknown sampling method {method}")
    return methods[method]() if above is None or df.count() > above else df


# -- class balancing --------------------------------------------------------------------


def _fill(df: DataFrame, target: str, wanted: Column, key: Sequence[str]) -> DataFrame:
    """Repeat the rows of each class in turn until it has ``wanted`` rows (column over n)."""
    counts = class_counts(df, target).withColumn("__want", wanted)
    placed = OrderedRows(df, [target], list(key)).positions("__place")
    rows = lookup_join(placed, counts, [target])
    # place p of n is used once for each copy c with p + c*n <= want
    copies = F.greatest(F.lit(1), F.ceil((F.col("__want") - F.col("__place") + 1) / F.col("n"))).cast("long")
    rows = rows.select(*df.columns, copies.alias("__copies"))
    most = counts.agg(F.max(F.ceil(F.col("__want") / F.col("n")))).first()[0] or 1
    if most > COPIES_PER_TASK:
        # a row with very many copies is first cut into pieces that go to different tasks
        last = F.floor((F.col("__copies") - 1) / COPIES_PER_TASK)
        rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("__piece"))
        left = F.col("__copies") - F.col("__piece") * COPIES_PER_TASK
        rows = rows.withColumn("__copies", F.least(left, F.lit(COPIES_PER_TASK))).repartition(*key, "__piece")
    return rows.select(*df.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("__copy")).drop("__copy")


def fill_small_classes(df: DataFrame, target: str, key: Sequence[str], least: int = SMALL_CLASS) -> DataFrame:
    return _fill(df, target, F.greatest(F.col("n"), F.lit(least)), key)


def oversample(df: DataFrame, target: str, key: Sequence[str]) -> DataFrame:
    largest = class_counts(df, target).agg(F.max("n")).first()[0] or 0
    return _fill(df, target, F.lit(largest), key)


def undersample(df: DataFrame, target: str, key: Sequence[str], seed: int | None = None) -> DataFrame:
    smallest = class_counts(df, target).agg(F.min("n")).first()[0] or 0
    rows, order, extra = _shuffled(df, key, seed)
    return first_rows_per_group(rows, [target], order, F.lit(smallest)).drop(*extra)


# -- splits ------------------------------------------------------------------------------------


def stratified_split(
    df: DataFrame, stratum: str, key: Sequence[str], test_size: float = 0.2, seed: int | None = None
) -> DataFrame:
    """Adds ``is_test``: the first ceil(test_size * n) rows of each stratum."""
    rows, order, extra = _shuffled(df, key, seed)
    placed = OrderedRows(rows, [stratum], order).positions("__place")
    counts = class_counts(df, stratum).select(stratum, F.ceil(F.col("n") * test_size).alias("__test"))
    out = lookup_join(placed, counts, [stratum])
    return out.withColumn("is_test", F.col("__place") <= F.col("__test")).drop("__place", "__test", *extra)


def time_split(df: DataFrame, time: str, key: Sequence[str], test_size: float = 0.2) -> DataFrame:
    """Adds ``is_test``: rows after the first int(n * (1 - test_size)) in time order."""
    train = int(df.count() * (1 - test_size))
    placed = OrderedRows(df, [], [time, *key]).positions("__place")
    return placed.withColumn("is_test", F.col("__place") > train).drop("__place")


def random_split(df: DataFrame, key: Sequence[str], test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_test`` from a hash of the key, so a retry or a second read splits alike."""
    share = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1_000_000)) / 1_000_000
    return df.withColumn("is_test", share < test_size)
