"""Mergeable summaries of one side of a drift test.

A summary holds, per numeric column, its moments and a histogram on a grid
whose step is a power of two, and per categorical column the rows per category.
One scan makes it whatever the number of columns. Summaries combine: moments
add up, steps double until both grids agree. So history is summarised once, is
stored, and each new batch is compared with it and folded into it without
reading history again. NaN and infinite values count as missing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from math import frexp

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vanecast.functions.distributions import chi_square_tail, t_two_sided
from vanecast.operators import drift
from vanecast.session import materialize

# A stored histogram has at most CELLS + 1 cells, a compared one at most COMPARED + 1.
CELLS, COMPARED = 1024, 64
# Moments of many tasks meet in lists of at most this many entries.
FAN_IN = 512
# Steps below 2 ** LEAST are not told apart.
LEAST = -1000

MOMENTS, CELL, CATEGORY = "moments", "cell", "category"
SUMMARY = (
    "name string, kind string, e int, cell long, category string, n long, mean double, m2 double, lo double, hi double"
)
_KEYS = ["name", "kind", "e", "cell", "category"]


def grid_exponent(lo: float, hi: float, cells: int) -> int:
    """Least e for which steps of 2 ** e cover [lo, hi] in ``cells`` steps, no finer than the numbers themselves."""
    share, up = frexp((hi / 2 - lo / 2) / cells)
    _, size = frexp(max(abs(lo), abs(hi)))
    wide = LEAST if share == 0 else up + (1 if share > 0.5 else 0)
    return max(wide, size - 53 if lo or hi else LEAST, LEAST)


def _grid_exponent(lo: Column, hi: Column, cells: int) -> Column:
    """The same inside a plan."""
    span, size = (hi / 2 - lo / 2) / F.lit(float(cells)), F.greatest(F.abs(lo), F.abs(hi))
    wide = F.when(span > 0, F.ceil(F.log2(span)) + 1)
    fine = F.when(size > 0, F.floor(F.log2(size)) + 1 - 53)
    return F.greatest(wide, fine, F.lit(LEAST)).cast("int")


class _Numbers:
    """Moments and cells of one column in one task."""

    def __init__(self) -> None:
        self.n, self.mean, self.m2 = 0, 0.0, 0.0
        self.lo, self.hi, self.e = np.inf, -np.inf, LEAST
        self.cells, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, values: np.ndarray) -> None:
        values = values[np.isfinite(values)]
        if not len(values):
            return
        n, mean = len(values), float(values.mean())
        m2, gap, total = float(((values - mean) ** 2).sum()), mean - self.mean, self.n + n
        self.m2 += m2 + gap * gap * self.n * n / total
        self.mean += gap * n / total
        self.n = total
        self.lo, self.hi = min(self.lo, float(values.min())), max(self.hi, float(values.max()))
        e = grid_exponent(self.lo, self.hi, CELLS)
        fresh = np.floor(np.ldexp(values, -e)).astype(np.int64)
        known = self.cells >> min(e - self.e, 63)
        weights = np.concatenate([self.counts, np.ones(n, np.int64)])
        self.cells, place = np.unique(np.concatenate([known, fresh]), return_inverse=True)
        self.counts = np.zeros(len(self.cells), np.int64)
        np.add.at(self.counts, place, weights)
        self.e = e

    def rows(self, name: str) -> Iterator[pd.DataFrame]:
        if not self.n:
            return
        k = len(self.cells)
        frame = {
            "name": name, "kind": [MOMENTS] + [CELL] * k, "e": self.e, "cell": [None, *self.cells.tolist()],
            "category": None, "n": [self.n, *self.counts.tolist()], "mean": [self.mean] + [None] * k,
            "m2": [self.m2] + [None] * k, "lo": self.lo, "hi": self.hi,
        }
        yield pd.DataFrame(frame).astype({"cell": "Int64"})


def _scan(numeric: Sequence[str], categorical: Sequence[str], prefix: str):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [_Numbers() for _ in numeric]
        for batch in batches:
            for i, numbers in enumerate(held):
                numbers.add(batch[f"{prefix}x{i}"].to_numpy(dtype="float64", na_value=np.nan))
            for i, name in enumerate(categorical):  # counts leave with their batch, so no task holds all categories
                counts = batch[f"{prefix}c{i}"].value_counts()
                yield pd.DataFrame({
                    "name": name, "kind": CATEGORY, "e": pd.array([None] * len(counts), "Int32"),
                    "cell": pd.array([None] * len(counts), "Int64"), "category": counts.index.to_numpy(object),
                    "n": counts.to_numpy(), "mean": np.nan, "m2": np.nan, "lo": np.nan, "hi": np.nan,
                })
        for name, numbers in zip(numeric, held):
            yield from numbers.rows(name)

    return scan


def _chan(parts: Column) -> Column:
    """Moments of the union of disjoint sets of rows."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def merge(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"), (a["mean"] + gap * b["n"] / n).alias("mean"),
            (a["m2"] + b["m2"] + gap * gap * (a["n"].cast("double") * b["n"] / n)).alias("m2"),
        )

    return F.aggregate(F.array_sort(parts), zero, merge)


def _add_up(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of equal keys as one; only moments carry more than a count."""
    part = F.when(F.col("kind") == MOMENTS, F.struct("n", "mean", "m2"))
    out = rows.groupBy(*keys).agg(
        F.sum("n").alias("n"), _chan(F.collect_list(part)).alias("__m"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    moments = F.col("kind") == MOMENTS
    return out.select(
        *keys, "n", F.when(moments, F.col("__m.mean")).alias("mean"), F.when(moments, F.col("__m.m2")).alias("m2"), "lo", "hi"
    )


def _coarser(rows: DataFrame, e: Column) -> DataFrame:
    """Cells on the grid of steps 2 ** e (a column or an expression, never below the rows' own)."""
    shift = F.least(F.lit(63), F.col("__e") - F.col("e"))
    rows = rows.withColumn("__e", e).withColumn("__shift", shift)
    return rows.withColumn("cell", F.expr("shiftright(cell, __shift)")).withColumn("e", F.col("__e")).drop("__e", "__shift")


def _fold(parts: DataFrame) -> DataFrame:
    """One summary out of the parts of many tasks or summaries."""
    # a category is a group of its own; the cells and moments of a column meet, at most CELLS + 2 rows per step size
    column = Window.partitionBy("name", "category")
    lo, hi = F.min("lo").over(column), F.max("hi").over(column)
    own = F.max("e").over(column)
    shared = F.when(F.col("kind") != CATEGORY, F.greatest(own, _grid_exponent(lo, hi, CELLS)))
    few = _add_up(parts.withColumn("__lot", F.when(F.col("kind") == MOMENTS, F.pmod(F.spark_partition_id(), F.lit(FAN_IN)))), [*_KEYS, "__lot"])
    few = _add_up(few.drop("__lot"), _KEYS)
    out = _add_up(_coarser(few.withColumns({"lo": lo, "hi": hi}), shared), _KEYS)
    return out.select(*[F.col(f.split()[0]) for f in SUMMARY.split(", ")])


def summarise(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = ()) -> DataFrame:
    """The summary of the given columns, made in one scan; an empty table gives an empty summary.

    The tests read a summary several times: store it or ``materialize`` it first.
    """
    prefix = "__"
    columns = [F.col(c).cast("double").alias(f"{prefix}x{i}") for i, c in enumerate(numeric)]
    columns += [F.col(c).cast("string").alias(f"{prefix}c{i}") for i, c in enumerate(categorical)]
    return _fold(df.select(*columns).mapInPandas(_scan(list(numeric), list(categorical), prefix), SUMMARY))


def combine(*summaries: DataFrame) -> DataFrame:
    """The summary of all rows that the given ones stand for."""
    return _fold(reduce(DataFrame.unionByName, summaries))


# -- tests on two summaries --------------------------------------------------------


def _sides(history: DataFrame, new: DataFrame, kind: str) -> DataFrame:
    rows = history.withColumn("side", F.lit(0)).unionByName(new.withColumn("side", F.lit(1)))
    return rows.where(F.col("kind") == kind)


def _side(column: str, side: int) -> Column:
    return F.max(F.when(F.col("side") == side, F.col(column)))


def _counts() -> list[Column]:
    return [F.coalesce(F.sum(F.when(F.col("side") == s, F.col("n"))), F.lit(0)).alias(f"n{s}") for s in (0, 1)]


def welch(history: DataFrame, new: DataFrame) -> DataFrame:
    """t and degrees of freedom of every numeric column."""
    both = _sides(history, new, MOMENTS).groupBy("name").agg(*[_side(c, s).alias(f"{c}{s}") for c in ("n", "mean", "m2") for s in (0, 1)])
    # one value has no variance
    q0, q1 = [F.try_divide(F.try_divide(F.col(f"m2{s}"), F.col(f"n{s}") - 1), F.col(f"n{s}")) for s in (0, 1)]
    dof = F.try_divide(
        (q0 + q1) * (q0 + q1), F.try_divide(q0 * q0, F.col("n0") - 1) + F.try_divide(q1 * q1, F.col("n1") - 1)
    )
    return both.select("name", F.try_divide(F.col("mean0") - F.col("mean1"), F.sqrt(q0 + q1)).alias("statistic"), dof.alias("dof"))


def chi_square(history: DataFrame, new: DataFrame) -> DataFrame:
    """Homogeneity statistic and degrees of freedom of every categorical column; two categories get the correction."""
    table = _sides(history, new, CATEGORY).where(F.col("category").isNotNull()).groupBy("name", "category").agg(*_counts())
    sums = table.groupBy("name").agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"), F.count(F.lit(1)).alias("k"))
    both, total = (F.col("n0") + F.col("n1")).cast("double"), (F.col("t0") + F.col("t1")).cast("double")
    cells = []
    for side in (0, 1):
        expected = F.try_divide(both * F.col(f"t{side}"), total)
        gap = F.abs(F.col(f"n{side}") - expected)
        gap = F.when(F.col("k") == 2, F.greatest(gap - 0.5, F.lit(0.0))).otherwise(gap)
        cells.append(F.try_divide(gap * gap, expected))
    # one row per column: as many as the caller named
    return (
        table.join(F.broadcast(sums), "name").groupBy("name")
        .agg(F.sum(cells[0] + cells[1]).alias("statistic"), (F.max("k") - 1).cast("double").alias("dof"))
    )


def js_distance(history: DataFrame, new: DataFrame, cells: int = COMPARED) -> DataFrame:
    """Distance between the histograms of every numeric column on common steps.

    The step is the smallest power of two that covers the range of both sides in
    ``cells`` steps. Stored steps are at most as wide, so counts are exact.
    """
    if cells > CELLS // 2:
        raise ValueError(f"stored histograms can be compared in at most {CELLS // 2} cells")
    rows = _sides(history, new, CELL)
    column = Window.partitionBy("name")
    lo, hi = F.min("lo").over(column), F.max("hi").over(column)
    step = F.greatest(F.max("e").over(column), F.ceil(F.log2((hi - lo) / F.lit(float(cells)))).cast("int"))
    step = F.when(hi > lo, step).otherwise(F.max("e").over(column))
    counts = _coarser(rows, step).groupBy("name", "cell").agg(*_counts())
    totals = counts.groupBy("name").agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    return counts.join(F.broadcast(totals), "name").groupBy("name").agg(drift.distance_of_shares(counts).alias("statistic"))


def detect(history: DataFrame | None, new: DataFrame, method: str, threshold: float = drift.P_THRESHOLD) -> DataFrame:
    """Statistic, p and drift flag of every column that the method can test; all drift without history."""
    if history is None:
        kind = F.col("kind") == (CATEGORY if method == "chi" else MOMENTS)
        none = F.lit(None).cast("double")
        return new.where(kind).select("name").distinct().select(
            "name", F.lit(method).alias("method"), none.alias("statistic"), none.alias("dof"), none.alias("p"), F.lit(True).alias("drift")
        )
    if method == "ttest":
        return drift.with_p(welch(history, new), method, t_two_sided, threshold)
    if method == "chi":
        return drift.with_p(chi_square(history, new), method, chi_square_tail, threshold)
    if method == "kl":
        return drift.with_distance(js_distance(history, new), method, threshold)
    raise ValueError(f"no summary serves the drift method {method}")


# -- the stored history -------------------------------------------------------------


class SummaryStore:
    """Numbered states of a history in a shared folder.

    State n is state n-1 and batch n. A repeated batch writes its own state
    again from the one before, so it counts once; a reader never sees files replaced
    that belong to an earlier state.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def state(self, number: int) -> DataFrame | None:
        """The history up to and with batch ``number``."""
        try:
            return self.spark.read.schema(SUMMARY).parquet(f"{self.path}/state={number}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def start(self, summary: DataFrame, number: int = -1) -> None:
        """The history before the first batch."""
        summary.write.mode("overwrite").parquet(f"{self.path}/state={number}")

    def advance(self, number: int, batch: DataFrame) -> None:
        """Fold the summary of batch ``number`` into the history."""
        before = self.state(number - 1)
        if before is None and number > 0:
            raise ValueError(f"batch {number} comes without the state of batch {number - 1}")
        (batch if before is None else combine(before, batch)).write.mode("overwrite").parquet(f"{self.path}/state={number}")


def check_batch(
    store: SummaryStore, number: int, batch: DataFrame, method: str, numeric: Sequence[str] = (),
    categorical: Sequence[str] = (), threshold: float = drift.P_THRESHOLD,
) -> DataFrame:
    """Test a batch against the stored history, then let it join the history; reads the batch once."""
    summary = materialize(summarise(batch, numeric, categorical), "batch-summary")
    result = materialize(detect(store.state(number - 1), summary, method, threshold), "batch-drift")
    store.advance(number, summary)
    return result
