"""Forecasts with fallback and rolling-origin back-tests.

Origins are rows, so all of them are evaluated in one job. History means come
from sums per origin step and their running totals: an observation is read once
however many origins lie after it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vanecast.operators.clean import time_text
from vanecast.operators.joins import lookup_join, scalar_join
from vanecast.operators.metrics import r2, rse

QUARTER = 15  # minutes between rows


@dataclass(frozen=True)
class Task:
    """A named horizon: ``rows`` steps of 15 minutes."""

    name: str
    rows: int

    @property
    def minutes(self) -> int:
        return self.rows * QUARTER


# The horizons of the forecast tasks, in 15-minute rows.
TASKS = {"Forecast4Hour": Task("Forecast4Hour", 16)} | {
    f"Forecast{d}Day": Task(f"Forecast{d}Day", 96 * d) for d in range(1, 11)
}


def with_fallback(grid: DataFrame, predictions: DataFrame, mean: DataFrame, time: str, minutes: int, on: Sequence[str]) -> DataFrame:
    """Forecast rows on the full grid of base times: prediction, else history mean.

    ``predictions`` has columns ``on`` + ``y_pred``; ``mean`` has one row (column
    ``mean``) or one row per group of ``on``.
    """
    by = [c for c in on if c != time and c in mean.columns]
    rows = grid.join(predictions, list(on), "left")
    rows = lookup_join(rows, mean, by) if by else scalar_join(rows, mean)
    target = F.col(time) + F.expr(f"INTERVAL '{minutes}' MINUTE")
    out = rows.select(
        *[c for c in on if c != time],
        F.col(time).alias("base_time"),
        target.alias("date_time"),
        F.coalesce("y_pred", "mean").alias("power"),
    )
    first = out.agg(F.min("date_time").alias("exec_point"))
    return scalar_join(out, first)


def forecast_text(forecast: DataFrame) -> DataFrame:
    """Times as text, as exported."""
    return forecast.withColumns({c: time_text(c) for c in ("base_time", "date_time", "exec_point")})


@dataclass(frozen=True)
class Origins:
    """Forecast origins every ``step`` from ``first`` on, ``count`` of them."""

    first: datetime
    step: timedelta
    count: int

    def at(self, number: Column) -> Column:
        seconds = int(self.step.total_seconds())
        return F.lit(self.first).cast("timestamp") + F.make_dt_interval(secs=(number * seconds).cast("decimal(18,6)"))

    def number_after(self, time: str) -> Column:
        """Number of the first origin later than the time; may be negative."""
        micros = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.lit(self.first).cast("timestamp"))
        step = int(self.step.total_seconds()) * 1_000_000
        return F.floor(micros / step) + 1


def history_means(
    series: DataFrame, group: Sequence[str], time: str, value: str, origins: Origins, lookback: timedelta | None = None
) -> DataFrame:
    """Mean of the values strictly before each origin, optionally only ``lookback`` back (a multiple of the step)."""
    bins = series.groupBy(*group, origins.number_after(time).alias("number")).agg(
        F.sum(value).alias("s"), F.count(value).alias("c")
    )
    steps = F.sequence(F.lit(0).cast("long"), F.lit(origins.count - 1).cast("long")) if origins.count > 0 else F.array().cast("array<long>")
    numbers = F.explode(steps)
    zero = [F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("c"), F.lit(True).alias("wanted")]
    wanted = series.select(*group).distinct().select(*group, numbers.alias("number"), *zero)
    both = bins.withColumn("wanted", F.lit(False)).unionByName(wanted)
    low = Window.unboundedPreceding if lookback is None else -(int(lookback / origins.step) - 1)
    # one row per origin step: the window is bounded by the time span
    w = Window.partitionBy(*group).orderBy("number").rangeBetween(low, 0)
    sums = both.select(*group, "number", "wanted", F.sum("s").over(w).alias("s"), F.sum("c").over(w).alias("c"))
    return sums.where("wanted").select(
        *group, F.col("number").cast("int").alias("number"), F.try_divide(F.col("s"), F.col("c")).alias("mean")
    )


def targets(means: DataFrame, origins: Origins, rows: int, sub_origins: int = 1) -> DataFrame:
    """Target times of every origin: ``rows`` quarters from each of its sub-origins."""
    out = means.withColumn("origin", origins.at(F.col("number")))
    subs = F.explode(F.sequence(F.lit(0), F.lit(sub_origins - 1)))
    out = out.select("*", subs.alias("sub"))
    start = F.col("origin") + F.make_dt_interval(mins=F.col("sub") * QUARTER)
    out = out.withColumn("exec_point", start)
    steps = F.sequence(
        F.col("exec_point"), F.col("exec_point") + F.expr(f"INTERVAL '{(rows - 1) * QUARTER}' MINUTE"), F.expr(f"INTERVAL '{QUARTER}' MINUTE")
    )
    return out.select("*", F.explode(steps).alias("date_time"))


def backtest_naive(
    series: DataFrame,
    group: Sequence[str],
    time: str,
    value: str,
    origins: Origins,
    rows: int,
    sub_origins: int = 1,
    lookback: timedelta | None = None,
) -> DataFrame:
    """Seasonal-naive forecasts of all origins joined with the actual values.

    The prediction is the value a whole number of days earlier, the fewest that
    lie before the origin; where it is missing, the mean of the history. Both
    use values before the origin only. ``series`` is unique per group and time.
    """
    wanted = targets(history_means(series, group, time, value, origins, lookback), origins, rows, sub_origins)
    ahead = F.unix_micros("date_time") - F.unix_micros("origin")
    days = (F.floor(ahead / 86_400_000_000) + 1).cast("int")
    wanted = wanted.withColumn("__past", F.col("date_time") - F.make_dt_interval(days=days))
    past = series.select(*group, F.col(time).alias("__past"), F.col(value).alias("__seen"))
    actual = series.select(*group, F.col(time).alias("date_time"), F.col(value).alias("y_true"))
    seen = F.col("__seen")
    if lookback is not None:
        oldest = F.col("origin") - F.expr(f"INTERVAL '{int(lookback.total_seconds())}' SECOND")
        seen = F.when(F.col("__past") >= oldest, seen)
    return (
        wanted.join(past, [*group, "__past"], "left")
        .join(actual, [*group, "date_time"], "left")
        .select(*group, "origin", "exec_point", "date_time", F.coalesce(seen, F.col("mean")).alias("y_pred"), "y_true")
    )


def summarize(results: DataFrame, by: Sequence[str]) -> DataFrame:
    """Root of the squared error sum and R2 per back-test run."""
    known = results.where(F.col("y_true").isNotNull() & F.col("y_pred").isNotNull())
    y, p = F.col("y_true"), F.col("y_pred")
    return known.groupBy(*by).agg(rse(y, p).alias("rse"), r2(y, p).alias("r2"), F.count(F.lit(1)).alias("n"))


def tasks_within(results: DataFrame, tasks: Mapping[str, int]) -> DataFrame:
    """Back-tests of several tasks (name to number of quarters) from the one of the longest: each has its first quarters."""
    quarter = F.expr(f"(unix_micros(date_time) - unix_micros(exec_point)) DIV {QUARTER * 60_000_000}")
    lengths = F.array(*[F.struct(F.lit(name).alias("task"), F.lit(rows).alias("rows")) for name, rows in tasks.items()])
    held = F.filter(lengths, lambda x: x["rows"] > quarter)
    return results.withColumn("__task", F.explode(held)).select(*results.columns, F.col("__task.task").alias("task"))
