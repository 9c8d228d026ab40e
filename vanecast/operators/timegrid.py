"""Regular time grids: deduplication, as-of fill and interpolation.

Observations are first reduced to one row per (group, grid cell); the windows
that follow therefore see at most one row per grid point, so their size is set
by the time span and not by the number of observations.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanecast.operators.clean import floor_time
from vanecast.operators.ordered import OrderedRows

_CELL = "__cell"


def mean_per_time(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(v).alias(v) for v in values])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each key in a total order; a partial aggregate, so a hot key is no burden."""
    others = [c for c in df.columns if c not in keys]
    # the payload ends the comparison, so the choice is fixed even when the order has ties
    best = F.min(F.struct(*order, F.struct(*others).alias("row"))).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"best.row.{c}").alias(c) for c in others])


def time_range(start: Column, end: Column, minutes: int = 15) -> Column:
    return F.sequence(start, end, F.expr(f"INTERVAL '{minutes}' MINUTE"))


def grid_between(df: DataFrame, start: datetime, end: datetime, time: str, minutes: int = 15) -> DataFrame:
    """Every row of ``df`` with every grid time from start to end."""
    steps = time_range(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"), minutes)
    return df.select("*", F.explode(steps).alias(time))


def group_grid(df: DataFrame, group: Sequence[str], time: str, minutes: int = 15) -> DataFrame:
    """Grid of each group from its first to its last time, floored."""
    ends = df.groupBy(*group).agg(F.min(time).alias("__lo"), F.max(time).alias("__hi"))
    steps = time_range(floor_time("__lo", minutes), floor_time("__hi", minutes), minutes)
    return ends.select(*group, F.explode(steps).alias(time))


def ceil_time(time: str, minutes: int = 15) -> Column:
    """First grid time at or after the time."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    step = F.lit(minutes * 60_000_000)
    return F.timestamp_micros(micros + F.pmod(-micros, step))


def asof_fill(
    grid: DataFrame, observed: DataFrame, group: Sequence[str], time: str, values: Sequence[str], minutes: int = 15
) -> DataFrame:
    """Grid rows with the last observation at or before each grid time.

    Values at one timestamp are averaged. NULLs inside the last observation
    stay NULL. An observation counts from the grid time that follows it; only
    the last one per grid time can be the answer, so the rest are dropped by a
    partial aggregate before the ordered step.
    """
    unique = mean_per_time(observed, [*group, time], values)
    last = unique.groupBy(*group, ceil_time(time, minutes).alias(_CELL)).agg(*[F.max_by(v, time).alias(v) for v in values])
    row = F.struct(*[F.col(v) for v in values])
    events = last.select(*group, F.col(_CELL).alias(time), row.alias("__row"), F.lit(0).alias("__grid"))
    points = grid.select(*group, time, F.lit(None).cast(events.schema["__row"].dataType).alias("__row"), F.lit(1).alias("__grid"))
    rows = OrderedRows(points.unionByName(events), list(group), [time, "__grid"])
    filled = rows.fill_forward({"__last": F.col("__row")})
    return filled.where("__grid = 1").select(*group, time, *[F.col(f"__last.{v}").alias(v) for v in values])


def interpolate(
    df: DataFrame, group: Sequence[str], time: str, values: Sequence[str], minutes: int = 15
) -> DataFrame:
    """Linear interpolation by time on the grid of each group.

    Before the first known value the result is NULL, after the last one it
    repeats. Known values between grid points are used as neighbours. Per grid
    cell only the first and last known value can be a neighbour, so each value
    column is reduced to these two by a partial aggregate.
    """
    t = F.unix_micros(F.col(time).cast("timestamp"))
    per_cell, pairs = [], []
    for v in values:
        known = F.when(F.col(v).isNotNull(), t)
        per_cell += [
            F.min(known).alias(f"__ft_{v}"), F.min_by(v, known).alias(f"__fv_{v}"),
            F.max(known).alias(f"__lt_{v}"), F.max_by(v, known).alias(f"__lv_{v}"),
        ]
        for end in ("f", "l"):
            at = F.col(f"__{end}t_{v}")
            pair = F.struct(at.alias("t"), F.col(f"__{end}v_{v}").alias("v"))
            pairs.append(F.when(at.isNotNull(), pair).alias(f"__{'first' if end == 'f' else 'last'}_{v}"))
    unique = mean_per_time(df, [*group, time], values)
    cells = unique.groupBy(*group, floor_time(time, minutes).alias(time)).agg(*per_cell).select(*group, time, *pairs)
    ends = df.groupBy(*group).agg(F.min(time).alias("__lo"), F.max(time).alias("__hi"))
    grid = ends.select(*group, F.explode(time_range(floor_time("__lo", minutes), floor_time("__hi", minutes), minutes)).alias(time))
    joined = grid.join(cells, [*group, time], "left")
    # rows per group and in all follow from the ends, so nothing is counted
    points = F.floor((F.unix_micros(floor_time("__hi", minutes)) - F.unix_micros(floor_time("__lo", minutes))) / (minutes * 60_000_000)) + 1
    sizes = ends.agg(F.max(points), F.sum(points)).first()
    fills = {f"__p_{v}": ("last", F.col(f"__last_{v}"), False) for v in values}
    fills |= {f"__n_{v}": ("next", F.col(f"__first_{v}"), True) for v in values}
    near = OrderedRows(joined, list(group), [time], sizes=tuple(sizes)).fill(fills)
    at = F.unix_micros(F.col(time))
    for v in values:
        here = F.col(f"__first_{v}")
        near = near.withColumn(f"__p_{v}", F.when(here["t"] == at, here).otherwise(F.col(f"__p_{v}")))
    out = []
    for v in values:
        p, n = F.col(f"__p_{v}"), F.col(f"__n_{v}")
        slope = F.try_divide(n["v"] - p["v"], (n["t"] - p["t"]).cast("double"))
        line = p["v"] + slope * (F.unix_micros(F.col(time)) - p["t"])
        out.append(F.when(n.isNull() | (p["t"] == n["t"]), p["v"]).otherwise(line).alias(v))
    return near.select(*group, time, *out)
