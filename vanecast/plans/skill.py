"""Four-hour-ahead forecast skill per group: the whole path from raw rows to scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.operators.clean import floor_time
from vanecast.operators.joins import lead_label, lookup_join
from vanecast.operators.metrics import REGRESSION, evaluate
from vanecast.operators.timegrid import asof_fill, group_grid
from vanecast.operators.window import Rolling, rolling_features


def forecast_skill(rows: DataFrame, group: list[str], time: str, value: str, minutes: int = 240) -> DataFrame:
    """Score a smoothed last-value forecast against what was observed ``minutes`` later.

    Rows are averaged per 15 minutes, filled forward on the grid, smoothed over
    the last hour and compared with the observed (unfilled) mean at the target
    time. Before an hour is known the history mean of the group is used.
    """
    series = rows.groupBy(*group, floor_time(time).alias("t")).agg(F.avg(value).alias("y"))
    grid = group_grid(series, group, "t")
    filled = asof_fill(grid, series, group, "t", ["y"])
    smooth = rolling_features(filled, group, ["t"], {"smooth": Rolling("ts_mean", "y", 4), "change": Rolling("diff", "y", 1)})
    mean = series.groupBy(*group).agg(F.avg("y").alias("mean"))
    labelled = lead_label(smooth, group, "t", "y", minutes, observed=series)
    scored = lookup_join(labelled, mean, group)
    forecast = F.coalesce("smooth", "mean")
    known = scored.where(F.col("label").isNotNull()).select(*group, "label", forecast.alias("y_pred"), "change")
    scores = evaluate(known, "label", "y_pred", REGRESSION, group)
    moves = known.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("change").alias("change_std"))
    return scores.join(moves, group)
