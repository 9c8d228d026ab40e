"""Connected components of a link table, by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.session import materialize

ROWS_PER_TASK = 200_000  # of the narrow tables here


def compact(df: DataFrame, rows: int) -> DataFrame:
    """As many tasks as the rows of a narrow table need."""
    return df.coalesce(max(8, rows // ROWS_PER_TASK))


def components(edges: DataFrame) -> DataFrame:
    """(``id``, ``component``): the smallest id reachable, for every id in ``edges`` (``a``, ``b``).

    Each round hooks every component to its smallest neighbour, renames the links by the
    hooks and carries on with those between different components; the hooks of all rounds,
    one after the other, give the labels.  Distances halve at least, so there are few rounds.
    """
    links = materialize(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "links")
    ids = links.select(F.explode(F.array("lo", "hi")).alias("id")).distinct()
    links = links.filter("lo < hi")
    rounds: list[DataFrame] = []
    rows = links.count()
    while rows:
        hooks = materialize(compact(links.groupBy("hi").agg(F.min("lo").alias("lo")), rows), "hooks")
        rounds.append(hooks)
        high = hooks.select("hi", F.col("lo").alias("__hi"))
        low = hooks.select(F.col("hi").alias("lo"), F.col("lo").alias("__lo"))
        moved = links.join(high, "hi").join(low, "lo", "left").select(F.coalesce("__lo", "lo").alias("x"), F.col("__hi").alias("y"))
        moved = moved.filter("x <> y").select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct()
        links = materialize(compact(moved, rows), "links")
        rows = links.count()
    labels = ids.withColumn("component", F.col("id"))
    for hooks in rounds:
        labels = labels.join(hooks.select(F.col("hi").alias("component"), "lo"), "component", "left").select("id", F.coalesce("lo", "component").alias("component"))
    return materialize(labels, "labels")
