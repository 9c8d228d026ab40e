"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanecast.session import broadcast_rows, group_rows, sized

# A lookup that is broadcast takes at most this much memory in each executor.
BROADCAST_BYTES = 256 << 20


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which a NULL key equals a NULL key; right keys are dropped."""
    renamed = right
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"__r_{key}")
    condition = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys], F.lit(True)
    )
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def _bytes(kept: DataFrame) -> int:
    """Size of a table that has just been kept and counted."""
    return int(str(kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lookup_join(
    left: DataFrame, lookup: DataFrame, keys: list[str], broadcast_limit: int | None = None, unique: bool = False
) -> DataFrame:
    """Left join to a table that is unique per key.

    The lookup is counted first, and several rows for one key are an error; ``unique`` says that they are grouped
    by the key already. Small, in rows and in bytes: broadcast, so the left side is not shuffled. Large: a shuffle join in which each key holding more than
    ``group_rows`` left rows (NULL included) is spread over as many salts as it
    needs, and its one lookup row is copied to each. There are at most
    rows / group_rows such keys and copies, so their list may be broadcast.
    """
    spark = left.sparkSession
    limit = broadcast_rows(spark) if broadcast_limit is None else broadcast_limit
    lookup, rows = sized(lookup)
    if not unique:  # a NULL in the key counts on neither side
        keyed = F.count_if(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True)))
        many, distinct = lookup.agg(keyed, F.count_distinct(*keys)).first()
        if many > distinct:
            raise ValueError(f"the lookup has several rows for one value of {keys}")
    if rows <= limit and _bytes(lookup) <= BROADCAST_BYTES:
        return left.join(F.broadcast(lookup), keys, "left")
    most = group_rows(spark)
    salts = F.ceil(F.col("count") / most).cast("int").alias("__salts")
    hot, found = sized(left.groupBy(*keys).count().where(F.col("count") > most).select(*keys, salts))
    if not found:
        return left.join(lookup.hint("merge"), keys, "left")
    # the salt follows the input partition, so a repeated task gives the same salts
    salt = F.coalesce(F.pmod(F.spark_partition_id(), F.col("__salts")), F.lit(0)).cast("int")
    spread = null_safe_join(left, F.broadcast(hot), keys).withColumn("__salt", salt).drop("__salts")
    last = F.coalesce(F.col("__salts"), F.lit(1)) - 1
    copies = null_safe_join(lookup, F.broadcast(hot), keys).withColumn(
        "__salt", F.explode(F.sequence(F.lit(0), last))
    )
    return spread.join(copies.drop("__salts").hint("merge"), [*keys, "__salt"], "left").drop("__salt")


def scalar_join(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row."""
    return df.crossJoin(F.broadcast(one_row))


def full_outer_on_time(tower: DataFrame, fans: DataFrame, time: str) -> DataFrame:
    """Keep every timestamp of both sides (both unique per timestamp)."""
    return tower.join(fans, [time], "full")


def left_on_time(tower: DataFrame, fans: DataFrame, time: str) -> DataFrame:
    return tower.join(fans, [time], "left")


def _mark_known(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``__known`` is true where the key occurs in ``keys``; hot keys are spread as in ``lookup_join``."""
    return lookup_join(df, keys.select(*on).distinct().withColumn("__known", F.lit(True)), on, unique=True)


def keep_matching(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return _mark_known(df, keys, on).where(F.col("__known").isNotNull()).drop("__known")


def missing_from(df: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key does not occur in ``known``."""
    return _mark_known(df, known, on).where(F.col("__known").isNull()).drop("__known")


def lead_label(
    df: DataFrame, group: list[str], time: str, target: str, minutes: int, observed: DataFrame | None = None
) -> DataFrame:
    """``label`` = target observed ``minutes`` later, matched by time (unique per group and time).

    ``observed`` holds the target; by default the rows themselves.
    """
    future = (df if observed is None else observed).select(
        *group,
        (F.col(time) - F.expr(f"INTERVAL '{minutes}' MINUTE")).alias(time),
        F.col(target).alias("label"),
    )
    return df.join(future, [*group, time], "left")
