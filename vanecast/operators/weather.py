"""Forecast vintages: keys, issue-time rules and joins.

A vintage table has one row per (issue time, target time). ``join_vintage``
takes, for each decision time, the forecast for ``time + horizon`` from the
issue chosen by a rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanecast.operators.clean import parse_time
from vanecast.operators.joins import keep_matching, lookup_join
from vanecast.operators.timegrid import first_per_key


def issue_text(date: str, time: str) -> Column:
    """The time column if it already holds a date, else date and time joined."""
    t = F.trim(F.col(time))
    return F.when(F.size(F.split(t, " ")) > 1, t).otherwise(F.concat_ws(" ", F.col(date), t))


def add_vintage_keys(df: DataFrame, issue_date: str, issue_time: str, target_time: str) -> DataFrame:
    """Timestamps ``issue`` and ``target``; rows lacking either are dropped."""
    return (
        df.withColumn("issue", parse_time(issue_text(issue_date, issue_time)))
        .withColumn("target", parse_time(target_time))
        .dropna(subset=["issue", "target"])
    )


def unique_vintages(df: DataFrame, order: Sequence[str]) -> DataFrame:
    return first_per_key(df, ["issue", "target"], order)


def _at_hour(time: str, hour: int, days_back: int = 0) -> Column:
    return F.date_trunc("day", F.col(time)) + F.expr(f"INTERVAL '{hour}' HOUR") - F.expr(f"INTERVAL '{days_back}' DAY")


_DAY = "INTERVAL '1' DAY"


def issue_published(time: str, latest_issue: Column, hour: int = 8, days_back: int = 0) -> Column:
    """Newest daily issue already published at the decision time, at most the latest one stored.

    Never later than the decision time, so no forecast leaks from the future.
    """
    issue = _at_hour(time, hour, days_back)
    issue = F.when(F.hour(time) < hour, issue - F.expr(_DAY)).otherwise(issue)
    return F.least(issue, latest_issue)


def issue_by_lead(time: str, minutes: int, hour: int = 8, days_back: int = 0) -> Column:
    """Legacy rule that may choose a later issue: short leads step back before the hour,
    nine-to-eleven-day leads stay, all others step forward from the hour on."""
    lead_hours = minutes // 60
    issue = _at_hour(time, hour, days_back)
    early = F.hour(time) < hour
    if 4 <= lead_hours < 24:
        issue = F.when(early, issue - F.expr(_DAY)).otherwise(issue)
    if 216 < lead_hours < 264:
        return issue
    return F.when(early, issue).otherwise(issue + F.expr(_DAY))


def issue_evening(time: str, minutes: int) -> Column:
    """Legacy rule of 20:00 issues: short leads step back before 16:00, others forward from 20:00."""
    issue = _at_hour(time, 20)
    if 4 <= minutes // 60 < 24:
        return F.when(F.hour(time) < 16, issue - F.expr(_DAY)).otherwise(issue)
    return F.when(F.hour(time) >= 20, issue + F.expr(_DAY)).otherwise(issue)


def join_vintage(
    df: DataFrame,
    vintages: DataFrame,
    time: str,
    minutes: int,
    issue: Column,
    suffix: str = "",
) -> DataFrame:
    """Left join on (target, issue); forecast columns get ``suffix``."""
    forecast = [c for c in vintages.columns if c not in ("issue", "target")]
    right = vintages.select(
        F.col("target").alias("__target"), F.col("issue").alias("__issue"),
        *[F.col(c).alias(f"{c}{suffix}") for c in forecast],
    )
    left = df.withColumn("__target", F.col(time) + F.expr(f"INTERVAL '{minutes}' MINUTE")).withColumn(
        "__issue", issue
    )
    return lookup_join(left, right, ["__target", "__issue"]).drop("__target", "__issue")


def by_target(sources: Sequence[DataFrame]) -> DataFrame:
    """One row per target: for source i the issues that forecast it, ascending (``__i{i}``), and their values (``__v{i}``).

    (issue, target) is unique in a source, so an array is as long as there are issues that
    reach one target. Rows lacking a key are left out; a repeated pair is an error.
    """
    rows = []
    for i, source in enumerate(sources):
        values = [F.col(c) for c in source.columns if c not in ("issue", "target")]
        vintage = F.struct(F.col("issue"), F.struct(*values).alias("values")).alias(f"__s{i}")
        rows.append(source.where(F.col("issue").isNotNull() & F.col("target").isNotNull()).select("target", vintage))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    by_issue = lambda a, b: F.when(a["issue"] < b["issue"], -1).when(a["issue"] > b["issue"], 1).otherwise(0)
    lists = stacked.groupBy("target").agg(
        *[F.array_sort(F.collect_list(f"__s{i}"), by_issue).alias(f"__s{i}") for i in range(len(sources))]
    )
    columns = []
    for i in range(len(sources)):
        issues = F.col(f"__s{i}.issue")
        repeated = F.raise_error(F.lit("a source has several rows for one issue and target"))
        columns.append(F.when(F.size(F.array_distinct(issues)) < F.size(issues), repeated).otherwise(issues).alias(f"__i{i}"))
        columns.append(F.col(f"__s{i}.values").alias(f"__v{i}"))
    return lists.select("target", *columns)


def join_vintages(
    df: DataFrame, sources: Sequence[DataFrame], time: str, minutes: int, days_back: Sequence[int], hour: int = 8
) -> DataFrame:
    """Every source at every day offset, suffixed ``_prev_day_{k}`` (and ``_src{i}`` after the first).

    All vintages of a target are one row, so the rows are joined once, by target; sources and
    offsets only look up their issue in its arrays.
    """
    if not sources:
        return df
    table = by_target(sources).withColumnRenamed("target", "__target").persist()
    latest = table.agg(*[F.max(F.get(F.col(f"__i{i}"), F.size(f"__i{i}") - 1)) for i in range(len(sources))]).first()
    joined = lookup_join(
        df.withColumn("__target", F.col(time) + F.expr(f"INTERVAL '{minutes}' MINUTE")), table, ["__target"], unique=True
    )
    forecasts = []
    for i, source in enumerate(sources):
        for k in days_back:
            suffix = ("" if i == 0 else f"_src{i}") + ("" if k == 0 else f"_prev_day_{k}")
            issue = issue_published(time, F.lit(latest[i]).cast(source.schema["issue"].dataType), hour, k)
            found = F.get(F.col(f"__v{i}"), F.array_position(F.col(f"__i{i}"), issue).cast("int") - 1)
            forecasts += [found[c].alias(f"{c}{suffix}") for c in source.columns if c not in ("issue", "target")]
    return joined.select(*[joined[c] for c in df.columns], *forecasts)


def join_by_target(df: DataFrame, vintages: DataFrame, time: str, minutes: int, issue: Column) -> DataFrame:
    """Average, per target, of the forecasts whose (issue, target) pair is asked for."""
    left = df.withColumn("__target", F.col(time) + F.expr(f"INTERVAL '{minutes}' MINUTE"))
    pairs = left.select(issue.alias("issue"), F.col("__target").alias("target"))
    forecast = [c for c in vintages.columns if c not in ("issue", "target")]
    chosen = keep_matching(vintages, pairs, ["issue", "target"])
    per_target = chosen.groupBy("target").agg(*[F.avg(c).alias(c) for c in forecast])
    return lookup_join(left, per_target.withColumnRenamed("target", "__target"), ["__target"]).drop("__target")


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total number of NULLs over the columns."""
    total = sum((F.coalesce(F.sum(F.col(c).isNull().cast("long")), F.lit(0)) for c in columns), F.lit(0))
    return df.agg(total.alias("nulls"))
