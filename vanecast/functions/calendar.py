"""Calendar parts of a time column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "hour": F.hour,
    "minute": F.minute,
    "second": F.second,
    "dayofweek": F.weekday,  # Monday is 0
    "dayofyear": F.dayofyear,
    "quarter": F.quarter,
}


def calendar_columns(time: str) -> dict[str, Column]:
    return {name: part(F.col(time)) for name, part in PARTS.items()}


def add_calendar(df: DataFrame, time: str, parts: list[str] | None = None) -> DataFrame:
    columns = calendar_columns(time)
    return df.select("*", *[columns[p].alias(p) for p in (parts or PARTS)])


def varying_parts(df: DataFrame, time: str) -> list[str]:
    """Calendar parts with at least two values: min and max differ, found in one pass."""
    columns = calendar_columns(time)
    row = df.agg(*[(F.min(c) != F.max(c)).alias(n) for n, c in columns.items()]).first()
    return [n for n in PARTS if row[n]]


def add_varying_calendar(df: DataFrame, time: str) -> DataFrame:
    return add_calendar(df, time, varying_parts(df, time))
