"""Registered queries: a Spark callable per operator and, where possible, equal SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its survey id and operator name."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; zone-less times become UTC timestamps."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def nudge(digits: int) -> float:
    """Far below the last shown digit; moves decimal halves, such as means of 32 prices, off the tie."""
    return 3.7 * 10.0 ** -(digits + 4)


def r(x: Column | str, digits: int = 6) -> Column:
    return F.round((F.col(x) if isinstance(x, str) else x) + nudge(digits), digits)


def rounded(df: DataFrame, keep: list[str], values: list[str], digits: int = 6) -> DataFrame:
    return df.select(*keep, *[r(v, digits).alias(v) for v in values])


def ts(x: Column | str) -> Column:
    return F.date_format(F.col(x) if isinstance(x, str) else x, "yyyy-MM-dd HH:mm:ss")


# -- pieces of SQL ---------------------------------------------------------------


def R(x: str, digits: int = 6) -> str:
    """Rounded, without a negative zero."""
    return f"(round(({x}) + {nudge(digits)!r}, {digits}) + 0.0)"


def TS(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def Q15(x: str) -> str:
    """Start of the quarter hour."""
    return f"time_bucket(INTERVAL '15 minutes', {x})"


def CLIP(x: str) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE greatest(-1e7, least(1e7, {x})) END"


# a value below 1 counts as not measured
MASKED = "CASE WHEN value < 1 THEN NULL ELSE value END"


def masked(df: DataFrame) -> DataFrame:
    """Events with x (value, missing below 1) and y (user number)."""
    return df.withColumns({"x": F.when(F.col("value") >= 1, F.col("value")), "y": F.col("user_id").cast("double")})


# series: mean per event type and quarter hour, unique per (event_type, t)
SERIES_SQL = f"SELECT event_type, {Q15('ts')} AS t, avg(value) AS y FROM events GROUP BY ALL"


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    from vanecast.operators.clean import floor_time

    e = events(spark, sf_dir)
    return e.groupBy("event_type", floor_time("ts").alias("t")).agg(F.avg("value").alias("y"))
