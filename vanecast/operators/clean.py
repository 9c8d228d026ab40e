"""Cleaning: names, times, values, constant and duplicate columns."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanecast.operators.joins import scalar_join

# Characters replaced by "_" in column names.
SPECIAL_CHARACTERS = ":[]（）！＠＃￥％…《》【】 ()!@#$%^&*+={}|\\/?<>"
# Substitutes for infinite measurements.
INFINITY_LIMIT = 1e9
# A mean above the first is in watts-like units, below the second in mega-units.
RESCALE_ABOVE, RESCALE_BELOW, RESCALE_FACTOR = 10_000.0, 0.01, 1000.0


def clean_name(name: str) -> str:
    return name.strip().translate({ord(c): "_" for c in SPECIAL_CHARACTERS})


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def parse_time(text: Column | str) -> Column:
    """Timestamp from text; a bare date means midnight."""
    c = F.col(text) if isinstance(text, str) else text
    return F.to_timestamp(F.when(F.length(c) == 10, F.concat(c, F.lit(" 00:00:00"))).otherwise(c))


def between_times(df: DataFrame, time: str, start: datetime, end: datetime) -> DataFrame:
    return df.where(F.col(time).between(F.lit(start), F.lit(end)))


def newer_than(df: DataFrame, time: str, stored: DataFrame, stored_time: str | None = None) -> DataFrame:
    """Rows newer than the newest stored row; all rows when nothing is stored.

    The newest time is read first and compared as a literal, so the filter
    reaches the scan.
    """
    newest = stored.agg(F.max(stored_time or time)).first()[0]
    return df if newest is None else df.where(F.col(time) > F.lit(newest))


def training_rows(df: DataFrame, time: str, label: str, origin: datetime, minutes: int) -> DataFrame:
    """Rows whose label was already known at ``origin``."""
    cutoff = origin - timedelta(minutes=minutes)
    return df.where((F.col(time) < F.lit(cutoff)) & F.col(label).isNotNull())


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.dropna(subset=[target])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def fractional_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def bound_infinities(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    inf = float("inf")
    return df.withColumns(
        {
            c: F.when(F.col(c) == inf, INFINITY_LIMIT).when(F.col(c) == -inf, -INFINITY_LIMIT).otherwise(F.col(c))
            for c in (columns or fractional_columns(df))
        }
    )


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in (columns or fractional_columns(df))})


def drop_ignored(df: DataFrame, ignored: Sequence[str], protected: Sequence[str] = ()) -> DataFrame:
    return df.drop(*[c for c in ignored if c not in protected])


def constant_columns(df: DataFrame, protected: Sequence[str] = ()) -> list[str]:
    """Columns with at most one distinct value (NULL not counted): min equals max, one pass."""
    names = [c for c in df.columns if c not in protected]
    row = df.agg(*[F.min(c).eqNullSafe(F.max(c)).alias(c) for c in names]).first()
    return [c for c in names if row[c]]


def drop_constant(df: DataFrame, protected: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    dropped = constant_columns(df, protected)
    return df.drop(*dropped), dropped


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna("all")


def _percent_number(c: str) -> Column:
    """A value as a number, in which a final percent sign divides by 100; NULL where it is no number."""
    text = F.trim(F.col(c))
    number = F.regexp_replace(text, "%$", "").try_cast("double")
    return F.when(F.endswith(text, F.lit("%")), number / 100).otherwise(number)


def percent_columns(df: DataFrame) -> tuple[list[str], list[str]]:
    """String columns in which some value ends with a percent sign: those whose known values are all
    numbers, and those that hold other text too."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return [], []
    marked = [F.bool_or(F.endswith(F.trim(F.col(f"`{c}`")), F.lit("%"))).alias(f"m{i}") for i, c in enumerate(names)]
    whole = [F.bool_and(F.col(f"`{c}`").isNull() | _percent_number(f"`{c}`").isNotNull()).alias(f"w{i}") for i, c in enumerate(names)]
    row = df.agg(*marked, *whole).first()
    found = [(c, row[f"w{i}"]) for i, c in enumerate(names) if row[f"m{i}"]]
    return [c for c, w in found if w], [c for c, w in found if not w]


def percent_to_fraction(df: DataFrame) -> DataFrame:
    """Percentages as fractions, value by value; a column that also holds other text stays as it is."""
    return df.withColumns({c: _percent_number(f"`{c}`") for c in percent_columns(df)[0]})


def as_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def rescale_unit(df: DataFrame, column: str) -> DataFrame:
    """Divide by 1000 when the mean is very large, multiply when it is very small."""
    mean = df.agg(F.avg(column).alias("__mean"))
    x, m = F.col(column), F.col("__mean")
    scaled = (
        F.when(m > RESCALE_ABOVE, x / RESCALE_FACTOR).when(m < RESCALE_BELOW, x * RESCALE_FACTOR).otherwise(x)
    )
    return scalar_join(df, mean).withColumn(column, scaled).drop("__mean")


def zero_columns(df: DataFrame) -> list[str]:
    names = numeric_columns(df)
    row = df.agg(*[F.bool_and(F.col(c) == 0).alias(c) for c in names]).first()
    return [c for c in names if row[c]]


def drop_zero_columns(df: DataFrame) -> DataFrame:
    return df.drop(*zero_columns(df))


def distinct_content_columns(df: DataFrame, row_key: Sequence[str], columns: Sequence[str]) -> list[str]:
    """Columns with different content, the first of each equal set.

    Two independent 64-bit fingerprints over (row key, value) are summed per
    column; columns with equal fingerprints hold equal values.
    """
    def total(c: str, seed: int) -> Column:
        value = F.xxhash64(F.lit(seed), *row_key, F.col(c).cast("string"))
        return F.sum(value.cast("decimal(38,0)"))

    aggs = [F.struct(total(c, 1), total(c, 2)).alias(c) for c in columns]
    row = df.agg(*aggs).first()
    seen: dict = {}
    for c in columns:
        seen.setdefault(tuple(row[c]), c)
    return list(seen.values())


def drop_repeated_columns(df: DataFrame, row_key: Sequence[str]) -> DataFrame:
    others = [c for c in df.columns if c not in row_key]
    return df.select(*row_key, *distinct_content_columns(df, row_key, others))


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def floor_time(time: str, minutes: int = 15) -> Column:
    """Start of the interval that holds the time."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    step = minutes * 60_000_000
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step)))


def shift_minutes(time: str, minutes: int) -> Column:
    return F.col(time) + F.expr(f"INTERVAL '{minutes}' MINUTE")


def time_text(time: str) -> Column:
    return F.date_format(F.col(time), "yyyy-MM-dd HH:mm:ss")


def round_probability(p: Column) -> Column:
    return F.round(p, 5)


def submit_window(now: datetime, minutes: int, lag_minutes: int = 0, ahead_rows: int = 0) -> tuple[datetime, datetime]:
    """Base times to forecast: one horizon back from the lagged present, less the rows already ahead."""
    end = now.replace(minute=now.minute - now.minute % 15, second=0, microsecond=0)
    end += timedelta(minutes=lag_minutes)
    start = end - timedelta(minutes=minutes)
    return start, end - timedelta(minutes=15 * ahead_rows)


def keep_features(df: DataFrame, features: Sequence[str], target: str | None = None) -> DataFrame:
    """The model's inputs, and the target where the rows have it."""
    wanted = [*features, *([target] if target in df.columns else [])]
    return df.select(*wanted)


def constant_fill(df: DataFrame, column: str, value) -> DataFrame:
    """A constant where the column is missing or NULL."""
    filled = F.coalesce(F.col(column), F.lit(value)) if column in df.columns else F.lit(value)
    return df.withColumn(column, filled)
