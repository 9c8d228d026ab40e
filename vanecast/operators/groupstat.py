"""Group statistics with separate fit and transform.

``fit`` aggregates the training rows into one small table per key; all
statistics with the same key come from one grouping. ``transform`` attaches
them to any rows by a left join, so validation rows see training statistics only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vanecast.operators.joins import lookup_join
from vanecast.operators.ordered import OrderedRows
from vanecast.session import sized

# Fixed value: stands for a missing category in label codes.
MISSING = "__NAN__"


@dataclass(frozen=True)
class GroupStat:
    """One statistic: operator, key column(s) and, where it needs one, a value column."""

    op: str
    keys: tuple[str, ...]
    value: str | None = None


STATS = {
    "count": lambda value: F.count(F.lit(1)),
    "crosscount": lambda value: F.count(F.lit(1)),
    "nunique": lambda value: F.count_distinct(F.col(value)),
    "aggmean": lambda value: F.avg(value),
    "aggmin": lambda value: F.min(value),
    "aggmax": lambda value: F.max(value),
    "aggstd": lambda value: F.stddev_samp(value),
}


@dataclass
class FittedStats:
    """Lookup tables by key, ready to be joined to any rows."""

    tables: dict[tuple[str, ...], DataFrame] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        for keys, table in self.tables.items():
            df = lookup_join(df, table, list(keys), unique=True)
        return df


def fit_stats(train: DataFrame, specs: Mapping[str, GroupStat]) -> FittedStats:
    by_key: dict[tuple[str, ...], dict[str, GroupStat]] = {}
    for name, spec in specs.items():
        by_key.setdefault(tuple(spec.keys), {})[name] = spec
    fitted = FittedStats()
    for keys, same in by_key.items():
        aggs = [STATS[s.op](s.value).alias(n) for n, s in same.items()]
        # a NULL key never matches at transform time
        fitted.tables[keys] = train.dropna(subset=list(keys)).groupBy(*keys).agg(*aggs)
    return fitted


def fit_frequency(train: DataFrame, columns: Sequence[str], normalize: bool = False) -> dict[str, DataFrame]:
    """Frequency of each value per column, optionally as a share of the training rows."""
    total = train.agg(F.count(F.lit(1)).alias("__total"))
    out = {}
    for c in columns:
        freq = train.dropna(subset=[c]).groupBy(c).agg(F.count(F.lit(1)).alias(f"{c}_freq"))
        if normalize:
            freq = freq.crossJoin(F.broadcast(total)).select(c, (F.col(f"{c}_freq") / F.col("__total")).alias(f"{c}_freq"))
        out[c] = freq
    return out


def encode_frequency(df: DataFrame, fitted: Mapping[str, DataFrame]) -> DataFrame:
    """Unseen and NULL values count 0."""
    for c, freq in fitted.items():
        df = lookup_join(df, freq, [c]).withColumn(f"{c}_freq", F.coalesce(F.col(f"{c}_freq"), F.lit(0)))
    return df


def _number_text(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("nan"))


def fit_combined(train: DataFrame, a: str, b: str) -> DataFrame:
    """Codes of the texts ``a_b`` from 0 in text order; numbering runs over the distinct texts."""
    text = F.concat(_number_text(train, a), F.lit("_"), _number_text(train, b))
    distinct = train.select(text.alias("__text")).distinct()
    return (
        OrderedRows(distinct, [], ["__text"]).positions("__code").select("__text", (F.col("__code") - 1).alias("__code"))
    )


def combine(df: DataFrame, codes: DataFrame, a: str, b: str, name: str) -> DataFrame:
    text = F.concat(_number_text(df, a), F.lit("_"), _number_text(df, b))
    out = lookup_join(df.withColumn("__text", text), codes, ["__text"], unique=True)
    return out.withColumnRenamed("__code", name).drop("__text")


def fit_labels(train: DataFrame, column: str) -> DataFrame:
    """Codes 0..k-1 of the sorted classes; NULL is a class of its own."""
    classes = train.select(F.coalesce(F.col(column).cast("string"), F.lit(MISSING)).alias(column)).distinct()
    return OrderedRows(classes, [], [column]).positions("code").withColumn("code", F.col("code") - 1)


def encode_labels(df: DataFrame, classes: DataFrame, column: str) -> DataFrame:
    """Replace the column by its code; unseen classes share the code after the last."""
    classes, unseen = sized(classes)
    text = df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit(MISSING)))
    coded = lookup_join(text, classes, [column])
    return coded.withColumn(column, F.coalesce(F.col("code"), F.lit(unseen))).drop("code")


def decode_labels(df: DataFrame, classes: DataFrame, code: str, name: str) -> DataFrame:
    """Class of a code; the code of unseen classes gives NULL."""
    back = classes.select(F.col("code").alias(code), F.col(classes.columns[0]).alias(name))
    back = back.withColumn(name, F.when(F.col(name) != MISSING, F.col(name)))
    return lookup_join(df, back, [code])
