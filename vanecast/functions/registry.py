"""Features by name: structured specs compiled to columns, lookups and windows."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanecast.functions import scalar
from vanecast.operators.groupstat import STATS, FittedStats, GroupStat, fit_combined, combine, fit_stats
from vanecast.operators.joins import lookup_join, scalar_join
from vanecast.operators.window import ROLLING_OPS, Ewm, Rolling, ewm_features, rolling_features

ONE_NUMBER = {
    "sine": scalar.sine,
    "cosine": scalar.cosine,
    "pow": scalar.square,
    "log": scalar.log,
    "sigmoid": scalar.sigmoid,
    "relu": scalar.relu,
    "tanh": scalar.tanh,
}
TWO_NUMBERS = {
    "add": scalar.add,
    "sub": scalar.sub,
    "mul": scalar.mul,
    "div": scalar.div,
    "std": scalar.row_std,
    "maximize": scalar.maximize,
}
ROW_LOCAL = {**ONE_NUMBER, **TWO_NUMBERS}
EWM_OPS = {"ewm_mean": "mean", "ewm_std": "std", "ewm_cov": "cov", "ewm_corr": "corr"}


@dataclass(frozen=True)
class Feature:
    """Operator, inputs (column names or other features) and, for time series, the row count."""

    op: str
    inputs: tuple
    span: int | None = None

    @property
    def name(self) -> str:
        parts = [i.name if isinstance(i, Feature) else i for i in self.inputs]
        return "__".join([self.op, *parts] + ([str(self.span)] if self.span else []))

    @property
    def depth(self) -> int:
        return 1 + max((i.depth for i in self.inputs if isinstance(i, Feature)), default=0)

    def input_names(self) -> list[str]:
        return [i.name if isinstance(i, Feature) else i for i in self.inputs]

    def spec(self) -> dict:
        """The feature as plain values, for storing."""
        return {"op": self.op, "inputs": [i.spec() if isinstance(i, Feature) else i for i in self.inputs], "span": self.span}

    @classmethod
    def from_spec(cls, spec: Mapping) -> Feature:
        return cls(spec["op"], tuple(cls.from_spec(i) if isinstance(i, Mapping) else i for i in spec["inputs"]), spec["span"])


def softmax(df: DataFrame, column: str, name: str) -> DataFrame:
    """exp(x) over its total, shifted by the maximum so that it cannot overflow."""
    top = df.agg(F.max(column).alias("__top"))
    shifted = scalar_join(df, top).withColumn("__e", F.exp(F.col(column) - F.col("__top")))
    total = shifted.agg(F.sum("__e").alias("__total"))
    return scalar_join(shifted, total).withColumn(name, F.col("__e") / F.col("__total")).drop("__top", "__e", "__total")


def normalize(df: DataFrame, column: str, name: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Linear map of the column's range to [low, high]; a constant maps to the middle."""
    ends = df.agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    share = (F.col(column) - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))
    value = F.when(F.col("__lo") == F.col("__hi"), F.when(F.col(column).isNotNull(), F.lit((low + high) / 2))).otherwise(
        low + share * (high - low)
    )
    return scalar_join(df, ends).withColumn(name, value).drop("__lo", "__hi")


class FeatureSet:
    """Fits a list of features on training rows and computes them on any rows.

    Features are evaluated in levels, nested inputs first. Within a level all
    row-local features share one select, statistics with one key share one
    grouping and window features share one sort. Features whose column exists
    are skipped.
    """

    def __init__(self, features: Sequence[Feature], group: Sequence[str] = (), order: Sequence[str] = ()):
        self.features, self.group, self.order = list(features), list(group), list(order)
        self.wanted = [f.name for f in features]
        ordered: dict[str, Feature] = {}
        for f in features:
            self._collect(f, ordered)
        depth = max((f.depth for f in ordered.values()), default=0)
        self.levels = [{n: f for n, f in ordered.items() if f.depth == d + 1} for d in range(depth)]
        self.fitted: list[dict] = []

    def _collect(self, f: Feature, into: dict[str, Feature]) -> None:
        known = ROW_LOCAL.keys() | STATS.keys() | ROLLING_OPS.keys() | EWM_OPS.keys() | {"softmax", "combine"}
        if f.op not in known:
            raise ValueError(f"unknown operator {f.op}")
        for i in f.inputs:
            if isinstance(i, Feature):
                self._collect(i, into)
        into.setdefault(f.name, f)

    def fit(self, train: DataFrame) -> FeatureSet:
        self.fitted = []
        rows = train
        for number, level in enumerate(self.levels):
            state: dict = {"combine": {}, "softmax": {}}
            stats = {}
            for n, f in level.items():
                if f.op in STATS:
                    names = f.input_names()
                    keyed = f.op in ("count", "crosscount")
                    stats[n] = GroupStat(f.op, tuple(names if keyed else names[:1]), None if keyed else names[1])
                elif f.op == "combine":
                    state["combine"][n] = fit_combined(rows, *f.input_names())
            state["stats"] = fit_stats(rows, stats)
            self.fitted.append(state)
            if number + 1 < len(self.levels):
                rows = self._apply(rows, level, state)
        return self

    def _apply(self, df: DataFrame, level: Mapping[str, Feature], state: dict, sizes: tuple[int, int] | None = None) -> DataFrame:
        todo = {n: f for n, f in level.items() if n not in df.columns}
        # window features first, while the rows that are put in order and sent to Python are narrow
        ewm = {n: f for n, f in todo.items() if f.op in EWM_OPS}
        if ewm:
            df = ewm_features(
                df, self.group, self.order,
                {n: Ewm(EWM_OPS[f.op], f.input_names()[0], f.span, (f.input_names() + [None])[1]) for n, f in ewm.items()},
                sizes=sizes,
            )
        rolling = {n: f for n, f in todo.items() if f.op in ROLLING_OPS}
        if rolling:
            df = rolling_features(
                df, self.group, self.order,
                {n: Rolling(f.op, f.input_names()[0], f.span, (f.input_names() + [None])[1]) for n, f in rolling.items()},
                sizes=sizes,
            )
        for keys, table in state["stats"].tables.items():
            names = [c for c in table.columns if c not in keys and c in todo]
            if names:
                df = lookup_join(df, table.select(*keys, *names), list(keys), unique=True)
        for n, f in todo.items():
            if f.op == "combine":
                df = combine(df, state["combine"][n], *f.input_names(), n)
            elif f.op == "softmax":
                df = softmax(df, f.input_names()[0], n)
        # row-local features last, so that no join copies them
        local = {n: ROW_LOCAL[f.op](*f.input_names()) for n, f in todo.items() if f.op in ROW_LOCAL}
        if local:
            df = df.select("*", *[c.alias(n) for n, c in local.items()])
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        """Input columns plus the requested features; helper columns of nested features are dropped."""
        columns, sizes = df.columns, None
        if any(f.op in ROLLING_OPS or f.op in EWM_OPS for level in self.levels for f in level.values()):
            counts = df.groupBy(*self.group).count() if self.group else df.groupBy().count()
            sizes = tuple(n or 0 for n in counts.agg(F.max("count"), F.sum("count")).first())
        for level, state in zip(self.levels, self.fitted, strict=True):
            df = self._apply(df, level, state, sizes)
        return df.select(*columns, *[n for n in self.wanted if n not in columns])

    # -- storing ------------------------------------------------------------------

    def save(self, spark: SparkSession, path: str) -> None:
        """Specs as one line of JSON, every fitted lookup as parquet."""
        levels = []
        for number, state in enumerate(self.fitted):
            stats = []
            for i, (keys, table) in enumerate(state["stats"].tables.items()):
                name = f"stats-{number}-{i}"
                table.write.mode("overwrite").parquet(f"{path}/{name}")
                stats.append({"keys": list(keys), "table": name})
            codes = {}
            for i, (feature, table) in enumerate(state["combine"].items()):
                codes[feature] = f"codes-{number}-{i}"
                table.write.mode("overwrite").parquet(f"{path}/{codes[feature]}")
            levels.append({"stats": stats, "combine": codes})
        text = json.dumps({"features": [f.spec() for f in self.features], "group": self.group, "order": self.order, "levels": levels})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/specs")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FeatureSet:
        """A fitted set that computes the same columns as the one that was saved."""
        stored = json.loads(spark.read.text(f"{path}/specs").first()["value"])
        out = cls([Feature.from_spec(f) for f in stored["features"]], stored["group"], [tuple(o) if isinstance(o, list) else o for o in stored["order"]])
        for level in stored["levels"]:
            stats = FittedStats({tuple(s["keys"]): spark.read.parquet(f"{path}/{s['table']}") for s in level["stats"]})
            codes = {f: spark.read.parquet(f"{path}/{t}") for f, t in level["combine"].items()}
            out.fitted.append({"stats": stats, "combine": codes, "softmax": {}})
        return out
