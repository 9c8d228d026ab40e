"""The first n rows of a table without sorting it or gathering n rows per task.

The key of the n-th row is narrowed down by histograms of fixed size: rows before
its bucket are in, rows after it are out, and the next histogram splits only the
bucket. What is left in the end is small enough to be sorted; where ties keep it
large, the next key of the order goes on, and last of all places are numbered.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanecast.operators.ordered import OrderedRows, OrderItem, sort_columns

# So few rows are gathered per task without more ado.
FEW = 100
# A border of at most this many rows is sorted.
BORDER = 100_000
# Buckets of a histogram, and histograms per key.
BUCKETS, ROUNDS = 4096, 8

# Places of values that have no bucket, among those that have, ascending.
_NULL, _LOW, _FINITE, _HIGH, _NAN = range(5)


def _exact_keys(df: DataFrame, item: OrderItem) -> list[tuple[Column, Column]] | None:
    """(class, double) pairs whose order is the order of the item; None for a type that has none."""
    name, direction = (item, "asc") if isinstance(item, str) else item
    kind, x, low = df.schema[name].dataType, F.col(name), None
    if isinstance(kind, T.TimestampType):
        x, kind = F.unix_micros(x), T.LongType()
    if isinstance(kind, T.LongType):  # a double holds 53 bits, so a long goes by two halves
        low, x = x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("double"), F.shiftright(x, 32)
    elif isinstance(kind, T.DateType):
        x = F.unix_date(x)
    elif isinstance(kind, T.BooleanType):
        x = x.cast("int")
    elif not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType)):
        return None
    x = x.cast("double")
    infinite = F.lit(float("inf"))
    place = (
        F.when(x.isNull(), _NULL).when(F.isnan(x), _NAN).when(x == infinite, _HIGH).when(x == -infinite, _LOW).otherwise(_FINITE)
    )
    halves = [(place, x)] if low is None else [(place, x), (place, low)]
    return [(4 - p, -v) for p, v in halves] if direction == "desc" else halves


class _Border:
    """Rows that are in, rows that may be, and how many of the latter are wanted."""

    def __init__(self, df: DataFrame, n: int):
        self.df, self.wanted, self.size = df, n, None
        self.inside: list[Column] = []
        self.maybe: Column = F.lit(True)

    @property
    def done(self) -> bool:
        return self.size is not None and (self.size <= BORDER or self.size == self.wanted)

    def counts(self, by: Column, x: Column, finite: Column) -> list:
        known = F.when(finite, x)
        rows = self.df.where(self.maybe).groupBy(by.alias("place"))
        return rows.agg(F.count(F.lit(1)).alias("n"), F.min(known).alias("lo"), F.max(known).alias("hi")).orderBy("place").collect()

    def step(self, found: list):
        """The entry that holds the wanted row; those before it are counted off."""
        for entry in found:
            if entry["n"] >= self.wanted:
                self.size = entry["n"]
                return entry
            self.wanted -= entry["n"]
        return None

    def narrow(self, place: Column, x: Column) -> bool:
        """Narrow by one key until the border is small or all of it is equal; False if neither was reached."""
        finite = place.isin(_FINITE)
        entry = self.step(self.counts(place, x, finite))
        if entry is None:  # fewer rows than wanted: all of them are in
            self.inside, self.maybe, self.size, self.wanted = [F.lit(True)], F.lit(False), 0, 0
            return True
        self.inside.append(self.maybe & (place < entry["place"]))
        self.maybe = self.maybe & (place == entry["place"])
        if entry["place"] != _FINITE:
            return True
        for _ in range(ROUNDS):
            lo, hi = entry["lo"], entry["hi"]
            if self.done or lo == hi:
                return True
            if hi / 2 - lo / 2 == 0:
                return False
            share = (x / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)  # rounding never changes the order
            entry = self.step(self.counts(F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)), x, finite))
            self.inside.append(self.maybe & (x < entry["lo"]))
            self.maybe = self.maybe & (x >= entry["lo"]) & (x <= entry["hi"])
        return self.done or entry["lo"] == entry["hi"]


def first_rows(df: DataFrame, order: Sequence[OrderItem], n: int) -> DataFrame:
    """The first ``n`` rows of the total order ``order``, as a set; NULLs are first ascending and last descending.

    ``df`` is read once per histogram and once more, so it must give the same rows each time: materialise what
    is dear to compute. The driver gets at most ``BUCKETS`` counts at a time.
    """
    if n <= FEW:
        return df.orderBy(*sort_columns(order)).limit(max(n, 0))
    border = _Border(df, n)
    for item in order:
        keys = _exact_keys(df, item)
        if keys is None or not all(border.done or border.narrow(*key) for key in keys) or border.done:
            break
    rest = df.where(border.maybe)
    if border.size is None or border.wanted < border.size:
        if border.size is not None and border.size <= BORDER:
            rest = rest.orderBy(*sort_columns(order)).limit(border.wanted)
        else:
            rest = OrderedRows(rest, [], order).positions("__place").where(F.col("__place") <= border.wanted).drop("__place")
    return df.where(reduce(or_, border.inside)).unionByName(rest) if border.inside else rest
