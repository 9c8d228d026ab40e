"""Ordered computations that never hand a whole hot group to one task.

A plain ``Window.partitionBy(group).orderBy(time)`` puts every row of a group
into one task. ``OrderedRows`` counts the groups first: as long as each fits a
task, the plain window is used. Otherwise the rows are range-partitioned on
(group, order) - balanced whatever the skew, since the order is total - and
written once with their partition and place. Running values are then computed
per (group, partition) and shifted by per-partition totals, of which there are
at most two per partition; sliding frames are computed on fixed-size blocks of
consecutive rows, each with a copy of the few rows before it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Literal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanecast.operators.joins import null_safe_join
from vanecast.session import group_rows, materialize

_ID, _CHUNK, _POS, _BLOCK, _MAIN = "__vc_id", "__vc_chunk", "__vc_pos", "__vc_block", "__vc_main"
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits

_LOT = "__vc_lot"
# More partitions than this are carried over in lots of so many.
LOT = 1024

OrderItem = str | tuple[str, str]
Carry = Literal["sum", "last", "next"]


def _beyond(kind: Carry, x: Column, over: WindowSpec, own: bool = False) -> Column:
    """What the rows before (after, for "next") hand to a row; ``own`` counts the row itself."""
    if kind == "next":
        return F.first(x, ignorenulls=True).over(over.rowsBetween(0 if own else 1, Window.unboundedFollowing))
    frame = over.rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    return (F.sum(x) if kind == "sum" else F.last(x, ignorenulls=True)).over(frame)


def _whole(kind: Carry, x: Column) -> Column:
    """What a lot of partitions hands on."""
    if kind == "sum":
        return F.sum(x)
    return (F.max_by if kind == "last" else F.min_by)(x, F.when(x.isNotNull(), F.col(_CHUNK)))


def sort_columns(order: Sequence[OrderItem]) -> list[Column]:
    """``"t"`` or ``("t", "desc")`` to sort expressions; NULLs first ascending, last descending."""
    out = []
    for item in order:
        name, direction = (item, "asc") if isinstance(item, str) else item
        out.append(F.col(name).desc() if direction == "desc" else F.col(name).asc())
    return out


class OrderedRows:
    """Rows of a DataFrame in a total order inside each group.

    ``order`` must be unique within a group. ``max_rows`` is the largest group
    one task may hold; the default comes from the session. ``sizes`` is (rows
    of the largest group, rows in all) where the caller knows them already.
    """

    def __init__(
        self,
        df: DataFrame,
        group: Sequence[str],
        order: Sequence[OrderItem],
        max_rows: int | None = None,
        sizes: tuple[int, int] | None = None,
    ):
        self.group = list(group)
        self.order = list(order)
        self.max_rows = group_rows(df.sparkSession) if max_rows is None else max_rows
        self.columns = df.columns
        if sizes is None:
            counts = df.groupBy(*self.group).count() if self.group else df.groupBy().count()
            sizes = tuple(counts.agg(F.max("count"), F.sum("count")).first())
        largest, total = sizes[0] or 0, sizes[1] or 0
        self.split = largest > self.max_rows
        self.chunks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // self.max_rows))
        self.df = self._place(df) if self.split else df
        self._spanning = self._groups_in_several_chunks() if self.split else None

    # -- layout -----------------------------------------------------------------

    def _place(self, df: DataFrame) -> DataFrame:
        keys = [F.col(g).asc() for g in self.group] + sort_columns(self.order)
        placed = (
            df.repartitionByRange(self.chunks, *keys)
            .sortWithinPartitions(*keys)
            .withColumn(_ID, F.monotonically_increasing_id())
            .withColumn(_CHUNK, F.shiftright(F.col(_ID), _ROW_BITS))
        )
        return materialize(placed, "ordered")

    def _groups_in_several_chunks(self) -> DataFrame | None:
        """Groups cut by a partition border: at most one per border."""
        if not self.group:
            return None
        key = F.struct(*self.group)
        edges = self.df.groupBy(_CHUNK).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
        begins = edges.select("lo", F.col(_CHUNK).alias("c1"))
        ends = edges.select(F.col("hi").alias("key"), F.col(_CHUNK).alias("c2"))
        cut = F.col("lo").eqNullSafe(F.col("key")) & (F.col("c1") != F.col("c2"))
        return begins.join(F.broadcast(ends), cut, "left_semi").select("lo.*").distinct()

    def _per_chunk(self, aggs: list[Column]) -> DataFrame:
        rows = self.df
        if self.group:
            rows = null_safe_join(rows, F.broadcast(self._spanning), self.group, "left_semi")
        return rows.groupBy(*self.group, _CHUNK).agg(*aggs)

    def _carried(self, totals: DataFrame, carries: Mapping[str, Carry]) -> DataFrame:
        """Column ``__o_{n}`` per (group, partition): ``__t_{n}`` of all partitions before (after, for "next") it.

        Many partitions are combined in lots: inside each lot, and over the lots.
        """
        if self.chunks <= LOT:
            over = Window.partitionBy(*self.group).orderBy(_CHUNK)
            return totals.select("*", *[_beyond(kind, F.col(f"__t_{n}"), over).alias(f"__o_{n}") for n, kind in carries.items()])
        lots = totals.withColumn(_LOT, F.floor(F.col(_CHUNK) / LOT))
        inner = Window.partitionBy(*self.group, _LOT).orderBy(_CHUNK)
        outer = Window.partitionBy(*self.group).orderBy(_LOT)
        near = lots.select("*", *[_beyond(kind, F.col(f"__t_{n}"), inner).alias(f"__i_{n}") for n, kind in carries.items()])
        whole = lots.groupBy(*self.group, _LOT).agg(*[_whole(kind, F.col(f"__t_{n}")).alias(f"__w_{n}") for n, kind in carries.items()])
        # one row per lot and group: a thousandth of the partitions and at most two per partition border
        far = whole.select(*self.group, _LOT, *[_beyond(kind, F.col(f"__w_{n}"), outer).alias(f"__f_{n}") for n, kind in carries.items()])
        both = null_safe_join(near, F.broadcast(far), [*self.group, _LOT], "left")
        joined = {}
        for n, kind in carries.items():
            i, f = F.col(f"__i_{n}"), F.col(f"__f_{n}")
            joined[f"__o_{n}"] = F.coalesce(i + f, i, f) if kind == "sum" else F.coalesce(i, f)
        return both.withColumns(joined).drop(_LOT, *[f"__{p}_{n}" for p in "if" for n in carries])

    def _attach(self, df: DataFrame, carry: DataFrame) -> DataFrame:
        return null_safe_join(df, F.broadcast(carry), [*self.group, _CHUNK], "left")

    def window(self) -> WindowSpec:
        """Window over the rows one task holds: the group, or its part of a partition."""
        if self.split:
            return Window.partitionBy(*self.group, _CHUNK).orderBy(_ID)
        return Window.partitionBy(*self.group).orderBy(*sort_columns(self.order))

    def _clean(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        keep = [c for c in self.columns if c not in names]
        return df.select(*keep, *names)

    # -- running values -----------------------------------------------------------

    def running_sum(self, sums: Mapping[str, Column]) -> DataFrame:
        """Inclusive running sums in order (NULL counts as 0)."""
        return self._clean(self._running(sums), list(sums))

    def _running(self, sums: Mapping[str, Column]) -> DataFrame:
        safe = {n: F.coalesce(e, F.lit(0)) for n, e in sums.items()}
        w = self.window().rowsBetween(Window.unboundedPreceding, 0)
        out = self.df.select("*", *[F.sum(e).over(w).alias(n) for n, e in safe.items()])
        if not self.split:
            return out
        totals = self._per_chunk([F.sum(e).alias(f"__t_{n}") for n, e in safe.items()])
        carry = self._carried(totals, {n: "sum" for n in safe})
        out = self._attach(out, carry.select(*self.group, _CHUNK, *[f"__o_{n}" for n in safe]))
        for n in safe:
            out = out.withColumn(n, F.col(n) + F.coalesce(F.col(f"__o_{n}"), F.lit(0)))
        return out.drop(*[f"__o_{n}" for n in safe])

    def positions(self, name: str = "pos") -> DataFrame:
        """1-based place of every row in its group."""
        if self.split and not self.group:
            return self._clean(self._places().withColumnRenamed(_POS, name), [name])
        return self.running_sum({name: F.lit(1).cast("long")})

    def _places(self) -> DataFrame:
        """1-based place of the rows of groups cut by a partition border, NULL for other groups.

        Rows of a group are consecutive inside a partition, so their place
        follows from the row number given when they were written.
        """
        sizes = self._per_chunk([F.count(F.lit(1)).alias("__t_n"), F.min(_ID).alias("__first")])
        carry = self._carried(sizes, {"n": "sum"})
        carry = carry.select(*self.group, _CHUNK, "__first", F.coalesce(F.col("__o_n"), F.lit(0)).alias("__before"))
        place = F.col(_ID) - F.col("__first") + F.col("__before") + 1
        return self._attach(self.df, carry).withColumn(_POS, place).drop("__first", "__before")

    def fill_forward(self, values: Mapping[str, Column]) -> DataFrame:
        """Last non-NULL value up to and including each row."""
        return self.fill({n: ("last", e, True) for n, e in values.items()})

    def fill_backward(self, values: Mapping[str, Column]) -> DataFrame:
        """First non-NULL value from each row on."""
        return self.fill({n: ("next", e, True) for n, e in values.items()})

    def fill(self, values: Mapping[str, tuple[Carry, Column, bool]]) -> DataFrame:
        """Nearest non-NULL values: (``"last"`` or ``"next"``, the value, whether the row's own counts)."""
        here = {n: _beyond(kind, e, self.window(), own) for n, (kind, e, own) in values.items()}
        out = self.df.select("*", *[c.alias(n) for n, c in here.items()])
        if self.split:
            ends = self._per_chunk([
                (F.max_by if kind == "last" else F.min_by)(e, F.when(e.isNotNull(), F.col(_ID))).alias(f"__t_{n}")
                for n, (kind, e, _) in values.items()
            ])
            carry = self._carried(ends, {n: kind for n, (kind, _, _) in values.items()})
            out = self._attach(out, carry.select(*self.group, _CHUNK, *[f"__o_{n}" for n in values]))
            for n in values:
                out = out.withColumn(n, F.coalesce(F.col(n), F.col(f"__o_{n}")))
            out = out.drop(*[f"__o_{n}" for n in values])
        return self._clean(out, list(values))

    # -- sliding frames -----------------------------------------------------------

    def rolling(self, reach: int, build: Callable[[WindowSpec], Mapping[str, Column]]) -> DataFrame:
        """Columns over frames that look back at most ``reach`` rows.

        ``build`` receives the ordered window and returns named columns over
        frames such as ``w.rowsBetween(-(n - 1), 0)`` or ``F.lag(x, n).over(w)``.
        """
        if not self.split:
            columns = build(self.window())
            out = self.df.select("*", *[c.alias(n) for n, c in columns.items()])
            return self._clean(out, list(columns))
        return self._blocks(self._places(), _ID, max(self.max_rows, reach), reach, lambda w, _: build(w))

    def rolling_fields(self, build: Callable[[WindowSpec], Mapping[str, Column]]) -> list[T.StructField]:
        """Names and types of the columns that ``rolling`` would add."""
        return list(self.df.select(*[c.alias(n) for n, c in build(self.window()).items()]).schema.fields)

    def in_tables(
        self, size: int, reach: int, inputs: Sequence[str], names: Sequence[str], compute: Callable[[list[np.ndarray]], list[np.ndarray]]
    ) -> DataFrame:
        """Adds double columns ``names``, computed on blocks of ``size`` rows preceded by copies of ``reach`` rows.

        ``compute`` gets the input columns of a block in order, as doubles with
        NaN for NULL, and returns one array per name; what is not finite
        becomes NULL. A block never grows with its group.
        """
        typed = {f"__in_{i}": F.col(c).cast("double") for i, c in enumerate(inputs)}
        held = list(typed)

        def run(part: pa.Table) -> list[pa.Array]:
            columns = [part.column(c).to_numpy().astype(float) for c in held]
            return [pa.array(values, mask=~np.isfinite(values)) for values in compute(columns)]

        return self.in_arrow(size, reach, typed, [T.StructField(n, T.DoubleType()) for n in names], run)

    def in_arrow(
        self, size: int, reach: int, inputs: Mapping[str, Column], fields: Sequence[T.StructField], compute: Callable[[pa.Table], list[pa.Array]]
    ) -> DataFrame:
        """Adds columns ``fields``, computed as ``in_tables`` does; ``compute`` gets a block in order with the columns ``inputs``."""
        if size < reach:
            raise ValueError("a block must be at least as long as the look-back")
        names = [f.name for f in fields]
        placed = self._running({_POS: F.lit(1).cast("long")})
        home = F.floor((F.col(_POS) - 1) / size).cast("long")
        copies = F.when((F.col(_POS) - 1) % size >= size - reach, F.array(home, home + 1)).otherwise(F.array(home))
        rows = placed.select("*", F.explode(copies).alias(_BLOCK)).withColumn(_MAIN, F.col(_BLOCK) == home)
        keep = [c for c in self.columns if c not in names]
        rows = rows.select(*keep, _BLOCK, _MAIN, _POS, *[c.alias(n) for n, c in inputs.items()])
        schema = T.StructType([rows.schema[c] for c in keep] + list(fields))

        def run(part: pa.Table) -> pa.Table:
            part = part.take(pc.sort_indices(part, sort_keys=[(_POS, "ascending")]))
            out = part.select(keep)
            for name, values in zip(names, compute(part), strict=True):
                out = out.append_column(name, values)
            return out.filter(part.column(_MAIN))

        return rows.groupBy(*self.group, _BLOCK).applyInArrow(run, schema).select(*keep, *names)

    def _blocks(
        self,
        placed: DataFrame,
        order: str,
        size: int,
        reach: int,
        build: Callable[[WindowSpec, Column], Mapping[str, Column]],
    ) -> DataFrame:
        """Blocks by place; a group without places is one block."""
        place = F.col(_POS) - 1
        home = F.coalesce(F.floor(place / size).cast("long"), F.lit(0).cast("long"))
        copies = F.when(place % size >= size - reach, F.array(home, home + 1)).otherwise(F.array(home))
        blocks = placed.select("*", F.explode(copies).alias(_BLOCK)).withColumn(_MAIN, F.col(_BLOCK) == home)
        columns = build(Window.partitionBy(*self.group, _BLOCK).orderBy(order), place)
        out = blocks.select("*", *[c.alias(n) for n, c in columns.items()]).where(_MAIN)
        return self._clean(out, list(columns))


def first_rows_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[OrderItem], wanted: Column, max_rows: int | None = None
) -> DataFrame:
    """The first ``wanted`` rows of each group in the given total order."""
    placed = OrderedRows(df, group, order, max_rows).positions("__place")
    return placed.where(F.col("__place") <= wanted).drop("__place")
