"""Rolling and exponentially weighted features over ordered rows.

Frames are the current row and the ``n - 1`` rows before it. A value is NULL
until the frame holds ``n`` non-NULL inputs.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from vanecast.operators.ordered import OrderedRows, OrderItem
from vanecast.session import group_rows


@dataclass(frozen=True)
class Rolling:
    """One rolling feature: operator name, input column(s) and number of rows."""

    op: str
    x: str
    n: int
    y: str | None = None


@dataclass(frozen=True)
class Ewm:
    """One exponentially weighted feature; ``stat`` is mean, std, cov or corr."""

    stat: str
    x: str
    span: float
    y: str | None = None


def _frame(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def _full(value: Column, seen: Column, w: WindowSpec, n: int) -> Column:
    return F.when(F.count(seen).over(_frame(w, n)) == n, value)


def _simple(aggregate):
    def build(w: WindowSpec, x: Column, y: Column, n: int) -> Column:
        return _full(aggregate(x).over(_frame(w, n)), x, w, n)

    return build


def _pair(x: Column, y: Column) -> tuple[Column, Column]:
    both = x.isNotNull() & y.isNotNull()
    return F.when(both, x), F.when(both, y)


def _cov(w: WindowSpec, x: Column, y: Column, n: int) -> Column:
    x, y = _pair(x, y)
    return _full(F.covar_samp(x, y).over(_frame(w, n)), x, w, n)


def _corr(w: WindowSpec, x: Column, y: Column, n: int) -> Column:
    x, y = _pair(x, y)
    f = _frame(w, n)
    ratio = F.try_divide(F.covar_samp(x, y).over(f), F.stddev_samp(x).over(f) * F.stddev_samp(y).over(f))
    return _full(ratio, x, w, n)


def _rank(w: WindowSpec, x: Column, y: Column, n: int) -> Column:
    """Average rank of the current value; the frame list is bounded by ``n``."""
    frame = F.collect_list(x).over(_frame(w, n))
    below = F.size(F.filter(frame, lambda v: v < x))
    equal = F.size(F.filter(frame, lambda v: v == x))
    return _full(below + (equal + 1) / 2, x, w, n)


ROLLING_OPS = {
    "diff": lambda w, x, y, n: x - F.lag(x, n).over(w),
    "delay": lambda w, x, y, n: F.lag(x, n).over(w),
    "ts_mean": _simple(F.avg),
    "ts_std": _simple(F.stddev_samp),
    "ts_max": _simple(F.max),
    "ts_min": _simple(F.min),
    "ts_cov": _cov,
    "ts_corr": _corr,
    "ts_rank": _rank,
}


# -- the same on a block in one task: frames are shifted arrays, taken from the oldest row on as Spark does

Block = tuple[np.ndarray, np.ndarray]  # values and where they are known
BLOCK_TYPES = ("double", "bigint", "int")


def _back(block: Block, n: int) -> Block:
    """The values ``n`` rows earlier."""
    (x, known), n = block, min(n, len(block[0]))
    return np.concatenate([np.zeros(n, x.dtype), x[: len(x) - n]]), np.concatenate([np.zeros(n, bool), known[: len(x) - n]])


def _frames(block: Block, n: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The values of each frame from the oldest on, and where all of them are known."""
    shifted = [_back(block, j) for j in range(n - 1, -1, -1)]
    return [x for x, _ in shifted], np.logical_and.reduce([known for _, known in shifted])


def _block_mean(x: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(len(x[0]))
    for v in x:
        total = total + v
    return total / len(x)


def _block_moments(x: list[np.ndarray], y: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of squared deviations of x and of products of deviations, row by row as Spark's aggregates add them."""
    mean_x, mean_y, m2, ck = (np.zeros(len(x[0])) for _ in range(4))
    for i, (u, v) in enumerate(zip(x, y, strict=True), 1):
        dx, dy = u - mean_x, v - mean_y
        m2 = m2 + dx * (dx - dx / i)
        mean_x, mean_y = mean_x + dx / i, mean_y + dy / i
        ck = ck + dx * (v - mean_y)
    return m2, ck


def _block_std(x: list[np.ndarray]) -> np.ndarray:
    return np.sqrt(_block_moments(x, x)[0] / (len(x) - 1))


def _block_rank(x: list[np.ndarray]) -> np.ndarray:
    own = x[-1]
    nan = np.isnan(own)  # larger than any number
    below = sum((v < own) | (nan & ~np.isnan(v)) for v in (u.astype(own.dtype) for u in x))
    equal = sum(((v == own) | (nan & np.isnan(v))).astype(np.int64) for v in x)
    return below + (equal + 1) / 2


def _block_value(spec: Rolling, x: Block, y: Block) -> tuple[np.ndarray, np.ndarray]:
    """One rolling feature on the rows of a block and where it is known."""
    n = spec.n
    if spec.op in ("diff", "delay"):
        past, known = _back(x, n)
        if spec.op == "delay":
            return past, known
        known = known & x[1]
        # zeros where a side is unknown, so that only real differences may overflow
        return pc.subtract_checked(pa.array(np.where(known, x[0], 0)), pa.array(np.where(known, past, 0))).to_numpy(), known
    if spec.op in ("ts_cov", "ts_corr"):
        both = x[1] & y[1]
        (u, known), (v, _) = _frames((x[0].astype(float), both), n), _frames((y[0].astype(float), both), n)
        if n == 1:
            return np.zeros(len(known)), np.zeros(len(known), bool)
        cov = _block_moments(u, v)[1] / (n - 1)
        if spec.op == "ts_cov":
            return cov, known
        scale = _block_std(u) * _block_std(v)
        return np.divide(cov, scale, out=np.zeros(len(cov)), where=scale != 0), known & (scale != 0)
    u, known = _frames(x, n)
    if spec.op == "ts_std":
        return (_block_std([v.astype(float) for v in u]), known) if n > 1 else (np.zeros(len(known)), np.zeros(len(known), bool))
    values = {"ts_mean": _block_mean, "ts_max": np.maximum.reduce, "ts_min": np.fmin.reduce, "ts_rank": _block_rank}
    return values[spec.op](u), known


def _rolling_tables(rows: OrderedRows, reach: int, specs: Mapping[str, Rolling]) -> DataFrame:
    """``rolling_features`` of groups that are cut into blocks: dozens of frames are some array operations in one pass."""
    inputs = sorted({c for s in specs.values() for c in (s.x, s.y or s.x)})
    fields = rows.rolling_fields(lambda w: {name: rolling_column(s, w) for name, s in specs.items()})
    kinds = {f.name: {"double": pa.float64(), "bigint": pa.int64(), "int": pa.int32()}[f.dataType.simpleString()] for f in fields}

    def compute(part: pa.Table) -> list[pa.Array]:
        blocks = {}
        for i, c in enumerate(inputs):
            column = part.column(f"__in_{i}")
            blocks[c] = column.fill_null(0).to_numpy(), column.is_valid().to_numpy()
        out = []
        with np.errstate(all="ignore"):
            for name, s in specs.items():
                values, known = _block_value(s, blocks[s.x], blocks[s.y or s.x])
                out.append(pa.array(values, kinds[name], mask=~known))
        return out

    return rows.in_arrow(max(BLOCK_ROWS, reach), reach, {f"__in_{i}": F.col(c) for i, c in enumerate(inputs)}, fields, compute)


def rolling_column(spec: Rolling, w: WindowSpec) -> Column:
    x = F.col(spec.x)
    y = F.col(spec.y) if spec.y else x
    return ROLLING_OPS[spec.op](w, x, y, spec.n)


def rolling_features(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[OrderItem],
    specs: Mapping[str, Rolling],
    max_rows: int | None = None,
    sizes: tuple[int, int] | None = None,
) -> DataFrame:
    """All rolling features in one select over one sort; ``sizes`` as in ``OrderedRows``."""
    reach = max(spec.n for spec in specs.values())
    rows = OrderedRows(df, group, order, _window_rows(df, max_rows), sizes)
    kinds = dict(df.dtypes)
    if rows.split and all(kinds.get(c) in BLOCK_TYPES for s in specs.values() for c in (s.x, s.y or s.x)):
        return _rolling_tables(rows, reach, specs)
    return rows.rolling(reach, lambda w: {name: rolling_column(s, w) for name, s in specs.items()})


def row_lead(
    df: DataFrame, group: Sequence[str], order: Sequence[OrderItem], target: str, rows: int, name: str = "label"
) -> DataFrame:
    """Label taken ``rows`` rows later: a look-back over the reversed order."""
    reverse = [(o, "desc") if isinstance(o, str) else (o[0], "asc" if o[1] == "desc" else "desc") for o in order]
    ordered = OrderedRows(df, group, reverse)
    return ordered.rolling(rows, lambda w: {name: F.lag(target, rows).over(w)})


# -- exponentially weighted ------------------------------------------------------


# A row whose weight has fallen below this share of the newest no longer counts. Even a level
# 1e15 noise widths away then adds less than 1e-9 to a variance.
LEAST_WEIGHT = 1e-40
# Rows of a block, so that short spans do not make many small tasks.
BLOCK_ROWS = 50_000
# A longer group is cut into blocks: dozens of frames per row are too slow for one task long before its rows are too many.
WINDOW_ROWS = 100_000


def _window_rows(df: DataFrame, max_rows: int | None) -> int:
    return min(group_rows(df.sparkSession), WINDOW_ROWS) if max_rows is None else max_rows


def _reach(alpha: float) -> int:
    """Rows after which a weight has fallen below ``LEAST_WEIGHT`` of the newest."""
    if alpha >= 1:
        return 1
    return math.ceil(math.log(LEAST_WEIGHT) / math.log1p(-alpha))


def _ewm_values(spec: Ewm, alpha: float, x: pd.Series, y: pd.Series) -> np.ndarray:
    """The statistic at rows where all inputs are known, else NaN.

    pandas carries weight, mean and squared deviations from row to row, so a
    change of level costs no digits and no weight grows.
    """
    frame = x.ewm(alpha=alpha, adjust=True, ignore_na=False)
    if spec.stat == "mean":
        out = x.where(y.notna()).ewm(alpha=alpha, adjust=True, ignore_na=False).mean()
    elif spec.stat == "std":
        out = frame.std(bias=False)
    elif spec.stat == "cov":
        out = frame.cov(y, bias=False)
    else:
        out = frame.corr(y)
    return out.where(x.notna() & y.notna()).to_numpy()


def ewm_features(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[OrderItem],
    specs: Mapping[str, Ewm],
    max_rows: int | None = None,
    sizes: tuple[int, int] | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Exponentially weighted statistics; a row with a NULL input repeats the last value.

    Weights count rows, so a NULL keeps its place. All spans are one pass over
    blocks that are preceded by the rows that still have weight. ``sizes`` as in
    ``OrderedRows``; ``source`` has the same rows as ``df`` where that is a longer way.
    """
    alphas = {name: min(2 / (spec.span + 1), 1.0) for name, spec in specs.items()}
    reach = max(_reach(a) for a in alphas.values())
    inputs = sorted({c for spec in specs.values() for c in (spec.x, spec.y or spec.x)})

    def compute(columns: list[np.ndarray]) -> list[np.ndarray]:
        series = dict(zip(inputs, map(pd.Series, columns), strict=True))
        return [_ewm_values(s, alphas[n], series[s.x], series[s.y or s.x]) for n, s in specs.items()]

    max_rows = _window_rows(df, max_rows)
    rows = OrderedRows(df, group, order, max_rows, sizes)
    out = rows.in_tables(max(BLOCK_ROWS, 4 * reach), reach, inputs, list(specs), compute)
    gaps = F.lit(False)
    for spec in specs.values():
        gaps = gaps | F.col(spec.x).isNull()
        if spec.y:
            gaps = gaps | F.col(spec.y).isNull()
    read = source if source is not None and set(inputs) <= set(source.columns) else df
    if not read.select(F.max(gaps.cast("int"))).first()[0]:
        return out
    names = list(specs)
    filled = OrderedRows(out.withColumnsRenamed({n: f"__e_{n}" for n in names}), group, order, max_rows, sizes)
    return filled.fill_forward({n: F.col(f"__e_{n}") for n in names}).drop(*[f"__e_{n}" for n in names])
