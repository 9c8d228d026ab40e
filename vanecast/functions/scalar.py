"""Row-local feature functions: built-in column expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: results of pow, log, mul and div are limited to this magnitude.
LIMIT = 1e7


def as_column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip(x: Column, low: float = -LIMIT, high: float = LIMIT) -> Column:
    """Limit to [low, high]; NULL stays NULL (``least`` alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def sine(x):
    return F.sin(as_column(x))


def cosine(x):
    return F.cos(as_column(x))


def square(x):
    x = as_column(x).cast("double")
    return clip(x * x)


def log(x):
    """ln|x|, limited; 0 gives the lower limit."""
    x = as_column(x).cast("double")
    return F.when(x == 0, F.lit(-LIMIT)).otherwise(clip(F.ln(F.abs(x))))


def sigmoid(x):
    return 1 / (1 + F.exp(-as_column(x)))


def relu(x):
    x = as_column(x)
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def tanh(x):
    return F.tanh(as_column(x))


def add(a, b):
    return as_column(a) + as_column(b)


def sub(a, b):
    return as_column(a) - as_column(b)


def mul(a, b):
    return clip(as_column(a).cast("double") * as_column(b).cast("double"))


def div(a, b):
    """a / b, limited; x/0 is the limit with the sign of x and 0/0 is NULL."""
    a, b = as_column(a).cast("double"), as_column(b).cast("double")
    by_zero = F.when(a != 0, F.signum(a) * LIMIT)
    return F.when(b == 0, by_zero).otherwise(clip(F.try_divide(a, b)))


def row_std(*xs):
    """Sample standard deviation across columns, NULLs skipped; fewer than two values give NULL."""
    cols = [as_column(x).cast("double") for x in xs]
    n = reduce(lambda s, c: s + c, [F.when(c.isNotNull(), 1).otherwise(0) for c in cols])
    mean = F.try_divide(reduce(lambda s, c: s + c, [F.coalesce(c, F.lit(0.0)) for c in cols]), n)
    squares = reduce(lambda s, c: s + c, [F.coalesce((c - mean) * (c - mean), F.lit(0.0)) for c in cols])
    return F.when(n > 1, F.sqrt(F.try_divide(squares, n - 1)))


def maximize(*xs):
    """Largest value across columns, NULLs skipped."""
    return F.greatest(*[as_column(x) for x in xs])
