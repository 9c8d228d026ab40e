"""Tail probabilities of the chi-square and t distributions for a handful of test results."""

from __future__ import annotations

import math

_TINY = 1e-300


def _fraction(step, limit: int = 500) -> float:
    """Value of a continued fraction from its (numerator, denominator) terms (Lentz)."""
    f = c = _TINY
    d = 0.0
    for i in range(limit):
        a, b = step(i)
        d = 1 / ((b + a * d) or _TINY)
        c = (b + a / c) or _TINY
        f *= c * d
        if i and abs(c * d - 1) < 1e-15:
            break
    return f


def chi_square_tail(x: float, dof: float) -> float:
    """P(X > x): the upper regularised incomplete gamma function at (dof/2, x/2)."""
    if dof <= 0:
        return 1.0
    a, z = dof / 2, x / 2
    if z <= 0:
        return 1.0
    scale = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= z / n
            total += term
        return 1 - total * scale
    return scale * _fraction(lambda i: (1.0, z + 1 - a) if i == 0 else (-i * (i - a), z + 2 * i + 1 - a))


def _beta_fraction(x: float, a: float, b: float) -> float:
    def step(i: int) -> tuple[float, float]:
        if i == 0:
            return 1.0, 1.0
        m, odd = divmod(i, 2)
        if odd:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    return _fraction(step)


def beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    scale = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return scale * _beta_fraction(x, a, b) / a
    return 1 - scale * _beta_fraction(1 - x, b, a) / b


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| > |t|)."""
    return beta_share(dof / (dof + t * t), dof / 2, 0.5)
