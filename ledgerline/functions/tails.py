"""Tail probabilities as native columns: incomplete beta and gamma by folds of fixed length.

Continued fractions and series are evaluated from their far end, so a fold carries one
number and every row takes the same steps (``F.aggregate``, no Python).  ``BETA_TERMS``
serve first parameters up to ``LARGE``; beyond, the incomplete beta passes over into the
incomplete gamma, with a relative error of the order ``1 / a^2``.
NULL and NaN arguments give NULL.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BETA_TERMS, GAMMA_TERMS = 800, 500
LARGE = 1e5
_HALF_LN_2PI = 0.5 * math.log(2 * math.pi)


def _let(values: dict[str, Column], body: Callable[..., Column]) -> Column:
    """``body`` of the named values, each computed once (a fold over one struct), so expressions stay small."""
    bound = F.array(F.struct(*[v.cast("double").alias(k) for k, v in values.items()]))
    return F.element_at(F.transform(bound, lambda s: body(**{k: s[k] for k in values})), 1)


def _steps(n: int) -> Column:
    return F.sequence(F.lit(n), F.lit(1), F.lit(-1))


def _stirling_rest(x: Column) -> Column:
    """ln Gamma(x) less its leading terms, for x >= 8."""
    r = 1 / (x * x)
    return (1 / 12.0 - r * (1 / 360.0 - r * (1 / 1260.0 - r * (1 / 1680.0 - r * (1 / 1188.0 - r * (691 / 360360.0)))))) / x


def ln_gamma(x: Column) -> Column:
    """ln Gamma(x) for x > 0: Stirling's series at x + 8, led back by the recurrence."""
    y = x + 8
    product = x
    for i in range(1, 8):
        product = product * (x + i)
    return (y - 0.5) * F.log(y) - y + _HALF_LN_2PI + _stirling_rest(y) - F.log(product)


def ln_beta(a: Column, b: Column) -> Column:
    """ln B(a, b); the difference of two large ln Gamma is taken in closed form, so that it keeps its digits."""
    big, small = F.greatest(a, b), F.least(a, b)
    apart = (big - 0.5) * F.log1p(small / big) + small * (F.log(big + small) - 1) + _stirling_rest(big + small) - _stirling_rest(big)
    return ln_gamma(small) - F.when(big >= 8, apart).otherwise(ln_gamma(big + small) - ln_gamma(big))


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta, 1 / (1 + d1 / (1 + d2 / ...)), from d_2N down to d_1."""

    def step(acc: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1))
        return 1 + odd / (1 + even / acc)

    return 1 / F.aggregate(_steps(BETA_TERMS), F.lit(1.0), step)


def beta_tail(a: Column, b: Column, x: Column, y: Column) -> Column:
    """The regularized incomplete beta I_x(a, b); ``y = 1 - x`` comes separately, so that neither loses digits."""

    def tail(a: Column, b: Column, x: Column, y: Column) -> Column:
        direct = x < (a + 1) / (a + b + 2)
        turned = {"p": F.when(direct, a).otherwise(b), "q": F.when(direct, b).otherwise(a), "u": F.when(direct, x).otherwise(y), "v": F.when(direct, y).otherwise(x)}
        part = _let(turned, lambda p, q, u, v: F.exp(p * F.log(u) + q * F.log(v) - ln_beta(p, q)) * _beta_fraction(p, q, u) / p)
        whole = _let({"part": part, "turn": F.when(direct, 0.0).otherwise(1.0)}, lambda part, turn: F.when(turn == 0, part).otherwise(1 - part))
        far = gamma_tail(b, -(a + (b - 1) / 2) * F.log1p(-y))
        return F.when(x <= 0, 0.0).when(y <= 0, 1.0).when((a > LARGE) & (b < math.sqrt(LARGE)), far).otherwise(whole)

    return _let({"a": a, "b": b, "x": x, "y": y}, tail)


def gamma_tail(s: Column, x: Column) -> Column:
    """The regularized upper incomplete gamma Q(s, x): series below s + 1, continued fraction above."""

    def tail(s: Column, x: Column) -> Column:
        front = F.exp(s * F.log(x) - x - ln_gamma(s))
        series = F.aggregate(_steps(GAMMA_TERMS), F.lit(1.0), lambda acc, n: 1 + x / (s + n) * acc) / s
        fraction = F.aggregate(_steps(GAMMA_TERMS), x + (2 * GAMMA_TERMS + 1) - s, lambda acc, i: x + (2 * i - 1) - s - i * (i - s) / acc)
        return F.when(x <= 0, 1.0).when(x < s + 1, 1 - front * series).otherwise(front / fraction)

    return _let({"s": s, "x": x}, tail)


def _defined(value: Column, *args: Column) -> Column:
    known = F.lit(True)
    for a in args:
        known = known & a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf"))
    return F.when(known, value)


def _double(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def t_p_value(t: str | Column, df: str | Column) -> Column:
    """Two-sided p-value of Student's t."""
    t, df = _double(t), _double(df)
    whole = df + t * t
    return _defined(F.when(df > 0, beta_tail(df / 2, F.lit(0.5), df / whole, t * t / whole)), t, df)


def f_p_value(f: str | Column, d1: str | Column, d2: str | Column) -> Column:
    """Upper tail of the F distribution."""
    f, d1, d2 = _double(f), _double(d1), _double(d2)
    whole = d2 + d1 * f
    tail = F.when(f <= 0, 1.0).otherwise(beta_tail(d2 / 2, d1 / 2, d2 / whole, d1 * f / whole))
    return _defined(F.when((d1 > 0) & (d2 > 0), tail), f, d1, d2)


def chi2_p_value(x: str | Column, k: str | Column) -> Column:
    """Upper tail of the chi-square distribution."""
    x, k = _double(x), _double(k)
    return _defined(F.when(k > 0, gamma_tail(k / 2, x / 2)), x, k)


def normal_cdf(z: str | Column) -> Column:
    z = _double(z)
    both = _let({"z": z, "tail": gamma_tail(F.lit(0.5), z * z / 2) / 2}, lambda z, tail: F.when(z < 0, tail).otherwise(1 - tail))
    return _defined(both, z)
