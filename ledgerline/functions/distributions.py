"""Distribution functions without scipy (p-values, power).

Textbook methods: the regularized incomplete beta by Lentz's continued fraction,
the regularized upper incomplete gamma by series / continued fraction, the normal
CDF from ``erfc`` and its inverse by Newton steps from a rational start.  They
serve single values on the driver (planning constants) and as a second opinion in the
tests; columns use ``tails``.
"""

from __future__ import annotations

import math

import numpy as np

_EPS = 3e-16
_TINY = 1e-300


def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularized incomplete beta ``I_x(a, b)``."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    ln_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    front = math.exp(ln_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def gammaincc(s: float, x: float) -> float:
    """Regularized upper incomplete gamma ``Q(s, x)``."""
    if x <= 0.0:
        return 1.0
    if x < s + 1.0:
        term = total = 1.0 / s
        ap = s
        for _ in range(100000):
            ap += 1.0
            term *= x / ap
            total += term
            if abs(term) < abs(total) * _EPS:
                break
        return 1.0 - total * math.exp(-x + s * math.log(x) - math.lgamma(s))
    b = x + 1.0 - s
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, 100000):
        an = -i * (i - s)
        b += 2.0
        d = an * d + b
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            break
    return math.exp(-x + s * math.log(x) - math.lgamma(s)) * h


def t_two_sided_p(t: float, df: float) -> float:
    """Two-sided p-value of Student's t with ``df`` degrees of freedom."""
    if t is None or df is None or not np.isfinite(t) or df <= 0:
        return float("nan")
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution."""
    if f is None or not np.isfinite(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_sf(x: float, k: float) -> float:
    """Upper tail of the chi-square distribution with ``k`` degrees of freedom."""
    if x is None or not np.isfinite(x) or k <= 0:
        return float("nan")
    return gammaincc(k / 2.0, x / 2.0)


def norm_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    """Inverse normal CDF: a logistic-style start refined by Newton steps."""
    if not 0.0 < p < 1.0:
        return float("nan") if p not in (0.0, 1.0) else (-math.inf if p == 0.0 else math.inf)
    z = math.sqrt(-2.0 * math.log(min(p, 1.0 - p)))
    z = z - (2.515517 + 0.802853 * z + 0.010328 * z * z) / (1.0 + 1.432788 * z + 0.189269 * z * z + 0.001308 * z**3)
    z = z if p > 0.5 else -z
    for _ in range(50):
        err = norm_cdf(z) - p
        step = err / (math.exp(-0.5 * z * z) / math.sqrt(2.0 * math.pi))
        z -= step
        if abs(step) < 1e-15:
            break
    return z
