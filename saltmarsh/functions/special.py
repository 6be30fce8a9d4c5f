"""Tail probabilities for the few result rows of a test (no SciPy here)."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F

_TINY = 1e-300


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated from the front."""
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, 200_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > _TINY else _TINY)
            c = 1.0 + num / c
            c = c if abs(c) > _TINY else _TINY
            h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return h


def beta_cdf(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def chi2_sf(x: float, dof: float) -> float:
    """Upper tail of the chi-square distribution."""
    a, z = dof / 2.0, x / 2.0
    if z <= 0:
        return 1.0
    front = math.exp(a * math.log(z) - z - math.lgamma(a))
    if z < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= z / n
            total += term
        return 1.0 - front * total
    b = z + 1.0 - a
    c, d = 1.0 / _TINY, 1.0 / b
    h = d
    for i in range(1, 100_000):
        num = -i * (i - a)
        b += 2.0
        d = 1.0 / (num * d + b)
        c = b + num / c
        h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * h


def t_two_sided(t: float, dof: float) -> float:
    return beta_cdf(dof / 2.0, 0.5, dof / (dof + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    return beta_cdf(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def binomial_quantile(q: float, n: int, p: float) -> int:
    """Smallest k with P(X <= k) >= q, found by halving."""
    if p <= 0.0 or n == 0:
        return 0
    if p >= 1.0:
        return n
    lo, hi = 0, n
    while lo < hi:
        k = (lo + hi) // 2
        below = 1.0 if k >= n else beta_cdf(n - k, k + 1, 1.0 - p)
        lo, hi = (lo, k) if below >= q - 1e-13 else (k + 1, hi)
    return lo


def p_value_udf():
    """``p(kind, statistic, d1, d2)`` for kinds chi2, t, f and z."""

    @F.pandas_udf("double")
    def p(kind: pd.Series, x: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
        calls = {
            "chi2": lambda v, a, b: chi2_sf(v, a), "t": lambda v, a, b: t_two_sided(v, a),
            "f": lambda v, a, b: f_sf(v, a, b), "z": lambda v, a, b: normal_two_sided(v),
        }
        return pd.Series([
            None if pd.isna(v) else calls[k](float(v), float(a) if not pd.isna(a) else 0.0, float(b) if not pd.isna(b) else 0.0)
            for k, v, a, b in zip(kind, x, d1, d2)
        ])

    return p


def binomial_interval_udf():
    """Binomial quantile interval ``(n, p, level) -> (low, high)`` as shares of n."""

    @F.pandas_udf("low double, high double")
    def interval(n: pd.Series, p: pd.Series, level: pd.Series) -> pd.DataFrame:
        rows = [
            (binomial_quantile((1 - lv) / 2, int(k), float(r)) / k, binomial_quantile(1 - (1 - lv) / 2, int(k), float(r)) / k)
            for k, r, lv in zip(n, p, level)
        ]
        return pd.DataFrame(rows, columns=["low", "high"])

    return interval
