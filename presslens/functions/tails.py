"""Tail probabilities for test statistics, applied to small aggregated tables."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, functions as F

_EPS = 1e-15
_TINY = 1e-300


def _gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma: series below a+1, continued fraction above."""
    if x <= 0:
        return 1.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * _EPS:
            k += 1
            term *= x / k
            total += term
        return max(0.0, 1.0 - total * scale)
    b = x + 1 - a
    c, d = 1 / _TINY, 1 / b
    h = d
    for i in range(1, 100_000):
        step = -i * (i - a)
        b += 2
        d = 1 / (step * d + b or _TINY)
        c = b + step / c or _TINY
        h *= d * c
        if abs(d * c - 1) < _EPS:
            break
    return h * scale


def _beta_fraction(a: float, b: float, x: float) -> float:
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or _TINY)
    h = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1 / (1 + step * d or _TINY)
            c = 1 + step / c or _TINY
            h *= d * c
        if abs(d * c - 1) < _EPS:
            break
    return h


def _beta_regularised(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi_square_upper(statistic: float, df: float) -> float:
    return _gamma_upper(df / 2, statistic / 2)


def student_two_sided(t: float, df: float) -> float:
    return _beta_regularised(df / 2, 0.5, df / (df + t * t))


def _each(fn, *series: pd.Series) -> pd.Series:
    return pd.Series(
        [None if any(pd.isna(v) for v in row) else fn(*row) for row in zip(*series)], dtype="float64"
    )


def normal_p_value(z: Column) -> Column:
    @F.pandas_udf("double")
    def p(zs: pd.Series) -> pd.Series:
        return _each(normal_two_sided, zs)

    return p(z.cast("double"))


def chi_square_p_value(statistic: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def p(xs: pd.Series, dfs: pd.Series) -> pd.Series:
        return _each(chi_square_upper, xs, dfs)

    return p(statistic.cast("double"), df.cast("double"))


def student_p_value(t: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def p(ts: pd.Series, dfs: pd.Series) -> pd.Series:
        return _each(student_two_sided, ts, dfs)

    return p(t.cast("double"), df.cast("double"))
