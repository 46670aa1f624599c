"""Tail probabilities of the usual test statistics.

Spark has no distribution functions, so these run as Arrow UDFs over result rows, of which
there is one per test. Everything before that (counts, means, ranks) stays in Spark.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz iteration)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + numerator / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return value


def beta_cdf(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    front = math.exp(log_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def gamma_tail(s: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0.0:
        return 1.0
    front = math.exp(s * math.log(x) - x - math.lgamma(s))
    if x < s + 1.0:
        term = total = 1.0 / s
        n = s
        while abs(term) > abs(total) * 1e-16:
            n += 1.0
            term *= x / n
            total += term
        return 1.0 - front * total
    tiny = 1e-300
    b = x + 1.0 - s
    c, d = 1.0 / tiny, 1.0 / b
    value = d
    for i in range(1, 500):
        a = -i * (i - s)
        b += 2.0
        d = 1.0 / (a * d + b or tiny)
        c = b + a / c or tiny
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return front * value


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def t_two_sided(t: float, df: float) -> float:
    return beta_cdf(df / 2.0, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    return beta_cdf(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def chi2_upper(x: float, df: float) -> float:
    return gamma_tail(df / 2.0, x / 2.0)


def _mapped(function, *series: pd.Series) -> pd.Series:
    rows = zip(*series)
    return pd.Series([None if any(pd.isna(v) for v in row) else function(*row) for row in rows], dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return _mapped(normal_two_sided, z)


@F.pandas_udf(T.DoubleType())
def t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return _mapped(t_two_sided, t, df)


@F.pandas_udf(T.DoubleType())
def f_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _mapped(f_upper, f, d1, d2)


@F.pandas_udf(T.DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return _mapped(chi2_upper, x, df)
