"""Tail probabilities of the normal, t and F distributions.

They are evaluated on rows of test statistics (one row per test), inside Arrow batches.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def normal_upper(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
                     + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            step = d * c
            value *= step
        if abs(step - 1.0) < 1e-14:
            break
    return front * value


def t_two_sided(t: float, df: float) -> float:
    return incomplete_beta(df / 2.0, 0.5, df / (df + t * t))


def f_upper(f: float, d1: float, d2: float) -> float:
    return incomplete_beta(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def _apply(fn, *cols):
    return pd.Series([None if any(pd.isna(v) for v in vs) else fn(*vs) for vs in zip(*cols)], dtype="float64")


@F.pandas_udf(DoubleType())
def normal_two_sided_p(z: pd.Series) -> pd.Series:
    return _apply(lambda v: 2.0 * normal_upper(abs(v)), z)


@F.pandas_udf(DoubleType())
def normal_upper_p(z: pd.Series) -> pd.Series:
    return _apply(normal_upper, z)


@F.pandas_udf(DoubleType())
def t_two_sided_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return _apply(t_two_sided, t, df)


@F.pandas_udf(DoubleType())
def f_upper_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _apply(f_upper, f, d1, d2)
