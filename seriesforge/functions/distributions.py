"""Tail probabilities for the few statistics a comparison produces."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def student_t_two_sided(t: float, freedom: float) -> float:
    """P(|T| > |t|), through the regularised incomplete beta function."""
    if math.isinf(t):
        return 0.0
    x = freedom / (freedom + t * t)
    return _incomplete_beta(freedom / 2.0, 0.5, x, t * t / (freedom + t * t))


def _incomplete_beta(a: float, b: float, x: float, complement: float) -> float:
    if x <= 0.0:
        return 0.0
    if complement <= 0.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(complement)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, complement) / b


def _fraction(a: float, b: float, x: float) -> float:
    """Lentz evaluation of the continued fraction of the incomplete beta function."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        step = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            c = 1.0 + term / c
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = c if abs(c) > tiny else tiny
            step = d * c
            value *= step
        if abs(step - 1.0) < 1e-15:
            break
    return value


def normal_cdf(z: Column) -> Column:
    """P(Z <= z) of the standard normal distribution; meant for result tables of a row per series."""

    @F.pandas_udf("double")
    def below(values: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(v) else 0.5 * math.erfc(-v / math.sqrt(2.0)) for v in values], dtype="float64")

    return below(z.cast("double"))


def t_p_value(t: Column, freedom: Column) -> Column:
    """Two-sided p-value of a t statistic; meant for result tables of a few rows."""

    @F.pandas_udf("double")
    def p_values(statistic: pd.Series, degrees: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if pd.isna(s) or pd.isna(d) or d <= 0 else student_t_two_sided(float(s), float(d))
                for s, d in zip(statistic, degrees)
            ],
            dtype="float64",
        )

    return p_values(t.cast("double"), freedom.cast("double"))


def correlation_t(r: Column, n: Column) -> Column:
    """t statistic of a correlation coefficient over n rows."""
    return r * F.sqrt(F.try_divide(n - 2, F.lit(1.0) - r * r))


def chi2_two_p_value(statistic: Column) -> Column:
    """Upper tail of chi-squared with two degrees of freedom."""
    return F.exp(-statistic / 2)
