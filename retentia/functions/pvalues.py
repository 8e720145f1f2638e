"""Tail probabilities of test statistics.

They run on result tables of a few rows, through vectorised column functions.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def normal_cdf(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x): series below a + 1, continued fraction above."""
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * front)
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or tiny)
        c = b + an / c or tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b) by its continued fraction."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_inc(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    tiny = 1e-300
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    h = d
    for m in range(1, 10000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / (1 + step * d or tiny)
            c = 1 + step / c or tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return min(1.0, front * h)


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi2_tail(x: float, dof: float) -> float:
    return gamma_upper(dof / 2, x / 2)


def t_two_sided(t: float, dof: float) -> float:
    return beta_inc(dof / 2, 0.5, dof / (dof + t * t))


def f_tail(f: float, d1: float, d2: float) -> float:
    return beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def kolmogorov_tail(x: float) -> float:
    """Limit law of the scaled Kolmogorov statistic."""
    if x < 0.2:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))
    return min(1.0, max(0.0, 2 * total))


def studentized_range_tail(q: float, groups: float, dof: float) -> float:
    """P(Q > q) by two nested Gauss-Legendre rules over the deviation and the largest value."""
    if q <= 0:
        return 1.0
    nodes, weights = np.polynomial.legendre.leggauss(96)
    cdf = np.vectorize(normal_cdf)
    z = 8.0 * nodes
    density = np.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    at_z = cdf(z)

    def range_cdf(width):
        inner = np.clip(at_z - cdf(z - width), 0, 1) ** (groups - 1)
        return groups * 8.0 * float(np.sum(weights * density * inner))

    if dof > 5000:
        return min(1.0, max(0.0, 1 - range_cdf(q)))
    # Density of s = chi/sqrt(dof), nearly all of it within eight of its deviations of 1.
    half = min(8.0 / math.sqrt(2 * dof), 1.0)
    top = 1 + 8.0 / math.sqrt(2 * dof)
    lo, hi = max(1e-6, 1 - half), top
    s = (hi - lo) / 2 * nodes + (hi + lo) / 2
    log_c = math.log(2) + dof / 2 * math.log(dof / 2) - math.lgamma(dof / 2)
    dens = np.exp(log_c + (dof - 1) * np.log(s) - dof * s * s / 2)
    below = np.array([range_cdf(q * x) for x in s])
    return min(1.0, max(0.0, 1 - (hi - lo) / 2 * float(np.sum(weights * dens * below))))


def _column(scalar):
    """Column function from a scalar one; nulls and NaN stay null."""

    def run(*args: pd.Series) -> pd.Series:
        return pd.Series(
            [None if any(pd.isna(v) for v in row) else float(scalar(*row)) for row in zip(*args)], dtype="float64"
        )

    return run


# Hart's rational approximation of the normal tail, as published by West (2005); absolute error below 1e-14.
TAIL_TOP = (0.0352624965998911, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
TAIL_BOTTOM = (0.0883883476483184, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
TAIL_SWITCH = 7.07106781186547


def normal_cdf_column(z: Column) -> Column:
    """Normal distribution function as a plain expression, for columns of any length."""
    x = F.abs(z)

    def polynomial(coefficients):
        out = F.lit(coefficients[0])
        for c in coefficients[1:]:
            out = out * x + F.lit(c)
        return out

    fraction = x + 0.65
    for k in (4, 3, 2, 1):
        fraction = x + F.lit(float(k)) / fraction
    bell = F.exp(-x * x / 2)
    tail = F.when(x < TAIL_SWITCH, bell * polynomial(TAIL_TOP) / polynomial(TAIL_BOTTOM)).otherwise(bell / fraction / 2.506628274631)
    return F.when(z > 0, 1 - tail).otherwise(tail)


@pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return _column(normal_two_sided)(z)


@pandas_udf(DoubleType())
def chi2_p(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _column(chi2_tail)(x, dof)


@pandas_udf(DoubleType())
def t_p(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _column(t_two_sided)(t, dof)


@pandas_udf(DoubleType())
def f_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _column(f_tail)(f, d1, d2)


@pandas_udf(DoubleType())
def ks_p(x: pd.Series) -> pd.Series:
    return _column(kolmogorov_tail)(x)


@pandas_udf(DoubleType())
def tukey_p(q: pd.Series, groups: pd.Series, dof: pd.Series) -> pd.Series:
    return _column(studentized_range_tail)(q, groups, dof)
