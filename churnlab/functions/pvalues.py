"""p-values for aggregated test statistics.

Spark SQL has no incomplete beta or gamma functions, so these are evaluated by Arrow-batched pandas
UDFs on *aggregated* tables (one row per feature or test), never on raw rows.

A p-value is the ratio of two integrals of the same unnormalised density, the tail's and the
whole one, so no gamma function of a large argument is ever taken. The variable is the log of the statistic over
its most likely value; there the log densities are (a, b half the degrees of freedom, r = a / (a + b))

    chi-squared   G(u) = -a (e^u - 1 - u)
    F, and t^2    G(u) = a u - (a + b) log(1 + r (e^u - 1))

both concave, smooth, and 0 at their maximum u = 0, at any degrees of freedom. Where G has fallen by
``DROP`` below its largest value in the range nothing is left to add, and the rest is cut into panels of
Gauss-Legendre points. Tails are added in logs, so tiny p-values keep their relative accuracy.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DROP, PANELS = 46.0, 40
_POINTS, _WEIGHTS = np.polynomial.legendre.leggauss(20)


def _end(g: Callable, top: float, height: float, step: float) -> float:
    """Where ``g`` is ``DROP`` below ``height``, on the side of ``top`` that the sign of ``step`` names."""
    near, far = top, top + step
    while g(far) > height - DROP:
        near, step = far, 2 * step
        far = top + step
    for _ in range(20):  # an end a little too far out does no harm
        middle = (near + far) / 2
        near, far = (middle, far) if g(middle) > height - DROP else (near, middle)
    return far


def _log_integral(g: Callable, low: float | None, width: float) -> float:
    """log of the integral of exp(g) from ``low`` (None: from minus infinity) up; ``width``: the peak's."""
    top = 0.0 if low is None or low < 0 else low
    height = float(g(top))
    start = _end(g, top, height, -width) if low is None else low if top == low else max(low, _end(g, top, height, -width))
    stop = _end(g, top, height, width)
    edges = np.linspace(start, stop, PANELS + 1)
    half = np.diff(edges) / 2
    u = (edges[:-1] + half)[:, None] + half[:, None] * _POINTS
    return height + math.log(float((np.exp(g(u) - height) * _WEIGHTS * half[:, None]).sum()))


def _tail(g: Callable, at: float, width: float) -> float:
    return min(1.0, math.exp(_log_integral(g, at, width) - _log_integral(g, None, width)))


def _f_tail(u: float, a: float, b: float) -> float:
    """P(F > e^u) for 2a and 2b degrees of freedom."""
    r = a / (a + b)

    def g(v):
        v = np.asarray(v, np.float64)
        within = np.log1p(r * np.expm1(np.minimum(v, 600.0)))
        beyond = v + np.log(r)  # e^v alone counts, and would pass the range of a double
        return a * v - (a + b) * np.where(v > 600.0, beyond, within)

    return _tail(g, u, math.sqrt((a + b) / a / b))


def t_two_sided(t: float, df: float) -> float:
    if t is None or df is None or not np.isfinite(t) or not np.isfinite(df) or df <= 0:
        return float("nan")
    return 1.0 if t == 0 else _f_tail(2 * math.log(abs(t)), 0.5, df / 2)


def f_sf(f: float, d1: float, d2: float) -> float:
    if f is None or not np.isfinite(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    return 1.0 if f <= 0 else _f_tail(math.log(f), d1 / 2, d2 / 2)


def chi2_sf(x: float, dof: float) -> float:
    if x is None or not np.isfinite(x) or dof <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    a = dof / 2
    at = math.log1p((x - dof) / dof) if abs(x - dof) < dof / 2 else math.log(x) - math.log(dof)
    return _tail(lambda u: -a * (np.expm1(u) - u), at, 1 / math.sqrt(a))


def ks_two_sample(d: float, n1: float, n2: float) -> float:
    """Asymptotic two-sided p of the two-sample KS statistic with the small-sample correction
    (Stephens): lambda = (sqrt(ne) + 0.12 + 0.11/sqrt(ne)) * D, Q(lambda) = 2 sum (-1)^(j-1) e^(-2 j^2 lambda^2)."""
    if d is None or not np.isfinite(d) or n1 <= 0 or n2 <= 0:
        return float("nan")
    ne = n1 * n2 / (n1 + n2)
    s = math.sqrt(ne)
    lam = (s + 0.12 + 0.11 / s) * d
    if lam < 1e-3:
        return 1.0
    total, sign = 0.0, 1.0
    for j in range(1, 200):
        term = sign * math.exp(-2.0 * j * j * lam * lam)
        total += term
        if abs(term) < 1e-16 * max(abs(total), 1e-300):
            break
        sign = -sign
    return float(min(1.0, max(0.0, 2.0 * total)))


def _vec(fn, *series: pd.Series) -> pd.Series:
    vals = [fn(*[None if pd.isna(v) else float(v) for v in row]) for row in zip(*series)]
    return pd.Series(vals, dtype="float64")


@F.pandas_udf(T.DoubleType())
def _t_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return _vec(lambda a, b: float("nan") if a is None or b is None else t_two_sided(a, b), t, df)


@F.pandas_udf(T.DoubleType())
def _f_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _vec(lambda a, b, c: float("nan") if None in (a, b, c) else f_sf(a, b, c), f, d1, d2)


@F.pandas_udf(T.DoubleType())
def _chi2_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _vec(lambda a, b: float("nan") if None in (a, b) else chi2_sf(a, b), x, dof)


@F.pandas_udf(T.DoubleType())
def _ks_udf(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    return _vec(lambda a, b, c: float("nan") if None in (a, b, c) else ks_two_sample(a, b, c), d, n1, n2)


def _nan_to_null(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def p_t(t: Column, df: Column) -> Column:
    return _nan_to_null(_t_udf(t.cast("double"), df.cast("double")))


def p_f(f: Column, d1: Column, d2: Column) -> Column:
    return _nan_to_null(_f_udf(f.cast("double"), d1.cast("double"), d2.cast("double")))


def p_chi2(x: Column, dof: Column) -> Column:
    return _nan_to_null(_chi2_udf(x.cast("double"), dof.cast("double")))


def p_ks(d: Column, n1: Column, n2: Column) -> Column:
    return _nan_to_null(_ks_udf(d.cast("double"), n1.cast("double"), n2.cast("double")))
