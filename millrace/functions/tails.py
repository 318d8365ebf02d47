"""Upper-tail probabilities for chi-square, Student t and F statistics.

Spark has no incomplete gamma or beta function.  The data-sized part of a test
is its aggregate; these functions see one row per finished test.
"""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship this module's code inside the functions, so executors need no copy of
# the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY = 1e-300
_EPS = 1e-16
_MAX_TERMS = 100_000


def _lentz(terms, start: float) -> float:
    """Evaluate start + a1/(b1 + a2/(b2 + ...)) by the modified Lentz method."""
    f = start or _TINY
    c, d = f, 0.0
    for a, b in terms:
        d = b + a * d
        c = b + a / c
        d = 1.0 / (d or _TINY)
        c = c or _TINY
        step = c * d
        f *= step
        if abs(step - 1.0) < _EPS:
            break
    return f


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0.0:
        return 1.0
    log_front = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1.0:
        term = total = 1.0 / a
        k = a
        for _ in range(_MAX_TERMS):
            k += 1.0
            term *= x / k
            total += term
            if term < total * _EPS:
                break
        return max(0.0, 1.0 - total * math.exp(log_front))
    fraction = _lentz(
        ((-i * (i - a), x + 2.0 * i + 1.0 - a) for i in range(1, _MAX_TERMS)), x + 1.0 - a
    )
    return math.exp(log_front) / fraction


def beta_regularised(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_regularised(b, a, 1.0 - x)

    def terms():
        for m in range(_MAX_TERMS):
            if m:
                yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0

    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    return math.exp(log_front) / (a * _lentz(terms(), 1.0))


def _known(*values) -> bool:
    return all(v is not None and not math.isnan(v) for v in values)


def chi2_tail(x: float, dof: float) -> float | None:
    if not _known(x, dof):
        return None
    return 1.0 if dof <= 0 else gamma_upper(dof / 2.0, x / 2.0)


def t_tail(t: float, dof: float) -> float | None:
    if not _known(t, dof) or dof <= 0:
        return None
    return beta_regularised(dof / 2.0, 0.5, dof / (dof + t * t))


def f_tail(f: float, d1: float, d2: float) -> float | None:
    if not _known(f, d1, d2) or d1 <= 0 or d2 <= 0:
        return None
    return beta_regularised(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


@F.pandas_udf(T.DoubleType())
def _chi2_udf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi2_tail(*v) for v in zip(x, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _t_udf(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([t_tail(*v) for v in zip(t, dof)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _f_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([f_tail(*v) for v in zip(f, d1, d2)], dtype="float64")


def chi2_pvalue(x: Column, dof: Column) -> Column:
    return F.nanvl(_chi2_udf(x.cast("double"), dof.cast("double")), F.lit(None))


def t_pvalue(t: Column, dof: Column) -> Column:
    """Two-sided."""
    return F.nanvl(_t_udf(t.cast("double"), dof.cast("double")), F.lit(None))


def f_pvalue(f: Column, d1: Column, d2: Column) -> Column:
    return F.nanvl(_f_udf(f.cast("double"), d1.cast("double"), d2.cast("double")), F.lit(None))
