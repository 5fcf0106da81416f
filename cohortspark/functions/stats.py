"""Summaries as aggregate expressions, and tail probabilities as Arrow-batched functions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SUMMARY = ("minimum", "lower_quartile", "median", "upper_quartile", "maximum")
QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)
#: Fixed value: median of the chi-squared distribution with one degree of freedom.
CHI2_MEDIAN = 0.4549364231195724


def summary(x: Column) -> list[Column]:
    """Five quantiles by linear interpolation, mean and sample variance (0 of a single value), for groups of bounded size.

    All quantiles come from one aggregate; variables.summaries() does the same for groups of any size.
    """
    shares = F.percentile(x, F.array(*(F.lit(p) for p in QUARTILES)))
    return [*(shares[i].alias(n) for i, n in enumerate(SUMMARY)), *moments(x)]


def moments(x: Column) -> list[Column]:
    return [F.avg(x).alias("mean"), F.when(F.count(x) > 0, F.coalesce(F.var_samp(x), F.lit(0.0))).alias("variance")]


_erfc = np.frompyfunc(math.erfc, 1, 1)  # the C function on each element


def chi2_sf(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Upper tail of the chi-squared distribution, element by element; NaN where x is or df is not positive.

    The incomplete gamma function by its series below df / 2 + 1 and by its continued fraction above, all elements at once
    until the last one stands still.
    """
    x, df = np.broadcast_arrays(np.atleast_1d(np.asarray(x, np.float64)), np.asarray(df, np.float64))
    out = np.full(x.shape, np.nan)
    ok = (x == x) & (df > 0)
    out[ok & (x <= 0)] = 1.0
    at = np.flatnonzero(ok & (x > 0))
    a, z = df[at] / 2, x[at] / 2
    of, inverse = np.unique(a, return_inverse=True)
    log_front = -z + a * np.log(z) - np.array([math.lgamma(v) for v in of])[inverse]
    front = np.where(log_front > -745, np.exp(np.maximum(log_front, -745)), 0.0)
    low = z < a + 1
    tail = np.empty(len(at))
    tail[low] = np.maximum(0.0, 1 - front[low] * _lower_series(a[low], z[low]))
    tail[~low] = front[~low] * _upper_fraction(a[~low], z[~low])
    out[at] = tail
    return out


def _lower_series(a: np.ndarray, z: np.ndarray) -> np.ndarray:
    term = 1 / a
    total = term.copy()
    k = 1
    while len(a) and (term >= total * 1e-17).any() and k < 10_000:
        term = term * (z / (a + k))
        total += term
        k += 1
    return total


def _upper_fraction(a: np.ndarray, z: np.ndarray) -> np.ndarray:
    """By the modified Lentz recurrence."""
    b = z + 1 - a
    c, d = np.full(len(a), 1e300), 1 / b
    h = d.copy()
    k, moving = 1, len(a) > 0
    while moving and k < 10_000:
        step = -k * (k - a)
        b = b + 2
        d = 1 / (step * d + b)
        c = b + step / c
        h = h * (d * c)
        moving = (np.abs(d * c - 1) > 1e-15).any()
        k += 1
    return h


def p_of(chi2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tail probability with one degree of freedom, its log10, also where the tail itself underflows)."""
    x = np.asarray(chi2, np.float64)
    half = np.maximum(x, 0) / 2
    p = np.where(x == x, _erfc(np.sqrt(np.where(x == x, half, 0.0))).astype(np.float64), np.nan)
    far = p <= 1e-290
    z = np.where(far, half, 1.0)
    expansion = (-z - 0.5 * np.log(math.pi * z) + np.log1p(-1 / (2 * z) + 3 / (4 * z * z))) / math.log(10)
    with np.errstate(divide="ignore"):
        return p, np.where(far, expansion, np.log10(np.where(far, 1.0, p)))


def _float(values: pd.Series) -> np.ndarray:
    return values.to_numpy(dtype=np.float64, na_value=np.nan)


def _nullable(x: np.ndarray) -> pd.Series:
    return pd.Series(pd.array(np.where(x == x, x, 0.0), dtype="Float64")).mask(x != x)


@F.pandas_udf(T.StructType([T.StructField("p", T.DoubleType()), T.StructField("log10_p", T.DoubleType())]))
def p_value(chi2: pd.Series) -> pd.DataFrame:
    p, log = p_of(_float(chi2))
    return pd.DataFrame({"p": _nullable(p), "log10_p": _nullable(log)})


@F.pandas_udf(T.DoubleType())
def chi2_tail(chi2: pd.Series, df: pd.Series) -> pd.Series:
    return _nullable(chi2_sf(_float(chi2), _float(df)))
