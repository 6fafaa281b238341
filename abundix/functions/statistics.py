"""Distribution functions and transforms.

The tail functions take one value per *aggregated* row (a feature, a pathway
reaction), never per input row, so they run as Arrow-batched pandas UDFs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from abundix.functions.features import _col

_CLOSE = 1e-14
_TINY = 1e-300


def _lgamma(values: np.ndarray) -> np.ndarray:
    return np.fromiter((math.lgamma(v) for v in values), dtype=float, count=len(values))


def _density(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """x^a e^-x / Gamma(a + 1).

    For a above 20 by Stirling's series in the distance of x from a, as the plain logarithms
    of large values cancel.
    """
    small = a < 20
    out = np.empty(len(a))
    sa, sx = a[small], x[small]
    out[small] = np.exp(sa * np.log(sx) - sx - _lgamma(sa + 1))
    la, lx = a[~small], x[~small]
    off = (lx - la) / la
    apart = off - np.log1p(off)
    correction = 1 / (12 * la) - 1 / (360 * la**3) + 1 / (1260 * la**5) - 1 / (1680 * la**7)
    out[~small] = np.exp(-la * apart - correction) / np.sqrt(2 * np.pi * la)
    return out


def _series(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """P(a, x) for x up to a + 1, where the terms fall; every value runs until its terms no longer count."""
    total, term = np.ones(len(a)), np.ones(len(a))
    live, i = np.arange(len(a)), 0
    while len(live):
        i += 1
        term[live] *= x[live] / (a[live] + i)
        total[live] += term[live]
        live = live[term[live] > total[live] * _CLOSE * 0.01]
    return np.minimum(1.0, _density(a, x) * total)


def _fraction(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Q(a, x) for x above a + 1 by the continued fraction, each value until it stands still."""
    b = x + 1 - a
    c, d = np.full(len(a), 1 / _TINY), 1 / b
    h = d.copy()
    live, i = np.arange(len(a)), 0
    while len(live):
        i += 1
        an = -i * (i - a[live])
        b[live] += 2
        dl = an * d[live] + b[live]
        dl = 1 / np.where(np.abs(dl) < _TINY, _TINY, dl)
        cl = b[live] + an / c[live]
        cl = np.where(np.abs(cl) < _TINY, _TINY, cl)
        step = dl * cl
        c[live], d[live] = cl, dl
        h[live] *= step
        live = live[np.abs(step - 1) > _CLOSE]
    return np.clip(_density(a, x) * a * h, 0.0, 1.0)


def _gamma_parts(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Regularised lower and upper incomplete gamma; each from the side on which it loses nothing."""
    lower = np.where((x > 0) & (a <= 0), 1.0, 0.0)
    live = (x > 0) & (a > 0)
    upper = 1 - lower
    infinite = live & np.isinf(x)
    lower[infinite], upper[infinite] = 1.0, 0.0
    near = np.flatnonzero(live & ~infinite & (x <= a + 1))
    far = np.flatnonzero(live & ~infinite & (x > a + 1))
    lower[near] = _series(a[near], x[near])
    upper[near] = 1 - lower[near]
    upper[far] = _fraction(a[far], x[far])
    lower[far] = 1 - upper[far]
    return lower, upper


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    c = np.ones(len(x))
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < _TINY, _TINY, d)
    h = d.copy()
    live, m = np.arange(len(x)), 0
    while len(live):
        m += 1
        al, bl, xl = a[live], b[live], x[live]
        for coefficient in (
            m * (bl - m) * xl / ((al + 2 * m - 1) * (al + 2 * m)),
            -(al + m) * (al + bl + m) * xl / ((al + 2 * m) * (al + 2 * m + 1)),
        ):
            dl = 1 + coefficient * d[live]
            dl = 1 / np.where(np.abs(dl) < _TINY, _TINY, dl)
            cl = 1 + coefficient / c[live]
            cl = np.where(np.abs(cl) < _TINY, _TINY, cl)
            c[live], d[live] = cl, dl
            h[live] *= dl * cl
        live = live[np.abs(dl * cl - 1) > _CLOSE]
    return h


def _beta_cdf(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta."""
    x = np.clip(x, 0.0, 1.0)
    inner = (x > 0) & (x < 1)
    out = np.where(x >= 1, 1.0, 0.0)
    if inner.any():
        ia, ib, ix = a[inner], b[inner], x[inner]
        front = np.exp(
            _lgamma(ia + ib) - _lgamma(ia) - _lgamma(ib) + ia * np.log(ix) + ib * np.log1p(-ix)
        )
        direct = ix < (ia + 1) / (ia + ib + 2)
        low = front * _beta_fraction(ia, ib, ix) / ia
        high = 1 - front * _beta_fraction(ib, ia, 1 - ix) / ib
        out[inner] = np.where(direct, low, high)
    return out


@F.pandas_udf(T.DoubleType())
def _chi2_cdf(x: pd.Series, k: pd.Series) -> pd.Series:
    x, k = x.astype(float), k.astype(float)
    known = (x.notna() & k.notna()).to_numpy()
    out = np.full(len(x), np.nan)
    out[known] = _gamma_parts(k.to_numpy()[known] / 2, x.to_numpy()[known] / 2)[0]
    return pd.Series(out).where(known, None)


@F.pandas_udf(T.DoubleType())
def _chi2_sf(x: pd.Series, k: pd.Series) -> pd.Series:
    x, k = x.astype(float), k.astype(float)
    known = (x.notna() & k.notna()).to_numpy()
    out = np.full(len(x), np.nan)
    out[known] = _gamma_parts(k.to_numpy()[known] / 2, x.to_numpy()[known] / 2)[1]
    return pd.Series(out).where(known, None)


@F.pandas_udf(T.DoubleType())
def _spearman_p(rho: pd.Series, n: pd.Series) -> pd.Series:
    rho, n = rho.astype(float), n.astype(float)
    known = (rho.notna() & n.notna() & (n > 2)).to_numpy()
    out = np.full(len(rho), np.nan)
    r = np.clip(rho.to_numpy()[known], -1.0, 1.0)
    dof = n.to_numpy()[known] - 2
    # two-sided t tail: t^2 = rho^2 * dof / (1 - rho^2), and dof / (dof + t^2) = 1 - rho^2
    out[known] = _beta_cdf(dof / 2, np.full(len(r), 0.5), 1 - r * r)
    return pd.Series(out).where(known, None)


def chi2_cdf(x: Column | str, k: Column | str) -> Column:
    """Chi-square distribution function P(k/2, x/2); 0 at x = 0."""
    return _chi2_cdf(_col(x).cast("double"), _col(k).cast("double"))


def chi2_sf(x: Column | str, k: Column | str) -> Column:
    """Upper chi-square tail, accurate for small p-values."""
    return _chi2_sf(_col(x).cast("double"), _col(k).cast("double"))


def spearman_p(rho: Column | str, n: Column | str) -> Column:
    """Two-sided p-value of a rank correlation over ``n`` pairs."""
    return _spearman_p(_col(rho).cast("double"), _col(n).cast("double"))


def log_transform(value: Column | str, base: float = 10.0) -> Column:
    return F.ln(_col(value)) / F.lit(math.log(base))


def ordered_bits(value: Column | str) -> Column:
    """A long that orders doubles as their values do: the bits of the magnitude, negative below zero.

    Both zeros are 0, NaN comes last.  Scaling by powers of two is exact, so the bits are.
    """
    v = _col(value).cast("double")
    a = F.abs(v)
    guess = F.floor(F.log2(a)).cast("int")
    power = F.pow(F.lit(2.0), guess)
    # the logarithm may be rounded over a power of two
    exponent = guess + F.when(a >= power * 2, 1).when(a < power, -1).otherwise(0)
    fraction = ((a / F.pow(F.lit(2.0), exponent) - 1) * float(1 << 52)).cast("long")
    normal = (exponent + 1023).cast("long") * F.lit(1 << 52) + fraction
    tiny = (a * float(1 << 537) * float(1 << 537)).cast("long")
    bits = (
        F.when(F.isnan(v), F.lit((2047 << 52) + 1))
        .when(a == float("inf"), F.lit(2047 << 52))
        .when(a < 2.0**-1022, tiny)
        .otherwise(normal)
    )
    return F.when(v < 0, -bits).otherwise(bits)
