"""Scores and tests of interactions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Least p-value that is reported.
FLOOR = 1e-10


def global_complementarity(cmpl: str) -> Column:
    """Median times maximum; null for none, or where the product is 0."""
    return F.nullif(F.median(cmpl) * F.max(cmpl), F.lit(0.0))


def global_hybridisation(energy: str) -> Column:
    """-sqrt(median * minimum) if both are negative, else sqrt(|median * minimum|); null for none."""
    med, low = F.median(energy), F.min(energy)
    return F.when((med < 0) & (low < 0), -F.sqrt(med * low)).otherwise(F.sqrt(F.abs(med * low)))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for positive numbers: Stirling's series, above 10 after shifting."""
    x = np.asarray(x, dtype=np.float64).copy()
    shift = np.ones_like(x)
    for _ in range(10):
        low = x < 10
        shift = np.where(low, shift * x, shift)
        x = np.where(low, x + 1, x)
    u = 1 / (x * x)
    series = (1 / 12 - u * (1 / 360 - u * (1 / 1260 - u * (1 / 1680 - u * (1 / 1188 - u * 691 / 360360))))) / x
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


def binomial_tails(x: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """P(X > x) of binomial distributions, by the continued fraction of the incomplete beta function."""
    x, n, p = (np.asarray(v, dtype=np.float64) for v in (x, n, p))
    out = np.where((p >= 1) & (x < n), 1.0, 0.0)
    at = np.flatnonzero((p > 0) & (p < 1) & (x < n))
    a, b, q = x[at] + 1, n[at] - x[at], p[at]
    front = np.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * np.log(q) + b * np.log1p(-q))
    # beyond the mean the fraction of the other tail converges
    other = q >= (a + 1) / (a + b + 2)
    a, b, q = np.where(other, b, a), np.where(other, a, b), np.where(other, 1 - q, q)
    tail = front * _fractions(a, b, q) / a
    out[at] = np.where(other, 1 - tail, tail)
    return out


def binomial_tail(x: int, n: int, p: float) -> float:
    return float(binomial_tails(np.array([x]), np.array([n]), np.array([p]))[0])


def _fractions(a: np.ndarray, b: np.ndarray, x: np.ndarray, tiny: float = 1e-300) -> np.ndarray:
    """Modified Lentz evaluation, of all that have not converged yet in step."""
    solid = lambda v: np.where(np.abs(v) > tiny, v, tiny)
    c, d = np.ones_like(x), 1 / solid(1 - (a + b) * x / (a + 1))
    out, result, at = d.copy(), np.ones_like(x), np.arange(len(x))
    for m in range(1, 100_000):
        if not len(at):
            break
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / solid(1 + num * d)
            c = solid(1 + num / c)
            out = out * c * d
        go = np.abs(c * d - 1) >= 1e-14
        result[at[~go]] = out[~go]
        at, a, b, x, c, d, out = (v[go] for v in (at, a, b, x, c, d, out))
    result[at] = out
    return result


def binomial_tail_udf():
    """Arrow function (x, n, p) -> P(X > x)."""

    @F.pandas_udf("double")
    def run(x: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
        known = (x.notna() & n.notna() & p.notna()).to_numpy()
        out = np.full(len(x), np.nan)
        out[known] = binomial_tails(x[known].to_numpy(), n[known].to_numpy(), p[known].to_numpy())
        return pd.Series(out).astype(object).where(known, None).astype("Float64")

    return run


def interaction_pvalue(support: str, reads: str, f1: str, f2: str, same: Column, least_support: int = 5) -> Column:
    """Chance of more than the seen support; 1 below least_support; p = f1 f2 (one partner with itself), else 2 f1 f2."""
    f = F.coalesce(F.col(f1) * F.col(f2), F.lit(0.0))
    p = F.when(same, f).otherwise(2 * f)
    tail = binomial_tail_udf()(F.when(F.col(support) >= least_support, F.col(support)), F.col(reads), F.least(p, F.lit(1.0)))
    return F.when(F.col(support) < least_support, F.lit(1.0)).otherwise(F.greatest(tail, F.lit(FLOOR)))


def combined_pvalue(pvals: str) -> Column:
    """Of an array of p-values: each times n / rank (at most 1), then Fisher's method; its even chi-square tail in closed form."""
    h = f"aggregate(transform(array_sort({pvals}), (p, i) -> -ln(least(1d, p * size({pvals}) / (i + 1)))), 0d, (a, x) -> a + x)"
    term = f"aggregate(sequence(1, size({pvals})), named_struct('s', 0d, 't', 1d), (a, i) -> named_struct('s', a.s + a.t, 't', a.t * ({h}) / i), a -> a.s)"
    return F.expr(f"greatest({FLOOR}d, least(1d, exp(-({h})) * {term}))")
