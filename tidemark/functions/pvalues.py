"""Tail probabilities for the test results.

The tests reduce to one row of aggregates inside Spark; only that row passes
through these Arrow-batched functions. The Python helpers are pickled by value,
so executors do not need the package on their path.
"""

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A sample this small is compared with the exact distribution when no values tie.
EXACT_LIMIT = 8
# From so many degrees of freedom on Wallace's transformation to a normal deviate is closer
# than the fraction, which cancels.
NORMAL_FROM = 1e7
# The continued fraction needs about sqrt(max(a, b)) steps; far beyond that something is wrong.
FRACTION_STEPS = 1_000_000


def _lgamma_step(a, b):
    """lgamma(a + b) - lgamma(a). For large `a` both are nearly equal, so their
    difference is taken term by term from Stirling's series."""
    if a < 1e3:
        return math.lgamma(a + b) - math.lgamma(a)

    def tail(z):
        return 1.0 / (12.0 * z) - 1.0 / (360.0 * z ** 3)
    return ((a - 0.5) * math.log1p(b / a) + b * math.log(a + b) - b
            + tail(a + b) - tail(a))


def _beta_tail(a, b, x, rest):
    """Regularised incomplete beta I_x(a, b) by its continued fraction (Lentz).

    `rest` is 1 - x, given so that no digits are lost where x is close to 1.
    """
    if x <= 0.0 or rest <= 0.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _beta_tail(b, a, rest, x)
    log_x = math.log1p(-rest) if rest < 0.5 else math.log(x)
    log_rest = math.log(rest) if rest < 0.5 else math.log1p(-x)
    small, large = sorted((a, b))
    front = math.exp(_lgamma_step(large, small) - math.lgamma(small)
                     + a * log_x + b * log_rest) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 / ((1.0 - (a + b) * x / (a + 1.0)) or tiny)
    value = d
    m = 0
    while True:
        m += 1
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        for step in (even, odd):
            d = 1.0 / ((1.0 + step * d) or tiny)
            c = (1.0 + step / c) or tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return front * value
        if m > FRACTION_STEPS:
            raise ArithmeticError(f"incomplete beta of ({a}, {b}, {x}) does not converge")


def student_two_sided(t, df):
    """P(|T| >= |t|) for Student's t with `df` degrees of freedom."""
    if math.isnan(t) or math.isnan(df):
        return math.nan
    if math.isinf(t):
        return 0.0
    if df > NORMAL_FROM:
        z = math.sqrt(df * math.log1p(t * t / df)) * (8.0 * df + 1.0) / (8.0 * df + 3.0)
        return normal_two_sided(z)
    return _beta_tail(df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t))


def normal_two_sided(z):
    """min(1, 2 P(Z >= z)); `z` may be negative after the continuity correction."""
    return math.nan if math.isnan(z) else min(1.0, math.erfc(z / math.sqrt(2.0)))


def rank_sum_two_sided(u, n_a, n_b):
    """Exact two-sided p of a Mann-Whitney U without ties; `u` is the larger of the two."""
    short, long = sorted((n_a, n_b))
    # ways[s]: orderings of the values seen so far whose statistic equals s,
    # from the generating function prod_i (1 - q^(long+i)) / (1 - q^i).
    size = short * long + 1
    ways = [0] * size
    ways[0] = 1
    for i in range(1, short + 1):
        for s in range(size - 1, long + i - 1, -1):
            ways[s] -= ways[s - long - i]
        for s in range(i, size):
            ways[s] += ways[s - i]
    upper = sum(ways[math.ceil(u):])
    return min(1.0, 2 * upper / math.comb(short + long, short))


@F.pandas_udf(T.DoubleType())
def student_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([student_two_sided(x, y) for x, y in zip(t, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def rank_sum_p(z: pd.Series, u: pd.Series, n_a: pd.Series, n_b: pd.Series,
               exact: pd.Series) -> pd.Series:
    return pd.Series(
        [rank_sum_two_sided(uu, int(a), int(b)) if ex else normal_two_sided(zz)
         for zz, uu, a, b, ex in zip(z, u, n_a, n_b, exact)], dtype="float64")
