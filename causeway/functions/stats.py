"""Normal and Student t tails for result-sized rows (driver or solver rows only)."""

from __future__ import annotations

import math
from statistics import NormalDist

_NORMAL = NormalDist()


def normal_quantile(p: float) -> float:
    return _NORMAL.inv_cdf(p)


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    floor = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > floor else floor)
    value = d
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > floor else floor)
            c = 1.0 + term / c
            c = c if abs(c) > floor else floor
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-15:
            break
    return value


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def t_two_sided(t: float, dof: float) -> float:
    if dof <= 0 or math.isnan(t):
        return math.nan
    if math.isinf(t):
        return 0.0
    return incomplete_beta(dof / 2.0, 0.5, dof / (dof + t * t))


def chi2_one_tail(x: float) -> float:
    """Upper tail of chi-square with one degree of freedom."""
    return math.erfc(math.sqrt(max(x, 0.0) / 2.0))


def one_sample_t(values) -> tuple[float, float]:
    """Statistic and two-sided p of a t test of the mean against zero."""
    n = len(values)
    if n < 2:
        return math.nan, math.nan
    mean = sum(values) / n
    var = sum((v - mean) ** 2 for v in values) / (n - 1)
    if var == 0.0:
        return (math.nan, math.nan) if mean == 0.0 else (math.copysign(math.inf, mean), 0.0)
    t = mean / math.sqrt(var / n)
    return t, t_two_sided(t, n - 1)
