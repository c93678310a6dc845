"""Tail probabilities on a handful of driver scalars: normal, Student t, chi-square, exact rank-sum."""

from __future__ import annotations

import math

import numpy as np


def normal_two_sided(z: float) -> float:
    return min(1.0, math.erfc(abs(z) / math.sqrt(2.0)))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            h *= step
        if abs(step - 1.0) < 1e-15:
            break
    return h


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def student_two_sided(t: float, freedom: float) -> float:
    return incomplete_beta(freedom / 2.0, 0.5, freedom / (freedom + t * t))


def correlation_p(r: float | None, n: int) -> float | None:
    """Two-sided p of a correlation over n pairs."""
    if r is None or n < 3 or math.isnan(r):
        return None
    if abs(r) >= 1.0:
        return 0.0
    return student_two_sided(r * math.sqrt((n - 2) / (1.0 - r * r)), n - 2)


def chi_square_tail(x: float, freedom: float) -> float:
    """Upper regularized incomplete gamma Q(freedom / 2, x / 2)."""
    a, x = freedom / 2.0, x / 2.0
    if x <= 0.0:
        return 1.0
    front = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1.0
            term *= x / k
            total += term
        return 1.0 - total * front
    tiny = 1e-300
    b = x + 1.0 - a
    c, d = 1.0 / tiny, 1.0 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2.0
        d = 1.0 / (an * d + b or tiny)
        c = b + an / c or tiny
        h *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return front * h


def exact_rank_sum_p(u: float, n1: int, n2: int) -> float:
    """Two-sided p of U without ties, by counting arrangements (small samples only)."""
    small, large = sorted((n1, n2))
    # arrangements of `small` ranks by their U value, one large-sample member at a time
    counts = np.zeros((small + 1, small * large + 1))
    counts[0, 0] = 1.0
    for size in range(1, small + large + 1):
        for k in range(min(size, small), 0, -1):
            shift = size - k
            if shift <= large:
                moved = np.zeros(small * large + 1)
                moved[shift:] = counts[k - 1, : small * large + 1 - shift]
                counts[k] += moved
    weights = counts[small]
    top = math.ceil(max(u, n1 * n2 - u) - 1e-9)
    return min(1.0, 2.0 * float(weights[top:].sum() / weights.sum()))
