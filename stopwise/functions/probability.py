"""Percentile arrays as distributions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from stopwise.config import FALLBACK_RATE, KS_TERMS


def exponential_percentiles(rate: float = FALLBACK_RATE) -> Column:
    """101 percentiles of an exponential distribution, as a constant; the last one is infinite."""
    if rate <= 0:
        raise ValueError("the rate must be positive")
    finite = [-math.log1p(-p / 100) / rate + 0.0 for p in range(100)]
    return F.array(*[F.lit(v) for v in [*finite, math.inf]])


def probability_below(value: Column, percentiles: Column) -> Column:
    """P(X < value), linear between the 101 percentiles."""

    def interpolate(at_most: Column) -> Column:
        below, above = F.get(percentiles, at_most - 1), F.get(percentiles, at_most)
        return (
            F.when(value <= F.get(percentiles, F.lit(0)), F.lit(0.0))
            .when(value >= F.get(percentiles, F.lit(100)), F.lit(1.0))
            .otherwise((at_most - 1 + (value - below) / (above - below)) / 100)
        )

    # The one-element array has the position looked up once.
    at_most = F.array(F.size(F.filter(percentiles, lambda x: x <= value)))
    return F.get(F.transform(at_most, interpolate), F.lit(0))


def kolmogorov_p_value(statistic: Column, n1: Column, n2: Column, terms: int = KS_TERMS) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value."""
    scaled = statistic * F.sqrt(n1 * n2 / (n1 + n2))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2 * j * j * scaled * scaled),
    )
    # The alternating series needs many terms near zero, where the value is 1 to 50 digits.
    return F.when(scaled < 0.1, F.lit(1.0)).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))


def exact_two_sample(n1: int, n2: int, gap: int) -> float:
    """Probability that samples of ``n1`` and ``n2`` values of one distribution have a largest |i * n2 - j * n1| of ``gap`` or more.

    All orders of the values are equally likely, so it is that of a lattice path from (0, 0) to (n1, n2) that touches
    such a point. The share of paths to (i, j) that have touched one follows from those of (i - 1, j) and (i, j - 1); all terms are
    positive, so small values keep their digits.
    """
    import numpy as np

    if gap <= 0:
        return 1.0
    i = np.arange(n1 + 1)
    touched = np.zeros(n1 + 1)
    for s in range(1, n1 + n2 + 1):
        low, high = max(0, s - n2), min(s, n1)
        at = i[low : high + 1]
        before = np.concatenate(([0.0], touched))[low : high + 1]
        following = at / s * before + (s - at) / s * touched[low : high + 1]
        following[np.abs(at * n2 - (s - at) * n1) >= gap] = 1.0
        touched = np.zeros(n1 + 1)
        touched[low : high + 1] = following
    return float(min(touched[n1], 1.0))


def error_bounds(probability: Column, error: Column, lengths: Column) -> Column:
    """Expected, lowest and highest product of ``n`` equal probabilities known up to ``error``."""
    return F.struct(
        F.pow(probability, lengths).alias("expected"),
        F.pow(probability - error, lengths).alias("lowest"),
        F.pow(probability + error, lengths).alias("highest"),
    )
