"""Comparisons of two images that are array columns of the same length (SC10), and of their histograms.

The moments are one pass of JVM aggregation over each pair of arrays; nothing is exploded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(x: Column, f) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + f(v))


def _mean(x: Column) -> Column:
    return _sum(x, lambda v: v) / F.size(x)


def _let(x: Column, f) -> Column:
    return F.element_at(F.transform(F.array(x), f), 1)


def central_moment(x: Column, k: int) -> Column:
    """Mean of the k-th powers of the distances from the mean."""
    return _let(_mean(x), lambda m: _sum(x, lambda v: F.pow(v - m, F.lit(k))) / F.size(x))


def variance_ratio(a: Column, b: Column) -> Column:
    """Variance of b over that of a."""
    return central_moment(b, 2) / central_moment(a, 2)


def skewness(x: Column) -> Column:
    return central_moment(x, 3) / F.pow(central_moment(x, 2), F.lit(1.5))


def kurtosis(x: Column) -> Column:
    """Excess over the normal distribution."""
    return central_moment(x, 4) / F.pow(central_moment(x, 2), F.lit(2)) - 3


def skew_ratio(a: Column, b: Column) -> Column:
    return skewness(b) / skewness(a)


def kurtosis_ratio(a: Column, b: Column) -> Column:
    return kurtosis(b) / kurtosis(a)


def pearson(a: Column, b: Column) -> Column:
    """Correlation pixel by pixel."""
    both = F.arrays_zip(a.alias("a"), b.alias("b"))
    cross = _let(_mean(a), lambda m: _let(_mean(b), lambda n: F.aggregate(both, F.lit(0.0), lambda s, p: s + (p["a"] - m) * (p["b"] - n)) / F.size(a)))
    return cross / F.sqrt(central_moment(a, 2) * central_moment(b, 2))


def manders(a: Column, b: Column) -> Column:
    """Overlap of intensities."""
    both = F.zip_with(a, b, lambda x, y: x * y)
    return _sum(both, lambda v: v) / F.sqrt(_sum(a, lambda v: v * v) * _sum(b, lambda v: v * v))


def divergence(p: Column, q: Column) -> Column:
    """Kullback-Leibler divergence in bits of two histograms, over bins that neither has empty; 0 for none."""
    terms = F.zip_with(p, q, lambda x, y: F.when((x != 0) & (y != 0), x * F.log2(x / y)).otherwise(0.0))
    return _sum(terms, lambda v: v)


def value_range(x: Column) -> Column:
    return F.array_max(x) - F.array_min(x)
