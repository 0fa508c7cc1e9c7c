"""Arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def centred(a: Column) -> Column:
    mean = total(a) / F.size(a)
    return F.transform(a, lambda x: x - mean)


def unit(a: Column) -> Column:
    """Vector over its length; a zero vector gives null."""
    length = norm(a)
    return F.when(length > 0, F.transform(a, lambda x: x / length))


def sim_euclid(a: Column, b: Column) -> Column:
    diff = F.zip_with(a, b, lambda x, y: x - y)
    return 1 / (1 + norm(diff))


def sim_cosine(a: Column, b: Column) -> Column:
    return 0.5 + 0.5 * F.try_divide(dot(a, b), norm(a) * norm(b))


def sim_pearson(a: Column, b: Column) -> Column:
    """1 for vectors of fewer than three values."""
    x, y = centred(a), centred(b)
    return F.when(F.size(a) < 3, 1.0).otherwise(0.5 + 0.5 * F.try_divide(dot(x, y), norm(x) * norm(y)))
