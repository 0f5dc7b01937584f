"""Vector functions as column expressions; sums in double precision.

Nulls give null.  Vectors of different length give null too (their zip has nulls).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "dotproduct", "euclidean")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    return F.sqrt(_sum(F.transform(a, lambda x: x.cast("double") * x.cast("double"))))


def normalised(a: Column) -> Column:
    """Length 1; an all-zero vector stays as it is."""
    n = norm(a)
    return F.transform(a, lambda x: x.cast("double") / F.when(n == 0, 1.0).otherwise(n))


def cosine(a: Column, b: Column) -> Column:
    """0 where a side is all zero."""
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n)


def squared_distance(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))))


def score(metric: str, a: Column, b: Column) -> Column:
    """Higher is better for every metric: the squared distance is negated."""
    if metric == "cosine":
        return cosine(a, b)
    if metric == "dotproduct":
        return dot(a, b)
    if metric == "euclidean":
        return -squared_distance(a, b)
    raise ValueError(f"unknown metric {metric!r}; one of {METRICS}")


def literal(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
