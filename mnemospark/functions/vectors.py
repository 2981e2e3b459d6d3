"""Vector expressions on ``ARRAY<FLOAT>`` columns, for row-wise use."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

METRICS = ("cosine", "dotProduct", "euclidean")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column | str) -> Column:
    return F.sqrt(_sum(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double"))))


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Row-wise cosine; unequal widths raise, NaN and infinity become 0."""
    a, b = _c(a), _c(b)
    raw = F.try_divide(dot(a, b), norm(a) * norm(b))
    bad = raw.isNull() | F.isnan(raw) | (F.abs(raw) == F.lit(float("inf")))
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
            .when(F.size(a) != F.size(b), F.raise_error(F.lit("vector widths differ")).cast("double"))
            .when(bad, F.lit(0.0)).otherwise(raw))


def similarity(metric: str, a: Column | str, b: Column | str) -> Column:
    """Score in [0, 1] for unit vectors: cosine and dot as ``(1+s)/2``, distance as ``1/(1+d)``."""
    if metric == "cosine":
        return (F.lit(1.0) + cosine_similarity(a, b)) / 2
    if metric == "dotProduct":
        return (F.lit(1.0) + dot(a, b)) / 2
    if metric == "euclidean":
        squares = F.zip_with(_c(a), _c(b), lambda x, y: F.pow(x.cast("double") - y.cast("double"), F.lit(2)))
        return F.lit(1.0) / (F.lit(1.0) + F.sqrt(_sum(squares)))
    raise ValueError(f"metric must be one of {METRICS}")
