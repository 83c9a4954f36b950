"""Vector expressions over ``array<float>`` columns, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(
        F.transform(_col(a), lambda x: x.cast("double") * x.cast("double")),
        F.lit(0.0).cast("double"), lambda acc, v: acc + v))


def cosine(a, b, norm_a=None, norm_b=None) -> Column:
    """Cosine similarity (C6); null when a norm is zero (no ANSI error)."""
    na = _col(norm_a) if norm_a is not None else norm(a)
    nb = _col(norm_b) if norm_b is not None else norm(b)
    return F.try_divide(dot(a, b), na * nb)


def unit(a) -> Column:
    """Vector divided by its norm; zero vectors stay zero."""
    n = norm(a)
    return F.transform(_col(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))
