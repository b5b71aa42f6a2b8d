"""Array-of-double expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def squared_distance(a: Column, b: Column) -> Column:
    parts = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(parts, F.lit(0.0), lambda total, p: total + p)


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two equally long arrays."""
    return F.sqrt(squared_distance(a, b))


def zero_vector(size: int) -> Column:
    return F.array_repeat(F.lit(0.0), size)
