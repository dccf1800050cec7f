"""Column expressions over dense ``array<double>`` vectors and over small item arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(vector: Column) -> Column:
    """Widen an ``array<float>`` so sums are taken in double precision."""
    return vector.cast("array<double>")


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(vector: Column) -> Column:
    return F.sqrt(total(F.transform(vector, lambda x: x * x)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def unit(vector: Column) -> Column:
    """The vector scaled to length one; null for a zero vector."""
    length = norm(vector)
    return F.when(length > 0, F.transform(vector, lambda x: x / length))


def jaccard(a: Column, b: Column) -> Column:
    """Shared values over all distinct values of two arrays."""
    return F.try_divide(
        F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b)).cast("double")
    )


def jaccard_multiset(a: Column, b: Column) -> Column:
    """Shared values counted with repeats, over the sum of both array sizes."""

    def times(values: Column, wanted: Column) -> Column:
        return F.size(F.filter(values, lambda x: x == wanted))

    shared = F.aggregate(
        F.array_distinct(a),
        F.lit(0),
        lambda acc, v: acc + F.least(times(a, v), times(b, v)),
    )
    return F.try_divide(shared.cast("double"), (F.size(a) + F.size(b)).cast("double"))
