"""Vector arithmetic on array columns, evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def as_doubles(values: Column) -> Column:
    return values.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(
        total(F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y)))
    )


def cosine(a: Column, b: Column) -> Column:
    """Cosine; 0 when either vector has no length."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(0.0)).otherwise(dot(a, b) / size)


def product(a: Column, b: Column) -> Column:
    """Slot-wise product."""
    return F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: x * y)


def subtract(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def scale(a: Column, factor: Column) -> Column:
    return F.transform(a, lambda x: x * factor)


def literal(values: Sequence[float]) -> Column:
    """A constant vector, sent to the JVM as one piece of text."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def nan_to_zero(a: Column) -> Column:
    return F.transform(a, lambda x: F.when(F.isnan(x) | x.isNull(), F.lit(0.0)).otherwise(x))
