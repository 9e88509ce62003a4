"""Column functions on vectors kept as arrays of floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product in double precision."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalize(a: Column) -> Column:
    """To length 1; a zero vector stays."""
    n = norm(a)
    return F.transform(a, lambda x: (x / F.when(n == 0, F.lit(1.0)).otherwise(n)).cast("float"))


def is_unit(a: Column) -> Column:
    return F.abs(norm(a) - 1) <= 1e-3 + 1e-5
