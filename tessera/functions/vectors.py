"""Expressions over array<float> vectors."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Added to norms before division.
EPSILON = 1e-8


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, clamp: bool = False) -> Column:
    """Cosine of two vectors; null if their lengths differ. clamp: within 0 and 1."""
    value = dot(a, b) / ((norm(a) + EPSILON) * (norm(b) + EPSILON))
    value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)) if clamp else value
    return F.when(F.size(a) == F.size(b), value)


def unit(a: Column) -> Column:
    """a scaled to length one."""
    return F.transform(a, lambda x: (x / (norm(a) + EPSILON)).cast("float"))
