"""Vector column expressions (JVM-side higher-order functions, in double)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v) -> Column:
    """Cast an array<float> to array<double> so that products are exact in double."""
    return _c(v).cast("array<double>")


def dot(a, b) -> Column:
    """Inner product of two equal-length arrays, summed left to right."""
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(v) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(v) -> Column:
    """Unit-length copy of a vector (the batch path normalises before the inner product)."""
    n = norm(v)
    return F.transform(as_double(v), lambda x: x / n)


def cosine(a, b) -> Column:
    """Cosine similarity: divides by both norms."""
    return dot(a, b) / (norm(a) * norm(b))

