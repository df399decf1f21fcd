"""Vector expressions on array columns, and a deterministic stand-in for an embedding model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector has no length; an error where sizes differ."""
    sizes = F.assert_true(F.size(a) == F.size(b), F.lit("vectors of different sizes"))
    n = norm(a) * norm(b)
    return F.when(sizes.isNull() & (n > 0), dot(a, b) / n).otherwise(F.lit(0.0))


def hash_embedding(x: Column, size: int = 8) -> Column:
    """`size` numbers from -1 to 1 out of the bytes of md5 (at most 16)."""
    digest = F.md5(F.coalesce(x, F.lit("")).cast("binary"))
    byte = lambda i: F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("double")
    return F.array(*[byte(i) / 255 * 2 - 1 for i in range(size)])
