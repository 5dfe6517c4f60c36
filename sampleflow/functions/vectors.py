"""Column expressions on arrays of floats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_similarity(a: Column | str, b: Column | str) -> Column:
    """Cosine of two vectors, in double precision; 0 if either has no length.

    Null if either is null; vectors of different sizes are an error.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    cosine = F.when(norms == 0, F.lit(0.0)).otherwise(_dot(a, b) / norms)
    sizes = F.concat_ws(" and ", F.size(a).cast("string"), F.size(b).cast("string"))
    uneven = F.raise_error(F.concat(F.lit("vectors of different sizes: "), sizes)).cast("double")
    return F.when(a.isNotNull() & b.isNotNull(), F.when(F.size(a) != F.size(b), uneven).otherwise(cosine))
