"""Vectors of floats as exact integers, which the vector operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chosen

#: Components of this size and more are an error: products of their integers, summed up, might not fit a long.
LARGEST = 1 << 20


def whole_vectors(df: DataFrame, vec_id: str, vector: str, scale: int = 64) -> DataFrame:
    """(vec_id long, q array<bigint>): floor(scale * x) of each component, taken as a double.

    Vectors that are null or hold a null or non-finite component are left out; an empty vector stays. Other columns may
    have any names. A component of 2^20 or more in absolute value is an error.
    """
    near = lambda x: F.abs(x) < LARGEST
    of = F.col("v").cast("array<double>")
    finite = F.forall(of, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    kept = chosen(df, vec_id=vec_id, v=vector).where(F.col("v").isNotNull() & finite)
    q = F.transform(of, lambda x: F.when(near(x), F.floor(x * scale)).otherwise(F.raise_error(F.lit("a component of 2^20 or more"))))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"))
