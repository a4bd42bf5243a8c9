"""Sorted heads, pages and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDERS = {"time_desc": ("timestamp_ms", "risk_score"), "risk_desc": ("risk_score", "timestamp_ms")}


def recent(df: DataFrame, order: str = "time_desc", limit: int = 20, tie: str = "fused_event_id") -> DataFrame:
    """The first rows by time or risk, the other as tiebreak, then the id; limit is held between 1 and 200."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in ORDERS[order]], tie).limit(max(1, min(200, limit)))


def page(df: DataFrame, number: int = 1, size: int = 25, order: str = "risk_desc", tie: str = "fused_event_id") -> tuple[DataFrame, DataFrame]:
    """Rows of a page, and (page, total, total_pages)."""
    rows = df.orderBy(*[F.col(c).desc_nulls_last() for c in ORDERS[order]], tie).offset((number - 1) * size).limit(size)
    totals = df.agg(F.count(F.lit(1)).alias("total")).select(F.lit(number).alias("page"), "total", F.ceil(F.col("total") / size).alias("total_pages"))
    return rows, totals


def top_features(shap: str, n: int = 3):
    """The n entries of an array of {feature, shap_value, direction} with the largest absolute value."""
    bigger = lambda a, b: F.when(F.abs(a["shap_value"]) > F.abs(b["shap_value"]), -1).when(F.abs(a["shap_value"]) < F.abs(b["shap_value"]), 1).otherwise(0)
    return F.slice(F.array_sort(shap, bigger), 1, n)


def strata_left(whole: DataFrame, part: DataFrame, by: str) -> DataFrame:
    """Counts of each stratum of whole that part doesn't take."""
    a = whole.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    b = part.groupBy(F.col(by).alias("__by")).agg(F.count(F.lit(1)).alias("m"))
    return a.join(b, F.col(by) == F.col("__by"), "left").select(by, (F.col("n") - F.coalesce("m", F.lit(0))).alias("n")).where("n > 0")


def pooled(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        one = df.withColumn("stream", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out
