"""Scalar expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def time_bucket(ms: Column, width_ms: int) -> Column:
    """Start of the bucket of an epoch in ms; floors below zero too."""
    return ms - F.pmod(ms, F.lit(width_ms))


def event_time(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def event_ms(ts: Column) -> Column:
    """Epoch in ms, floored; time stamps without a zone count as UTC."""
    return F.unix_millis(ts.cast("timestamp"))


def float32(x: Column) -> Column:
    return x.cast("float")


def float32_finite(x: Column) -> Column:
    """Null-safe: whether x fits a 32-bit float and isn't NaN."""
    small = x.cast("float")
    return x.isNull() | (~F.isnan(small) & (F.abs(small) != F.lit(float("inf"))))


def is_uuid(x: Column) -> Column:
    """32 hex digits after urn:, uuid:, braces and hyphens are taken off, of whatever version; null is none."""
    bare = F.regexp_replace(F.regexp_replace(x, "urn:|uuid:", ""), "[{}-]", "")
    return F.coalesce(bare.rlike("^[0-9a-fA-F]{32}$"), F.lit(False))


def clip01(x: Column) -> Column:
    return F.greatest(F.least(x, F.lit(1.0)), F.lit(0.0))


def nearest_rank(values: Column, p: float) -> Column:
    """Element at round-half-even(p * (n - 1)) of a sorted array; null if it is empty."""
    return F.get(values, F.bround(F.lit(p) * (F.size(values) - 1)).cast("int"))


def quality_score(loss_pct: Column, latency_ms: Column) -> Column:
    """100 less the loss, less a point for each 100 ms beyond 500; cut to an integer of 0 at least."""
    late = F.when(latency_ms > 500, (latency_ms - 500) / 100.0).otherwise(F.lit(0.0))
    return F.greatest(F.lit(0.0), F.lit(100.0) - loss_pct - late).cast("int")


def quality_status(score: Column) -> Column:
    return F.when(score >= 80, "ok").when(score >= 50, "degraded").otherwise("critical")


def quoted_csv(x: Column) -> Column:
    """A COPY field: null is nothing at all, anything else is quoted with quotes doubled."""
    return F.coalesce(F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))


def zoned_millis(text: Column) -> Column:
    """Epoch in ms of an ISO-8601 text that names its zone; null without one."""
    zone = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$")
    return F.when(zone, F.unix_millis(F.try_to_timestamp(text)))


def filter_hash(*filters: Column) -> Column:
    """Key of a report snapshot: SHA-256 of the filters, nulls told apart from empty text."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(f.cast("string"), F.lit("\x00")) for f in filters]), 256)
