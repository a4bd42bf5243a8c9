"""The driver's tables in the roles of the engine's own, and the same views in SQL.

Purchases are the left stream, the other event types the right ones; users are devices, event ids sequence numbers.
Events are sparse (one in minutes), so the fusion window is five minutes instead of half a second.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.fusion import nearest_in_order, prepare_left, prepare_right
from eventloom.sources.files import events, table

WINDOW_MS = 300_000
LEFT, RIGHTS = "purchase", ("click", "view", "error", "signup")

#: e: events with floored epoch ms. DuckDB's epoch_ms rounds, so the SQL divides microseconds.
E = "e AS (SELECT event_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS ms, ts, user_id, event_type, value, props FROM events)"
FUSED = E + """,
    a AS (SELECT event_id AS aid, ms AS a_ms FROM e WHERE event_type = 'purchase'),
    s AS (SELECT event_id AS sid, ms AS s_ms, event_type AS sensor_type FROM e WHERE event_type IN ('click', 'view', 'error', 'signup')),
    pairs AS (SELECT aid, a_ms, sid, s_ms, sensor_type, abs(s_ms - a_ms) AS abs_dt FROM a JOIN s ON s_ms BETWEEN a_ms - 300000 AND a_ms + 300000),
    fused AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY aid, a_ms ORDER BY abs_dt, s_ms, sid) = 1)"""
#: scored: every event as a row with latency, loss, label (null, 0 or 1) and risk.
SCORED = E + """,
    scored AS (SELECT CAST(event_id AS VARCHAR) AS fused_event_id, event_id, ms AS timestamp_ms, ts, event_type AS sensor_type, user_id, value AS latency_ms, CAST(user_id % 10 AS DOUBLE) AS data_loss_pct,
        CASE event_type WHEN 'error' THEN 1 WHEN 'view' THEN NULL ELSE 0 END AS anomaly_label, round(least(value / 200, 1.0), 6) AS risk_score FROM e)"""
ALERTS = SCORED + """,
    alerts AS (SELECT fused_event_id, timestamp_ms, sensor_type AS source_type, 1 AS anomaly_label, risk_score, CASE user_id % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'reviewed' ELSE 'closed' END AS status,
        timestamp_ms + 1000 * (user_id % 50) AS status_updated_at FROM scored)"""
STATUS = E + """,
    beats AS (SELECT ts AS time, event_type AS source_type, event_id, CAST(event_id % 30 AS DOUBLE) AS data_loss, value * 40 AS latency, 1.0 AS contribution_weight,
        CAST(greatest(0, trunc(100 - event_id % 30 - CASE WHEN value * 40 > 500 THEN (value * 40 - 500) / 100.0 ELSE 0 END)) AS INTEGER) AS quality_score FROM e),
    status AS (SELECT *, CASE WHEN quality_score >= 80 THEN 'ok' WHEN quality_score >= 50 THEN 'degraded' ELSE 'critical' END AS status FROM beats)"""


def sides(spark: SparkSession, sf: str) -> tuple[DataFrame, list[DataFrame]]:
    e = events(spark, sf)
    left = prepare_left(e.where(F.col("event_type") == LEFT), "event_id", "ms", WINDOW_MS)
    right = prepare_right(e.where(F.col("event_type").isin(*RIGHTS)), "event_id", "ms", F.col("event_type"), WINDOW_MS)
    return left, [right]


def rows_of_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(aid, a_ms) and (sid, s_ms, sensor_type), without buckets."""
    e = events(spark, sf)
    left = e.where(F.col("event_type") == LEFT).select(F.col("event_id").alias("aid"), F.col("ms").alias("a_ms"))
    right = e.where(F.col("event_type").isin(*RIGHTS)).select(F.col("event_id").alias("sid"), F.col("ms").alias("s_ms"), F.col("event_type").alias("sensor_type"))
    return left, right


def fused(spark: SparkSession, sf: str) -> DataFrame:
    """Nearest matches in linear work: pairs grow with the square of the rows, and none are made. Left rows that repeat count once."""
    left, right = rows_of_sides(spark, sf)
    return nearest_in_order(left.distinct(), right, WINDOW_MS)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return events(spark, sf).select(
        F.col("event_id").cast("string").alias("fused_event_id"), "event_id", F.col("ms").alias("timestamp_ms"), "ts", kind.alias("sensor_type"), "user_id", F.col("value").alias("latency_ms"), (F.col("user_id") % 10).cast("double").alias("data_loss_pct"),
        F.when(kind == "error", 1).when(kind != "view", 0).alias("anomaly_label"), F.round(F.least(F.col("value") / 200, F.lit(1.0)), 6).alias("risk_score"),
    )


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    turn = F.col("user_id") % 3
    return scored(spark, sf).select(
        "fused_event_id", "timestamp_ms", F.col("sensor_type").alias("source_type"), F.lit(1).alias("anomaly_label"), "risk_score", F.when(turn == 0, "active").when(turn == 1, "reviewed").otherwise("closed").alias("status"),
        (F.col("timestamp_ms") + 1000 * (F.col("user_id") % 50)).alias("status_updated_at"),
    )


def status(spark: SparkSession, sf: str) -> DataFrame:
    from eventloom.functions.scalars import quality_score, quality_status

    e = events(spark, sf)
    loss, latency = (F.col("event_id") % 30).cast("double"), F.col("value") * 40
    return e.select(F.col("ts").alias("time"), F.col("event_type").alias("source_type"), "event_id", loss.alias("data_loss"), latency.alias("latency"), F.lit(1.0).alias("contribution_weight"), quality_score(loss, latency).alias("quality_score")).withColumn("status", quality_status(F.col("quality_score")))


def radar_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The events as readings of a radar: five features from values and ids; errors of high value stand far off and count as anomalies."""
    e = events(spark, sf)
    odd = (F.col("event_type") == "error") & (F.col("value") > 60)
    draw = lambda k: F.pmod(F.xxhash64("event_id", F.lit(k)), F.lit(1000)) / 1000.0
    return e.select(
        F.col("event_id").cast("string").alias("event_id"), F.col("event_id").alias("n"), F.lit("RADAR").alias("sensor_type"), F.col("ms").alias("timestamp_ms"), odd.cast("int").alias("label"), F.when(odd, "error").alias("anomaly_type"),
        (F.lit(1000.0) + draw(1) * 500 + F.when(odd, F.col("value") * 40).otherwise(0.0)).alias("range_m"), (draw(2) * 360).alias("bearing_deg"), (draw(3) * 60 - 30).alias("elevation_deg"),
        (draw(4) * 100 + F.when(odd, 400.0).otherwise(0.0)).alias("velocity_ms"), (draw(5) * -40 - 30).alias("signal_strength_db"),
    )


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders")
