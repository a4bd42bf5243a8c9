"""Views that dashboards and reports ask for. These follow a written contract only; no running code stands behind it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.scalars import filter_hash
from eventloom.operators.windows import latest

#: Fixed values of the contract.
THRESHOLDS = {"latency_p95_ms": 500.0, "data_loss_pct": 1.0, "time_sync_ms": 1.0, "throughput_min": 10000.0, "model_auc_min": 0.85, "false_positive_max": 0.05}
CRITICAL_RISK = 0.7
SNAPSHOT_HOURS = 24
#: Heartbeats say ok, degraded, critical; the contract's names differ.
ONLINE = {"ok": "online", "degraded": "degraded", "critical": "offline"}


def critical() -> Column:
    return (F.col("risk_score") > CRITICAL_RISK) & (F.col("status") == "active")


def sensors(status: DataFrame, window_ms: int = 500) -> DataFrame:
    """The last heartbeat of each source, in the contract's names."""
    named = F.coalesce(*[F.when(F.col("status") == k, v) for k, v in ONLINE.items()], F.col("status"))
    return latest(status, "source_type", "time").select("source_type", "quality_score", "contribution_weight", F.col("data_loss").alias("data_loss_pct"), F.col("latency").alias("latency_ms"), named.alias("status"), F.lit(window_ms).alias("fusion_window_ms"))


def summary(rollup: DataFrame, status: DataFrame) -> DataFrame:
    """The last bucket's counts and risks, and how many sources are online."""
    last = rollup.orderBy(F.desc("bucket")).limit(1)
    online = sensors(status).agg(F.count_if(F.col("status") == "online").alias("active_sensors"))
    return last.crossJoin(online).select("active_sensors", F.col("total_fused_events").alias("total_events_5m"), F.col("anomaly_count").alias("anomaly_count_5m"), "avg_risk_score", "max_risk_score", F.col("bucket").alias("last_updated_ms"), F.lit(30).alias("cagg_refresh_s"))


def stream_rate(df: DataFrame, ms: str, now_ms: int, seconds: int = 60) -> DataFrame:
    """Rows a second over the last seconds."""
    return df.where((F.col(ms) > now_ms - seconds * 1000) & (F.col(ms) <= now_ms)).agg((F.count(F.lit(1)) / seconds).alias("throughput_evt_sec"))


def stream_json(df: DataFrame, columns: list[str]) -> DataFrame:
    """One JSON text for each row; what is null is left out."""
    return df.select(F.to_json(F.struct(*columns)).alias("value"))


def filtered(df: DataFrame, start: int | None = None, end: int | None = None, source_type: str | None = None, status: str | None = None, min_risk: float | None = None) -> DataFrame:
    for given, keep in ((start, F.col("timestamp_ms") >= F.lit(start)), (end, F.col("timestamp_ms") <= F.lit(end)), (source_type, F.col("source_type") == F.lit(source_type)), (status, F.col("status") == F.lit(status)), (min_risk, F.col("risk_score") >= F.lit(min_risk))):
        df = df if given is None else df.where(keep)
    return df


def alert_counts(alerts: DataFrame, midnight_ms: int) -> DataFrame:
    return alerts.agg(
        F.count_if(F.col("status") == "active").alias("active_count"), F.count_if(critical()).alias("critical_count"), F.count_if((F.col("status") == "closed") & (F.col("status_updated_at") >= midnight_ms)).alias("closed_today")
    )


def explanation(alerts: DataFrame, explanations: DataFrame, fused_event_id: str | None = None) -> DataFrame:
    """Explanations with their alerts; none for an alert that has no explanation yet."""
    from eventloom.operators.ordering import top_features

    out = explanations.join(alerts.select("fused_event_id", "risk_score", "anomaly_label", "source_type", "timestamp_ms"), "fused_event_id").withColumn("top_features", top_features("shap_values"))
    return out if fused_event_id is None else out.where(F.col("fused_event_id") == fused_event_id)


def performance(perf: DataFrame, health: DataFrame) -> DataFrame:
    return perf.join(health, ["bucket", "source_type"])


def thresholds(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in THRESHOLDS.items()])


def report(alerts: DataFrame, fused: DataFrame, **filters) -> dict[str, DataFrame]:
    """Totals, the daily trend, anomalies by sensor and the ten riskiest events."""
    chosen = filtered(alerts, **filters)
    day = (F.col("timestamp_ms") - F.pmod(F.col("timestamp_ms"), F.lit(86_400_000))).alias("bucket_ms")
    totals = fused.agg(F.count(F.lit(1)).alias("total_events"), F.avg("latency_ms").alias("avg_latency_ms"), F.avg("data_loss_pct").alias("avg_data_loss_pct"))
    return {
        "summary": totals.crossJoin(chosen.agg(F.count(F.lit(1)).alias("total_anomalies"), F.avg("risk_score").alias("avg_risk_score"))),
        "anomaly_trend": chosen.groupBy(day).agg(F.count(F.lit(1)).alias("anomaly_count")), "sensor_performance": chosen.groupBy("source_type").agg(F.count(F.lit(1)).alias("anomaly_count")),
        "top_events": chosen.orderBy(F.desc("risk_score"), "fused_event_id").limit(10).select("fused_event_id", "risk_score"),
    }


def snapshot_key(df: DataFrame, *filters: str) -> DataFrame:
    """Key and expiry of a cached report: SHA-256 of its filters, a day from created_ms."""
    return df.withColumns({"filter_hash": filter_hash(*[F.col(c) for c in filters]), "expires_at_ms": F.col("created_ms") + SNAPSHOT_HOURS * 3_600_000})


def snapshot_lookup(snapshots: DataFrame, asked: DataFrame, now_ms: int, *filters: str) -> DataFrame:
    """For each request (its filters) the newest snapshot of the same filters that has not run out, or null: made anew then."""
    live = snapshots.where(F.col("expires_at_ms") > now_ms).groupBy("filter_hash").agg(F.max_by("snapshot_id", F.struct("expires_at_ms", "snapshot_id")).alias("snapshot_id"))
    return asked.withColumn("filter_hash", filter_hash(*[F.col(c) for c in filters])).join(live, "filter_hash", "left")


def socket_events(df: DataFrame) -> DataFrame:
    """Texts of the live table of events; a label or a risk that is null is left out."""
    return stream_json(df, ["event_id", "timestamp_ms", "source_type", "anomaly_label", "risk_score", "quality_flag", "latency_ms", "data_loss_pct"])


def socket_fusion(status: DataFrame) -> DataFrame:
    """Texts of heartbeats in the contract's names."""
    named = F.coalesce(*[F.when(F.col("status") == k, v) for k, v in ONLINE.items()], F.col("status")).alias("status")
    return stream_json(status.select("source_type", "quality_score", "contribution_weight", F.col("data_loss").alias("data_loss_pct"), F.col("latency").alias("latency_ms"), named), ["source_type", "quality_score", "contribution_weight", "data_loss_pct", "latency_ms", "status"])


def upstream_health(events: DataFrame, fused: DataFrame, now_ms: int, stale_ms: int = 60_000) -> DataFrame:
    """One row: what the tables say of each module. Events are the topic's, so their delay stands for its lag; nothing scored yet is warming."""
    rows = events.agg(F.max("timestamp_ms").alias("newest"), F.count_if(F.col("timestamp_ms") > now_ms - stale_ms).alias("recent"))
    scores = fused.agg(F.max("timestamp_ms").alias("fused_newest"), F.count(F.lit(1)).alias("n"), F.count("anomaly_label").alias("scored"))
    fresh = lambda c: F.when(F.col(c) > now_ms - stale_ms, "ok").otherwise("error")
    return rows.crossJoin(F.broadcast(scores)).select(  # two single rows
        F.lit("ok").alias("db"), fresh("newest").alias("kafka"), F.greatest(now_ms - F.col("newest"), F.lit(0)).alias("kafka_lag_ms"), fresh("fused_newest").alias("spark"), (F.col("recent") * 1000 / stale_ms).alias("spark_throughput_evt_sec"),
        F.when(F.col("n") == 0, "error").when(F.col("scored") == 0, "warming").otherwise("ok").alias("ai_model"),
    )


def health(upstream: DataFrame) -> DataFrame:
    """healthy if every module is ok, down without the database, degraded else."""
    ok = lambda c: F.col(c) == "ok"
    status = F.when(~ok("db"), "down").when(ok("kafka") & ok("spark") & ok("ai_model"), "healthy").otherwise("degraded")
    return upstream.select(status.alias("status"), "db", "kafka", "spark", "ai_model")
