"""Queries: what the service sends, exports and says of its health, and reports on detectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import rollups as r
from eventloom.operators.sinks import write_csv
from eventloom.sources.files import events
from eventloom.storage import fresh_path

from . import dashboard as d
from . import views as v
from .views import ALERTS, E, SCORED, STATUS

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


# JSON texts are compared field by field: engines write numbers differently.
def parts(df, schema: str):
    return df.select(F.from_json("value", schema).alias("r"), F.array_join(F.array_sort(F.json_object_keys("value")), ",").alias("keys")).select("r.*", "keys")


@query("api_ws_stream", f"""WITH {SCORED} SELECT fused_event_id AS event_id, timestamp_ms, sensor_type AS source_type, anomaly_label, CASE WHEN user_id % 3 <> 0 THEN risk_score END AS risk_score, latency_ms,
    array_to_string(list_sort(list_filter(['event_id', 'timestamp_ms', 'source_type', CASE WHEN anomaly_label IS NOT NULL THEN 'anomaly_label' END, CASE WHEN user_id % 3 <> 0 THEN 'risk_score' END, 'quality_flag', 'latency_ms', 'data_loss_pct'], lambda x: x IS NOT NULL)), ',') AS keys FROM scored""")
def _(spark, sf):
    rows = v.scored(spark, sf).withColumns({"event_id": F.col("fused_event_id"), "source_type": F.col("sensor_type"), "risk_score": F.when(F.col("user_id") % 3 != 0, F.col("risk_score")), "quality_flag": F.lit("ok")})
    return parts(d.socket_events(rows), "event_id string, timestamp_ms long, source_type string, anomaly_label int, risk_score double, latency_ms double")


@query("api_ws_fusion", f"WITH {STATUS} SELECT source_type, quality_score, contribution_weight, data_loss AS data_loss_pct, latency AS latency_ms, CASE status WHEN 'ok' THEN 'online' WHEN 'critical' THEN 'offline' ELSE status END AS status, 'contribution_weight,data_loss_pct,latency_ms,quality_score,source_type,status' AS keys FROM status")
def _(spark, sf):
    return parts(d.socket_fusion(v.status(spark, sf)), "source_type string, quality_score int, contribution_weight double, data_loss_pct double, latency_ms double, status string")


@query("api_export", f"""WITH {ALERTS}, n AS (SELECT fused_event_id, CASE WHEN CAST(fused_event_id AS BIGINT) % 4 = 0 THEN NULL WHEN CAST(fused_event_id AS BIGINT) % 4 = 1 THEN '' ELSE source_type || ', "' || status || '"' END AS note FROM alerts WHERE risk_score >= 0.2)
    SELECT fused_event_id || ',' || coalesce('"' || replace(note, '"', '""') || '"', '') AS line FROM n""")
def _(spark, sf):
    # The lines of the export's CSV: null is nothing at all, an empty text two quotes, quotes are doubled.
    n = F.col("fused_event_id").cast("bigint")
    note = F.when(n % 4 == 0, None).when(n % 4 == 1, "").otherwise(F.concat("source_type", F.lit(', "'), "status", F.lit('"')))
    path = fresh_path(spark, "export")
    write_csv(d.filtered(v.alerts(spark, sf), min_risk=0.2).select("fused_event_id", note.alias("note")), path)
    return spark.read.text(path).where("value != 'fused_event_id,note'").select(F.col("value").alias("line"))


@query("api_snapshot_lookup", f"""WITH {ALERTS}, made AS (SELECT fused_event_id AS snapshot_id, sha256(source_type || '|' || status) AS filter_hash, timestamp_ms + 86400000 AS expires_at_ms FROM alerts WHERE CAST(fused_event_id AS BIGINT) % 50 = 0),
    live AS (SELECT filter_hash, max_by(snapshot_id, (expires_at_ms, snapshot_id)) AS snapshot_id FROM made WHERE expires_at_ms > (SELECT max(timestamp_ms) FROM alerts) GROUP BY 1), asked AS (SELECT DISTINCT source_type, status FROM alerts)
    SELECT source_type, status, snapshot_id FROM asked LEFT JOIN live ON filter_hash = sha256(source_type || '|' || status)""")
def _(spark, sf):
    alerts = v.alerts(spark, sf)
    made = d.snapshot_key(alerts.where(F.col("fused_event_id").cast("bigint") % 50 == 0).withColumn("created_ms", F.col("timestamp_ms")), "source_type", "status").withColumn("snapshot_id", F.col("fused_event_id"))
    now = alerts.agg(F.max("timestamp_ms")).first()[0] or 0
    return d.snapshot_lookup(made, alerts.select("source_type", "status").distinct(), now, "source_type", "status").select("source_type", "status", "snapshot_id")


HEALTH = f"""{SCORED}, t AS (SELECT max(timestamp_ms) + 30000 AS now FROM scored), u AS (SELECT 'ok' AS db, 'ok' AS kafka, (SELECT now FROM t) - max(timestamp_ms) AS kafka_lag_ms, CASE WHEN max(timestamp_ms) FILTER (WHERE sensor_type = 'error') > (SELECT now FROM t) - 60000 THEN 'ok' ELSE 'error' END AS spark,
    count_if(timestamp_ms > (SELECT now FROM t) - 60000) / 60.0 AS spark_throughput_evt_sec, 'ok' AS ai_model FROM scored)"""


def upstream(spark, sf):
    rows = v.scored(spark, sf)
    now = (rows.agg(F.max("timestamp_ms")).first()[0] or 0) + 30_000
    return d.upstream_health(rows, rows.where("sensor_type = 'error'"), now)


@query("api_health_upstream", f"WITH {HEALTH} SELECT db, kafka, kafka_lag_ms, spark, round(CAST(spark_throughput_evt_sec AS DOUBLE), 6) AS spark_throughput_evt_sec, ai_model FROM u")
def _(spark, sf):
    return upstream(spark, sf).withColumn("spark_throughput_evt_sec", F.round(F.col("spark_throughput_evt_sec").cast("double"), 6))


@query("api_health", f"WITH {HEALTH} SELECT CASE WHEN spark = 'ok' THEN 'healthy' ELSE 'degraded' END AS status, db, kafka, spark, ai_model FROM u")
def _(spark, sf):
    return d.health(upstream(spark, sf))


@query("evaluation_report", f"""WITH {E}, x AS (SELECT event_type AS stream, user_id % 5 = 0 AS truth, value AS s, value > 40 AS hit FROM e), y AS (SELECT * FROM x UNION ALL SELECT 'pooled', truth, s, hit FROM x),
    k AS (SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY stream, s) - 1) / 2.0 AS mid FROM y WINDOW w AS (PARTITION BY stream ORDER BY s))
    SELECT stream, round((sum(mid) FILTER (WHERE truth) - count_if(truth) * (count_if(truth) + 1) / 2.0) / (count_if(truth) * count_if(NOT truth)), 9) AS auc, round(count_if(NOT truth AND hit) / count_if(NOT truth), 9) AS fpr, round(count_if(truth AND hit) / count_if(truth), 9) AS recall,
    round(count_if(truth AND hit) / count_if(hit), 9) AS precision, count(*) AS n_test, CAST(count_if(truth) AS BIGINT) AS n_anomalies FROM k GROUP BY 1""")
def _(spark, sf):
    rows = events(spark, sf).withColumn("stream", F.col("event_type"))
    out = r.evaluation(rows, F.col("user_id") % 5 == 0, F.col("value") > 40, "value", "stream")
    return out.select("stream", *[F.round(c, 9).alias(c) for c in ("auc", "fpr", "recall", "precision")], "n_test", "n_anomalies")


@query("detector_variants_rules", f"""WITH {E}, t AS (SELECT user_id % 2 = 0 AS truth, user_id % 11 = 0 AS rule, round(1 - 1 / (1 + value), 4) AS f, round(1 - 1 / (1 + value * (1 + user_id % 3)), 4) AS z FROM e), x AS (
    SELECT 'forest' AS variant, truth, f >= 0.99 OR rule AS hit FROM t UNION ALL SELECT 'baseline', truth, z >= 0.99 OR rule FROM t UNION ALL SELECT 'forest_no_rules', truth, f >= 0.99 FROM t UNION ALL SELECT 'baseline_no_rules', truth, z >= 0.99 FROM t
    UNION ALL SELECT 'either', truth, greatest(f, z) >= 0.99 OR rule FROM t UNION ALL SELECT 'either_half_budget', truth, greatest(f, z) >= 0.995 OR rule FROM t)
    SELECT variant, round(count_if(NOT truth AND hit) / count_if(NOT truth), 6) AS fpr, round(count_if(truth AND hit) / count_if(truth), 6) AS recall, round(coalesce(count_if(truth AND hit) / nullif(count_if(hit), 0), 0), 6) AS precision FROM x GROUP BY 1""")
def _(spark, sf):
    u, x = F.col("user_id"), F.col("value")
    rows = events(spark, sf).select("user_id", F.round(1 - 1 / (1 + x), 4).alias("f"), F.round(1 - 1 / (1 + x * (1 + u % 3)), 4).alias("z"))
    out = r.variants(rows, u % 2 == 0, {"forest": "f", "baseline": "z"}, u % 11 == 0)
    return out.select("variant", *[F.round(c, 6).alias(c) for c in ("fpr", "recall", "precision")])
