"""Queries: validation, detection, dashboards and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions.scalars import clip01, float32, is_uuid, quoted_csv, zoned_millis
from eventloom.operators import scoring as s
from eventloom.operators import validation as q
from eventloom.operators.forest import fit_forest, score_forest
from eventloom.operators.rollups import confusion, median_mad, roc_auc, value_stats
from eventloom.operators.sinks import fused_rows, heartbeats, patch_status, with_audit
from eventloom.operators.windows import ecdf_risk
from eventloom.schemas import SENSOR_EVENT
from eventloom.sources.files import events, table
from eventloom.sources import generators as g
from eventloom.sources.generators import ANOMALIES, generate, inject_lateness, numbered
from eventloom.storage import stored

from . import dashboard as d
from . import views as v
from .views import ALERTS, E, FUSED, SCORED, STATUS

QUERIES, ORACLES = {}, {}
NOW = 1_705_276_800_000


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


#: Events as radar rows, some of them broken on purpose by their id.
RADAR = """
    radar AS (SELECT event_id AS id, CASE WHEN event_id % 11 = 0 THEN 'not-a-uuid' ELSE lpad(CAST(event_id AS VARCHAR), 32, '0') END AS event_id, CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'R-01' END AS sensor_id,
        CASE WHEN event_id % 17 = 0 THEN 'SONAR' ELSE 'RADAR' END AS sensor_type, CASE WHEN event_id % 19 = 0 THEN -ms ELSE ms END AS timestamp_ms, CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 29 = 0 THEN '0.9' ELSE '1.0' END AS schema_version,
        CASE WHEN event_id % 31 = 0 THEN NULL ELSE 'T' END AS target_id, value - 20 AS range_m, value * 4 AS bearing_deg, value - 45 AS elevation_deg FROM e)"""


def radar(spark, sf):
    i = F.col("event_id")
    rows = events(spark, sf).select(
        i.alias("id"), F.when(i % 11 == 0, "not-a-uuid").otherwise(F.lpad(i.cast("string"), 32, "0")).alias("event_id"), F.when(i % 13 != 0, "R-01").alias("sensor_id"), F.when(i % 17 == 0, "SONAR").otherwise("RADAR").alias("sensor_type"),
        F.when(i % 19 == 0, -F.col("ms")).otherwise(F.col("ms")).alias("timestamp_ms"), F.when(i % 23 == 0, None).when(i % 29 == 0, "0.9").otherwise("1.0").alias("schema_version"), F.when(i % 31 != 0, "T").alias("target_id"),
        (F.col("value") - 20).alias("range_m"), (F.col("value") * 4).alias("bearing_deg"), (F.col("value") - 45).alias("elevation_deg"), F.lit(1.0).alias("velocity_ms"), F.lit(-50.0).alias("signal_strength_db"),
    )
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in SENSOR_EVENT if f.name not in rows.columns})


@query("staging_validation", f"""WITH {E}, {RADAR} SELECT id, CASE WHEN schema_version IS NULL OR schema_version <> '1.0' THEN 'schema_version must be ''1.0''' WHEN sensor_id IS NULL THEN 'required field missing or null: sensor_id'
    WHEN sensor_type = 'SONAR' THEN 'sensor_type not supported: SONAR' WHEN target_id IS NULL THEN 'required RADAR field missing or null: target_id' WHEN event_id = 'not-a-uuid' THEN 'event_id is not a valid UUID v4' WHEN timestamp_ms <= 0 THEN 'timestamp_ms must be a positive integer' END AS reason FROM radar""")
def _(spark, sf):
    return radar(spark, sf).select("id", q.staging_sensor().alias("reason"))


@query("staging_validation_physics", f"WITH {E} SELECT event_id AS id, CASE WHEN event_id % 7 = 0 THEN 'required field missing or null: run_number' WHEN event_id % 5 = 0 THEN 'event_id is not a valid UUID v4' END AS reason FROM e")
def _(spark, sf):
    i = F.col("event_id")
    rows = events(spark, sf).select(i.alias("id"), F.when(i % 5 == 0, "x").otherwise(F.concat(F.lit("urn:uuid:{"), F.lpad(i.cast("string"), 32, "a"), F.lit("}"))).alias("event_id"), F.when(i % 7 != 0, 1).alias("run_number"), F.col("ms").alias("timestamp_ms"), F.lit(1).alias("track_count"), *[F.lit(0.0).alias(c) for c in ("net_momentum_x", "net_momentum_y", "net_momentum_z", "max_energy_gev", "total_energy_gev")], F.lit("1.0").alias("schema_version"))
    return rows.select("id", q.staging_physics().alias("reason"))


@query("promotion_validation", f"WITH {E}, {RADAR} SELECT id, CASE WHEN timestamp_ms <= 0 THEN 'timestamp_ms invalid' WHEN sensor_type = 'SONAR' THEN 'sensor_type invalid' WHEN id % 6 = 5 THEN 'label invalid' END AS reason FROM radar")
def _(spark, sf):
    return radar(spark, sf).withColumn("label", F.when(F.col("id") % 6 != 5, (F.col("id") % 2).cast("int"))).select("id", q.promotion_sensor().alias("reason"))


@query("promotion_validation_physics", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 3 THEN 'track_count invalid' WHEN l_discount < 0.02 THEN 'max_energy_gev invalid' END AS reason FROM lineitem")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    rows = li.select("l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("event_id"), F.lit(NOW).alias("timestamp_ms"), F.lit(1).alias("run_number"), F.when(F.col("l_linenumber") == 3, -1).otherwise(1).alias("track_count"), *[F.lit(0.0).alias(f"net_momentum_{a}") for a in "xyz"], (F.col("l_discount") - 0.02).alias("max_energy_gev"), F.col("l_quantity").alias("total_energy_gev"))
    return rows.select("l_orderkey", "l_linenumber", q.promotion_physics().alias("reason"))


@query("sensor_ranges", f"""WITH {E}, {RADAR}, r AS (SELECT id, concat_ws('|', CASE WHEN sensor_type = 'SONAR' THEN 'sensor_type: unsupported sensor type' END, CASE WHEN timestamp_ms <= 0 THEN 'timestamp_ms: must be greater than 0' END, CASE WHEN schema_version IS DISTINCT FROM '1.0' THEN 'schema_version: must equal 1.0' END,
    CASE WHEN sensor_type = 'RADAR' AND range_m < 0 THEN 'range_m: must be greater than or equal to 0' END, CASE WHEN sensor_type = 'RADAR' AND (bearing_deg < 0 OR bearing_deg > 360) THEN 'bearing_deg: must be between 0 and 360' END, CASE WHEN sensor_type = 'RADAR' AND (elevation_deg < -90 OR elevation_deg > 90) THEN 'elevation_deg: must be between -90 and 90' END) AS violations FROM radar) SELECT * FROM r""")
def _(spark, sf):
    return radar(spark, sf).select("id", F.array_join(q.sensor_ranges(), "|").alias("violations"))


@query("physics_ranges", "SELECT l_orderkey, l_linenumber, concat_ws('|', CASE WHEN l_linenumber - 2 < 0 THEN 'track_count: must be greater than or equal to 0' END, CASE WHEN l_tax > l_discount THEN 'max_energy_gev: must not exceed total_energy_gev' END) AS violations FROM lineitem")
def _(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({"run_number": F.lit(1), "timestamp_ms": F.lit(NOW), "track_count": F.col("l_linenumber") - 2, "max_energy_gev": F.col("l_tax"), "total_energy_gev": F.col("l_discount"), "schema_version": F.lit("1.0")})
    return li.select("l_orderkey", "l_linenumber", F.array_join(q.physics_ranges(), "|").alias("violations"))


@query("quality_counters", f"WITH {E}, {RADAR} SELECT v AS violation, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN sensor_id IS NULL THEN 'sensor_id' END, CASE WHEN schema_version IS NULL THEN 'schema_version' END, CASE WHEN target_id IS NULL THEN 'target_id' END], lambda x: x IS NOT NULL)) AS v FROM radar) GROUP BY 1")
def _(spark, sf):
    return q.quality_counters(radar(spark, sf), q.null_or_absent(["sensor_id", "schema_version", "target_id"]))


@query("absent_keys", f"WITH {E} SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'a,k' WHEN event_id % 3 = 1 THEN 'a' ELSE '' END AS absent FROM e")
def _(spark, sf):
    raw = F.when(F.col("event_id") % 3 == 0, F.lit('{"b": null}')).when(F.col("event_id") % 3 == 1, F.lit('{"k": null}')).otherwise(F.lit('{"a": 1, "k": 2}'))
    return events(spark, sf).withColumn("raw", raw).select("event_id", F.array_join(q.absent_keys("raw", ["a", "k"]), ",").alias("absent"))


@query("first_examples", f"WITH {E} SELECT event_id FROM e WHERE value < 5 ORDER BY event_id LIMIT 20")
def _(spark, sf):
    return events(spark, sf).where("value < 5").orderBy("event_id").limit(20).select("event_id")


ENFORCED = f"WITH {E}, {RADAR}, j AS (SELECT *, CASE WHEN schema_version <> '1.0' THEN 'version drift' WHEN sensor_id IS NULL THEN 'sensor_id is null' WHEN sensor_type = 'SONAR' THEN 'sensor_type outside its domain' END AS reason FROM radar)"


def enforced(spark, sf):
    return q.enforce(radar(spark, sf), "sensor_event", SENSOR_EVENT, {"sensor_type": ("RADAR", "LIDAR", "TELEMETRY")})


@query("enforce_valid", f"{ENFORCED} SELECT id, '1.0' AS schema_version FROM j WHERE reason IS NULL")
def _(spark, sf):
    return enforced(spark, sf).valid.select("id", "schema_version")


@query("enforce_rejected", f"{ENFORCED} SELECT id, reason FROM j WHERE reason IS NOT NULL")
def _(spark, sf):
    return enforced(spark, sf).rejected.select("id", "reason")


@query("enforce_metrics", f"{ENFORCED} SELECT count(*) AS total, CAST(count_if(reason IS NULL) AS BIGINT) AS passed, count(reason) AS rejected, CAST(count_if(reason = 'version drift') AS BIGINT) AS version_drift, round_even(100.0 * count(reason) / count(*), 4) AS data_loss_pct FROM j")
def _(spark, sf):
    return enforced(spark, sf).metrics


@query("float32_checks", f"WITH {E} SELECT event_id, CAST(CAST(value AS FLOAT) AS DOUBLE) = value AS exact, abs(CAST(CAST(value AS FLOAT) AS DOUBLE) - value) < 0.001 AS near, CAST(CAST(value AS FLOAT) AS DOUBLE) AS wire FROM e")
def _(spark, sf):
    return events(spark, sf).select("event_id", q.survives_exactly(F.col("value")).alias("exact"), q.survives_nearly(F.col("value")).alias("near"), float32(F.col("value")).cast("double").alias("wire"))


@query("uuid_check", f"WITH {E} SELECT event_id, event_id % 4 <> 3 AS ok FROM e")
def _(spark, sf):
    i = F.col("event_id")
    text = F.when(i % 4 == 0, "12345678-1234-9234-1234-123456789abc").when(i % 4 == 1, "{12345678123412341234123456789ABC}").when(i % 4 == 2, "urn:uuid:12345678-1234-1234-1234-123456789abc").otherwise("12345678-1234-1234-1234-123456789abg")
    return events(spark, sf).select("event_id", is_uuid(text).alias("ok"))


@query("fused_conformance", f"""WITH {FUSED}, w AS (SELECT lpad(CAST(aid AS VARCHAR), 32, '0') AS alice_event_id, CASE WHEN sid % 3 = 0 THEN 'x' ELSE lpad(CAST(sid AS VARCHAR), 32, '0') END AS sensor_event_id, CASE WHEN aid % 4 = 0 THEN 0 ELSE a_ms END AS timestamp_ms, sensor_type, CASE WHEN aid % 5 = 0 THEN 250 ELSE 500 END AS fusion_window_ms,
    CASE WHEN aid % 6 = 0 THEN 101 ELSE aid % 100 END AS data_loss_pct, CASE WHEN aid % 7 = 0 THEN -1 ELSE 5 END AS latency_ms, CASE WHEN aid % 8 = 0 THEN '2.0' ELSE '1.0' END AS schema_version, CASE WHEN aid % 9 = 0 THEN 1 END AS anomaly_label, lpad(CAST(aid // 2 AS VARCHAR), 32, '0') AS fused_event_id FROM fused)
    SELECT count(*) AS total, 0 AS bad_fused_event_id, 0 AS bad_alice_event_id, CAST(count_if(sensor_event_id = 'x') AS BIGINT) AS bad_sensor_event_id, CAST(count_if(timestamp_ms <= 0) AS BIGINT) AS bad_timestamp_ms, CAST(count_if(fusion_window_ms <> 500) AS BIGINT) AS bad_fusion_window_ms,
    CAST(count_if(sensor_type <> 'click') AS BIGINT) AS bad_sensor_type, CAST(count_if(data_loss_pct > 100) AS BIGINT) AS bad_data_loss_pct, CAST(count_if(latency_ms < 0) AS BIGINT) AS bad_latency_ms, CAST(count_if(schema_version <> '1.0') AS BIGINT) AS bad_schema_version, count(anomaly_label) AS set_anomaly_label, count(*) - count(DISTINCT fused_event_id) AS duplicate_ids FROM w""")
def _(spark, sf):
    text = lambda c: F.lpad(c.cast("string"), 32, "0")
    a, sid = F.col("aid"), F.col("sid")
    rows = v.fused(spark, sf).select(
        text(F.floor(a / 2)).alias("fused_event_id"), text(a).alias("alice_event_id"), F.when(sid % 3 == 0, "x").otherwise(text(sid)).alias("sensor_event_id"), F.when(a % 4 == 0, 0).otherwise(F.col("a_ms")).alias("timestamp_ms"), "sensor_type",
        F.when(a % 5 == 0, 250).otherwise(500).alias("fusion_window_ms"), F.when(a % 6 == 0, 101).otherwise(a % 100).alias("data_loss_pct"), F.when(a % 7 == 0, -1).otherwise(5).alias("latency_ms"), F.when(a % 8 == 0, "2.0").otherwise("1.0").alias("schema_version"), F.when(a % 9 == 0, 1).alias("anomaly_label"),
    )
    return q.fused_conformance(rows, 500, ("click",))


@query("score_constraints", f"WITH {SCORED} SELECT event_id, (anomaly_label IS NULL OR anomaly_label IN (0, 1)) AND (latency_ms / 100 <= 1) AS ok FROM scored")
def _(spark, sf):
    return v.scored(spark, sf).withColumns({"risk_score": F.col("latency_ms") / 100, "confidence": F.lit(None).cast("double")}).select("event_id", q.score_checks().alias("ok"))


@query("heartbeat_quality", f"WITH {STATUS} SELECT event_id, quality_score, status FROM status")
def _(spark, sf):
    return v.status(spark, sf).select("event_id", "quality_score", "status")


@query("heartbeats", f"WITH {SCORED}, m AS (SELECT avg(data_loss_pct) AS l, avg(latency_ms * 40) AS t FROM scored), b AS (SELECT unnest(['alice', 'sensor']) AS source_type, CAST(trunc(100 - l - CASE WHEN t > 500 THEN (t - 500) / 100.0 ELSE 0 END) AS INTEGER) AS quality_score FROM m) SELECT source_type, quality_score, CASE WHEN quality_score >= 80 THEN 'ok' WHEN quality_score >= 50 THEN 'degraded' ELSE 'critical' END AS status FROM b")
def _(spark, sf):
    return heartbeats(v.scored(spark, sf).withColumn("latency_ms", F.col("latency_ms") * 40), F.lit(NOW)).select("source_type", "quality_score", "status")


@query("bar_checks", f"WITH {SCORED} SELECT sensor_type, count(*) >= 10000 AS throughput_ok, quantile_cont(latency_ms, 0.95) <= 500 AS latency_ok, avg(data_loss_pct) <= 1 AS loss_ok FROM scored GROUP BY 1")
def _(spark, sf):
    rates = v.scored(spark, sf).groupBy("sensor_type").agg(F.count(F.lit(1)).alias("n"), F.percentile("latency_ms", F.lit(0.95)).alias("p"), F.avg("data_loss_pct").alias("l"))
    return rates.select("sensor_type", *[c.alias(k) for k, c in q.bar_checks(F.col("n"), F.col("p"), F.col("l")).items()])


@query("label_checks", f"WITH {SCORED} SELECT event_id, CASE WHEN anomaly_label IS NULL THEN NULL ELSE (anomaly_label = 0) = (user_id % 5 <> 0) END AS ok FROM scored")
def _(spark, sf):
    rows = v.scored(spark, sf).withColumns({"label": F.col("anomaly_label"), "anomaly_type": F.when(F.col("user_id") % 5 == 0, "noise_burst")})
    return rows.select("event_id", q.label_checks(sum(ANOMALIES.values(), ())).alias("ok"))


@query("stream_cleaning", f"WITH {E}, f AS (SELECT event_id, user_id, ms, ms - lag(ms) OVER (PARTITION BY user_id ORDER BY ms) AS gap FROM e WHERE ms <= {NOW} + 5000) SELECT user_id, count(*) AS n FROM f WHERE gap IS NULL OR gap > 3600000 GROUP BY 1")
def _(spark, sf):
    rows = events(spark, sf).select(F.col("user_id").cast("string").alias("event_id"), "user_id", F.col("ms").alias("timestamp_ms"))
    return q.cleaned(rows, F.lit(NOW), 3_600_000).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


# Detection: orders, lines and events stand for the three streams.
@query("lidar_features", "SELECT l_orderkey, l_linenumber, round(ln(1 + l_quantity), 9) AS log_point_count, round(CASE WHEN l_tax > 0 THEN sqrt(l_quantity * l_quantity + l_discount * l_discount + l_tax * l_tax) / l_tax ELSE 0 END, 6) AS ratio FROM lineitem")
def _(spark, sf):
    named = table(spark, sf, "lineitem").withColumns({"point_count": F.col("l_quantity"), "centroid_x_m": F.col("l_quantity"), "centroid_y_m": F.col("l_discount"), "centroid_z_m": F.col("l_tax"), "max_range_m": F.col("l_tax"), "avg_intensity": F.lit(1.0), "min_intensity": F.lit(1.0)})
    return named.select("l_orderkey", "l_linenumber", *s.lidar_features()).select("l_orderkey", "l_linenumber", F.round("log_point_count", 9).alias("log_point_count"), F.round("centroid_to_range_ratio", 6).alias("ratio"))


@query("radar_features", f"WITH {E} SELECT event_id, CAST(CAST(value AS FLOAT) AS DOUBLE) AS range_m, value * 2 AS velocity_ms FROM e")
def _(spark, sf):
    e = events(spark, sf).withColumns({"range_m": F.col("value").cast("float"), "bearing_deg": F.col("value"), "elevation_deg": F.col("value"), "velocity_ms": F.col("value") * 2, "signal_strength_db": F.col("value")})
    return e.select("event_id", *s.radar_features()).select("event_id", "range_m", "velocity_ms")


STATS = "st AS (SELECT event_type, avg(value) AS mean, stddev_pop(value) AS std FROM e WHERE event_type <> 'view' AND event_id % 5 <> 0 GROUP BY 1)"


@query("telemetry_features", f"WITH {E}, {STATS} SELECT event_id, round((value - mean) / std, 6) AS value_z FROM e LEFT JOIN st USING (event_type)")
def _(spark, sf):
    e = events(spark, sf)
    stats = value_stats(e, "event_type", "value", F.col("event_type") != "view", F.col("event_id") % 5 != 0)
    return s.telemetry_features(e, stats, "event_type").select("event_id", F.round("value_z", 6).alias("value_z"))


@query("assembly_reason", f"""WITH {E} SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'no staging row' WHEN event_id % 5 = 0 THEN 'missing parameter_name,value' WHEN event_id % 3 = 0 THEN 'missing value' WHEN event_type = 'view' THEN 'unknown parameter view' END AS reason FROM e""")
def _(spark, sf):
    i = F.col("event_id")
    rows = events(spark, sf).select("event_id", F.lit("TELEMETRY").alias("sensor_type"), F.when(i % 7 != 0, i).alias("staging_event_id"), F.when(i % 5 != 0, F.col("event_type")).alias("parameter_name"), F.when((i % 5 != 0) & (i % 3 != 0), F.col("value")).alias("value"))
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in SENSOR_EVENT if f.name not in rows.columns})
    return rows.select("event_id", s.assembly_reason(known=F.col("parameter_name") != "view").alias("reason"))


@query("robust_z", f"WITH {E}, m AS (SELECT event_type, quantile_cont(value, 0.5) AS med FROM e GROUP BY 1), d AS (SELECT event_type, any_value(med) AS med, quantile_cont(abs(value - med), 0.5) AS mad FROM e JOIN m USING (event_type) GROUP BY 1), z AS (SELECT event_id, abs(value - med) / mad AS z1, abs(user_id - 50.0) / 25.0 AS z2 FROM e JOIN d USING (event_type)) SELECT event_id, round(greatest(z1, z2), 6) AS worst_z, CASE WHEN z1 >= z2 THEN 'value' ELSE 'user_id' END AS worst_feature FROM z")
def _(spark, sf):
    e = events(spark, sf)
    scales = median_mad(e, "event_type", "value")
    rows = e.join(F.broadcast(scales), "event_type")
    return s.robust_z(rows, ("value", "user_id"), {"value": (F.col("med"), F.col("mad")), "user_id": (F.lit(50.0), F.lit(25.0))}).select("event_id", F.round("worst_z", 6).alias("worst_z"), "worst_feature")


def decided(line: float, risk: str) -> str:
    return f"CAST(CASE WHEN {risk} >= {line} THEN 1 ELSE 0 END AS INTEGER) AS anomaly_label, {risk} AS risk_score, round(greatest(least(CASE WHEN {risk} >= {line} THEN ({risk} - {line}) / (1.0 - {line}) ELSE ({line} - {risk}) / {line} END, 1.0), 0.0), 6) AS confidence"


@query("decide_one", f"WITH {E}, r AS (SELECT event_id, CASE WHEN user_id % 7 = 0 THEN 1.0 ELSE round(1 - 1 / (1 + value), 4) END AS r FROM e) SELECT event_id, {decided(0.99, 'r')} FROM r")
def _(spark, sf):
    out = s.decide(F.round(1 - 1 / (1 + F.col("value")), 4), s.LINE_ONE, F.when(F.col("user_id") % 7 == 0, "sequence_gap"))
    return events(spark, sf).select("event_id", *[(F.round(c, 6) if k == "confidence" else c).alias(k) for k, c in out.items()])


TWO = "r AS (SELECT event_id, user_id, round(1 - 1 / (1 + value), 4) AS f, round(1 - 1 / (1 + value * (1 + user_id % 3)), 4) AS z FROM e)"


def two(spark, sf):
    return events(spark, sf).select("event_id", "user_id", F.round(1 - 1 / (1 + F.col("value")), 4).alias("f"), F.round(1 - 1 / (1 + F.col("value") * (1 + F.col("user_id") % 3)), 4).alias("z"))


@query("decide_two", f"WITH {E}, {TWO}, g AS (SELECT event_id, greatest(f, z) AS r FROM r) SELECT event_id, {decided(0.995, 'r')} FROM g")
def _(spark, sf):
    out = s.decide(s.combined_risk(F.col("f"), F.col("z")), s.LINE_TWO)
    return two(spark, sf).select("event_id", *[(F.round(c, 6) if k == "confidence" else c).alias(k) for k, c in out.items()])


@query("alarm_reasons", f"WITH {E}, {TWO} SELECT event_id, concat_ws('+', CASE WHEN user_id % 7 = 0 THEN 'rule:sequence_gap' END, CASE WHEN f >= 0.995 THEN 'isolation_forest' END, CASE WHEN z >= 0.995 THEN 'zscore:value' END) AS reason FROM r")
def _(spark, sf):
    return two(spark, sf).select("event_id", s.alarm_reason(F.when(F.col("user_id") % 7 == 0, "sequence_gap"), F.col("f"), F.col("z"), F.lit("value")).alias("reason"))


@query("detector_variants", f"WITH {E}, {TWO}, t AS (SELECT user_id % 2 = 0 AS truth, f, z FROM r), x AS (SELECT 'each' AS variant, truth, f >= 0.99 OR z >= 0.99 AS hit FROM t UNION ALL SELECT 'half', truth, f >= 0.995 OR z >= 0.995 FROM t) SELECT variant, round(count_if(NOT truth AND hit) / count_if(NOT truth), 6) AS fpr, round(count_if(truth AND hit) / count_if(truth), 6) AS recall FROM x GROUP BY 1")
def _(spark, sf):
    t = two(spark, sf)
    hit = lambda line: (F.col("f") >= line) | (F.col("z") >= line)
    x = t.withColumns({"variant": F.lit("each"), "hit": hit(0.99)}).unionByName(t.withColumns({"variant": F.lit("half"), "hit": hit(0.995)}))
    return confusion(x, F.col("user_id") % 2 == 0, F.col("hit"), "variant").select("variant", F.round("fpr", 6).alias("fpr"), F.round("recall", 6).alias("recall"))


@query("isolation_forest")
def _(spark, sf):
    # Trains on four fifths of the events, read as a radar's, scores the last fifth, and gives risk and decision.
    names, rows = list(s.RADAR), v.radar_rows(spark, sf)
    train, test = rows.where("n % 5 != 0"), rows.where("n % 5 = 0")
    forest = fit_forest(train, names, "event_id")
    # Scores are kept: the steps of the risk read them several times, and each would go through all trees again.
    kind = F.lit("radar").alias("stream")
    reference = stored(score_forest(train.where("label = 0"), forest, names).select("score"), "reference").select("score", kind)
    own = stored(score_forest(test, forest, names).select("event_id", "label", "anomaly_type", "score"), "scores").select("*", kind)
    scored = ecdf_risk(own, reference, "score", "stream")
    return scored.select("event_id", "label", "anomaly_type", "risk", *[c.alias(k) for k, c in s.decide(F.col("risk"), s.LINE_ONE).items()])


@query("isolation_forest_auc", "SELECT 'radar' AS stream, true AS good")
def _(spark, sf):
    rows = QUERIES["isolation_forest"](spark, sf).withColumn("stream", F.lit("radar"))
    return roc_auc(rows, "risk", F.col("label") == 1, "stream").select("stream", (F.col("auc") > 0.99).alias("good"))


# Generators: the same draws in SQL.
def unit_sql(what: str) -> str:
    return f"(CAST('0x' || substr(md5('42:' || n || ':{what}'), 1, 13) AS BIGINT) / {float(1 << 52)})"


def uniform_sql(what: str, low, high) -> str:
    return f"(round({low} + ({high} - {low}) * {unit_sql(what)}, 2) + 0.0)"  # no negative zero


def integer_sql(what: str, low: int, high: int) -> str:
    return f"CAST(floor({unit_sql(what)} * {high - low + 1}) + {low} AS INTEGER)"


def uuid_sql(what: str) -> str:
    return "concat_ws('-', " + ", ".join(f"substr(md5('42:' || n || ':{what}'), {a}, {k})" for a, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + ")"


def generated_sql(kind: str, count: int = 5000, base_ms: int = 1_700_000_000_000) -> str:
    """Normal records, their mutations by anomaly type, and telemetry's counters after gaps, in DuckDB."""
    own = {"event_id": uuid_sql(f"event {kind}"), "sensor_id": f"'{kind}-01'", "sensor_type": f"'{kind}'", "timestamp_ms": f"{base_ms} + (n + 1) * 1000", "schema_version": "'1.0'"}
    own |= {name: uniform_sql(name, float(a), float(b)) for name, (a, b) in g.NORMAL.get(kind, {}).items()}
    if kind == "RADAR":
        own["target_id"] = f"'TARGET-' || lpad(CAST({integer_sql('target', 1, g.TARGETS)} AS VARCHAR), 4, '0')"
    elif kind == "LIDAR":
        own |= {"scan_id": uuid_sql("scan"), "point_count": integer_sql("point_count", *g.POINTS), "min_intensity": uniform_sql("min_intensity", float(g.LEAST_INTENSITY), f"least({float(g.MOST_LEAST_INTENSITY)}, {own['avg_intensity']})")}
    else:
        parameter = f"([{', '.join(repr(p) for p in g.PARAMETERS)}])[{integer_sql('parameter_name', 1, len(g.PARAMETERS))}]"
        of = lambda k: "CASE " + parameter + " " + " ".join(f"WHEN '{p}' THEN {v[k]!r}" for p, v in g.PARAMETERS.items()) + " END"
        own |= {"device_id": "'SENSOR-UNIT-01'", "parameter_name": parameter, "value": uniform_sql("value", of(1), of(2)), "unit": of(0), "sequence_number": "n + 1"}
    sql_type = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT"}
    cast = lambda f, x: f"CAST({x} AS {sql_type[f.dataType.simpleString()]})"
    base = ", ".join(f"{cast(f, own.get(f.name, 'NULL'))} AS {f.name}" for f in SENSOR_EVENT)
    kinds = ", ".join(repr(t) for t in ANOMALIES[kind])
    new: dict[str, list] = {}
    for (name, t), (a, b) in g.ANOMALOUS.items():
        new.setdefault(name, []).append((t, uniform_sql(f"{t} {name}", float(a), float(b))))
    for name, by in g.SHIFTS.items():
        new.setdefault(name, []).append(("noise_burst", f"round(CAST({name} AS DOUBLE) + {uniform_sql(f'shift {name}', -float(by), float(by))}, 2)"))
    new["velocity_ms"] = [("velocity_spike", f"round(CASE WHEN {unit_sql('sign')} < 0.5 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END * {uniform_sql('spike', *map(float, g.SPIKE))}, 2)")]
    new["point_count"] = [("point_cloud_dropout", integer_sql("few", *g.FEW_POINTS)), ("ghost_point", str(g.GHOST_POINTS))]
    new["value"] = [("out_of_range_value", "CASE parameter_name " + " ".join(f"WHEN '{p}' THEN {uniform_sql(f'far {p}', a, b)}" for p, (a, b) in g.OUT_OF_RANGE.items()) + " END")]
    gap, moved = integer_sql("gap", *g.GAP), "0"
    if kind == "TELEMETRY":
        moved = f"coalesce(sum(CASE WHEN anomaly_type = 'missing_reading' THEN {gap} ELSE 0 END) OVER (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    new["timestamp_ms"] = [("timestamp_stall", "timestamp_ms - 1000")]
    new["sequence_number"] = [("missing_reading", f"sequence_number + {gap}")]
    out = []
    for f in SENSOR_EVENT:
        x = f"CASE anomaly_type {' '.join(f'WHEN {t!r} THEN {cast(f, v)}' for t, v in new[f.name])} ELSE {f.name} END" if f.name in new else f.name
        more = {"timestamp_ms": f" + {moved} * 1000", "sequence_number": f" + {moved}"}.get(f.name, "")
        out.append(f"{cast(f, x + more)} AS {f.name}")
    return f"""WITH b AS (SELECT n, {base}, CASE WHEN {unit_sql('hit')} < {g.RATE} THEN ([{kinds}])[{integer_sql('kind', 1, 3)}] END AS anomaly_type FROM range({count}) t(n))
        SELECT n, {', '.join(out)}, CAST(anomaly_type IS NOT NULL AS INTEGER) AS label, anomaly_type FROM b"""


@query("generated_radar", generated_sql("RADAR"))
def _(spark, sf):
    return generate(spark, "RADAR", 5000)


@query("generated_lidar", generated_sql("LIDAR"))
def _(spark, sf):
    return generate(spark, "LIDAR", 5000)


@query("generated_telemetry", generated_sql("TELEMETRY"))
def _(spark, sf):
    return generate(spark, "TELEMETRY", 5000)


@query("generator_checks", "SELECT unnest(['RADAR', 'LIDAR', 'TELEMETRY']) AS sensor_type, 5000 AS n, 5000 AS ids, true AS rate_ok, 3 AS kinds, 0 AS bad_labels")
def _(spark, sf):
    every = None
    for kind in ANOMALIES:
        one = generate(spark, kind, 5000).select("sensor_type", "event_id", "label", "anomaly_type")
        every = one if every is None else every.unionByName(one)
    wrong = F.count_if(~q.label_checks(sum(ANOMALIES.values(), ())))
    return every.groupBy("sensor_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"), F.avg("label").between(0.02, 0.04).alias("rate_ok"), F.countDistinct("anomaly_type").alias("kinds"), wrong.alias("bad_labels"))


@query("device_sequences", f"WITH {E} SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS sequence_number FROM e")
def _(spark, sf):
    return numbered(events(spark, sf), "user_id", "event_id").select("event_id", "sequence_number")


@query("lateness_injection", f"WITH {E} SELECT count(*) AS n, true AS share_ok, true AS range_ok FROM e")
def _(spark, sf):
    rows = inject_lateness(events(spark, sf), "ms", "event_id", 0.05, 1000, 30_000)
    late = F.col("shift_ms") > 0
    return rows.agg(F.count(F.lit(1)).alias("n"), F.avg(late.cast("int")).between(0.03, 0.07).alias("share_ok"), (F.count_if(late & ~F.col("shift_ms").between(1000, 30_000)) == 0).alias("range_ok"))


# Sinks.
@query("audit_columns", f"WITH {E} SELECT event_id, 'validated' AS load_status, 'b1' AS batch_id, 0 AS label FROM e")
def _(spark, sf):
    return with_audit(events(spark, sf), F.current_timestamp(), "b1").select("event_id", "load_status", "batch_id", "label")


@query("fused_records", f"WITH {FUSED} SELECT CAST(aid AS VARCHAR) AS alice_event_id, CAST(sid AS VARCHAR) AS sensor_event_id, a_ms AS timestamp_ms, sensor_type, 300000 AS fusion_window_ms, '1.0' AS schema_version FROM fused")
def _(spark, sf):
    return fused_rows(v.fused(spark, sf), v.WINDOW_MS, F.lit(NOW)).select("alice_event_id", "sensor_event_id", "timestamp_ms", "sensor_type", "fusion_window_ms", "schema_version")


@query("copy_encoding", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '"' || replace(o_orderpriority || '"x', '"', '""') || '"' END AS field FROM orders""")
def _(spark, sf):
    text = F.when(F.col("o_orderkey") % 5 != 0, F.concat("o_orderpriority", F.lit('"x')))
    return v.orders(spark, sf).select("o_orderkey", quoted_csv(text).alias("field"))


# Dashboards: contract only.
@query("api_summary", f"WITH {STATUS}, {SCORED.split("FROM events),", 1)[1]}, l AS (SELECT timestamp_ms // 300000 * 300000 AS bucket, count(*) AS n, count(*) FILTER (WHERE anomaly_label = 1) AS a, avg(risk_score) AS r, max(risk_score) AS m FROM scored GROUP BY 1 ORDER BY 1 DESC LIMIT 1), o AS (SELECT count_if(status = 'ok') AS k FROM (SELECT status FROM status QUALIFY row_number() OVER (PARTITION BY source_type ORDER BY time DESC) = 1)) SELECT CAST(k AS BIGINT) AS active_sensors, n AS total_events_5m, CAST(a AS BIGINT) AS anomaly_count_5m, round(r, 9) AS avg_risk_score, m AS max_risk_score, bucket AS last_updated_ms, 30 AS cagg_refresh_s FROM l, o")
def _(spark, sf):
    from eventloom.operators.rollups import summary_5min_plain

    out = d.summary(summary_5min_plain(v.scored(spark, sf), "timestamp_ms", "anomaly_label", "risk_score"), v.status(spark, sf))
    return out.withColumn("avg_risk_score", F.round("avg_risk_score", 9))


@query("api_stream_rate", f"WITH {E} SELECT count(*) / 86400 AS throughput_evt_sec FROM e WHERE ms > {NOW} - 86400000 AND ms <= {NOW}")
def _(spark, sf):
    return d.stream_rate(events(spark, sf), "ms", NOW, 86_400)


@query("api_alerts_filtered", f"WITH {ALERTS} SELECT fused_event_id, risk_score FROM alerts WHERE timestamp_ms >= 1704500000000 AND source_type = 'error' AND status = 'active' AND risk_score >= 0.3")
def _(spark, sf):
    return d.filtered(v.alerts(spark, sf), start=1_704_500_000_000, source_type="error", status="active", min_risk=0.3).select("fused_event_id", "risk_score")


@query("api_alerts_summary", f"WITH {ALERTS} SELECT CAST(count_if(status = 'active') AS BIGINT) AS active_count, CAST(count_if(status = 'active' AND risk_score > 0.7) AS BIGINT) AS critical_count, CAST(count_if(status = 'closed' AND status_updated_at >= {NOW}) AS BIGINT) AS closed_today FROM alerts")
def _(spark, sf):
    return d.alert_counts(v.alerts(spark, sf), NOW)


@query("api_alert", f"WITH {ALERTS} SELECT fused_event_id, status, risk_score FROM alerts WHERE fused_event_id = '17'")
def _(spark, sf):
    return v.alerts(spark, sf).where("fused_event_id = '17'").select("fused_event_id", "status", "risk_score")


@query("api_patch_alert", f"WITH {ALERTS} SELECT fused_event_id, CASE WHEN fused_event_id = '17' THEN 'reviewed' ELSE status END AS status, CASE WHEN fused_event_id = '17' THEN {NOW} ELSE status_updated_at END AS status_updated_at FROM alerts")
def _(spark, sf):
    return patch_status(v.alerts(spark, sf), "17", "reviewed", NOW).select("fused_event_id", "status", "status_updated_at")


@query("api_explanation", f"WITH {ALERTS} SELECT CAST(vec_id AS VARCHAR) AS fused_event_id, risk_score, source_type, CASE WHEN abs(embedding[1]) >= abs(embedding[2]) THEN 'a' ELSE 'b' END AS first FROM embeddings JOIN alerts ON fused_event_id = CAST(vec_id AS VARCHAR)")
def _(spark, sf):
    part = lambda name, i: F.struct(F.lit(name).alias("feature"), F.get("embedding", F.lit(i)).cast("double").alias("shap_value"), F.lit("up").alias("direction"))
    why = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("fused_event_id"), F.array(part("a", 0), part("b", 1)).alias("shap_values"))
    return d.explanation(v.alerts(spark, sf), why).select("fused_event_id", "risk_score", "source_type", F.get("top_features", F.lit(0))["feature"].alias("first"))


@query("api_sensors", f"WITH {STATUS} SELECT source_type, quality_score, contribution_weight, data_loss AS data_loss_pct, round(latency, 6) AS latency_ms, CASE status WHEN 'ok' THEN 'online' WHEN 'critical' THEN 'offline' ELSE status END AS status, 500 AS fusion_window_ms FROM status QUALIFY row_number() OVER (PARTITION BY source_type ORDER BY time DESC) = 1")
def _(spark, sf):
    return d.sensors(v.status(spark, sf)).withColumn("latency_ms", F.round("latency_ms", 6))


@query("api_fusion_events", f"WITH {FUSED} SELECT aid, sid, a_ms FROM fused WHERE sensor_type = 'click' ORDER BY a_ms DESC, aid LIMIT 50")
def _(spark, sf):
    return v.fused(spark, sf).where("sensor_type = 'click'").orderBy(F.desc("a_ms"), "aid").limit(50).select("aid", "sid", "a_ms")


@query("api_performance", f"WITH {SCORED} SELECT timestamp_ms // 3600000 * 3600000 AS bucket, sensor_type AS source_type, count(*) AS event_count, round(avg(data_loss_pct), 6) AS avg_data_loss, round(max(latency_ms), 6) AS avg_time_sync FROM scored GROUP BY 1, 2")
def _(spark, sf):
    from eventloom.functions.scalars import time_bucket

    rows = v.scored(spark, sf).select(time_bucket(F.col("timestamp_ms"), 3_600_000).alias("bucket"), F.col("sensor_type").alias("source_type"), "latency_ms", "data_loss_pct")
    perf = rows.groupBy("bucket", "source_type").agg(F.count(F.lit(1)).alias("event_count"), F.round(F.avg("data_loss_pct"), 6).alias("avg_data_loss"))
    health = rows.groupBy("bucket", "source_type").agg(F.round(F.max("latency_ms"), 6).alias("avg_time_sync"))
    return d.performance(perf, health)


@query("api_thresholds", "SELECT 500.0::DOUBLE AS latency_p95_ms, 1.0::DOUBLE AS data_loss_pct, 1.0::DOUBLE AS time_sync_ms, 10000.0::DOUBLE AS throughput_min, 0.85::DOUBLE AS model_auc_min, 0.05::DOUBLE AS false_positive_max")
def _(spark, sf):
    return d.thresholds(spark)


def reported(spark, sf):
    return d.report(v.alerts(spark, sf), v.scored(spark, sf), min_risk=0.2)


@query("api_report_summary", f"WITH {ALERTS} SELECT (SELECT count(*) FROM scored) AS total_events, (SELECT round(avg(latency_ms), 6) FROM scored) AS avg_latency_ms, (SELECT round(avg(data_loss_pct), 6) FROM scored) AS avg_data_loss_pct, count(*) AS total_anomalies, round(avg(risk_score), 9) AS avg_risk_score FROM alerts WHERE risk_score >= 0.2")
def _(spark, sf):
    return reported(spark, sf)["summary"].withColumns({"avg_latency_ms": F.round("avg_latency_ms", 6), "avg_data_loss_pct": F.round("avg_data_loss_pct", 6), "avg_risk_score": F.round("avg_risk_score", 9)})


@query("api_report_trend", f"WITH {ALERTS} SELECT timestamp_ms // 86400000 * 86400000 AS bucket_ms, count(*) AS anomaly_count FROM alerts WHERE risk_score >= 0.2 GROUP BY 1")
def _(spark, sf):
    return reported(spark, sf)["anomaly_trend"]


@query("api_report_sensors", f"WITH {ALERTS} SELECT source_type, count(*) AS anomaly_count FROM alerts WHERE risk_score >= 0.2 GROUP BY 1")
def _(spark, sf):
    return reported(spark, sf)["sensor_performance"]


@query("api_report_top", f"WITH {ALERTS} SELECT fused_event_id, risk_score FROM alerts ORDER BY risk_score DESC, fused_event_id LIMIT 10")
def _(spark, sf):
    return reported(spark, sf)["top_events"]


@query("api_snapshot_key", f"WITH {ALERTS} SELECT fused_event_id, sha256(source_type || '|' || status) AS filter_hash, timestamp_ms + 86400000 AS expires_at_ms FROM alerts")
def _(spark, sf):
    return d.snapshot_key(v.alerts(spark, sf).withColumn("created_ms", F.col("timestamp_ms")), "source_type", "status").select("fused_event_id", "filter_hash", "expires_at_ms")


@query("scalar_functions", f"WITH {E} SELECT event_id, abs(value - 50) AS a, floor(value / 7) AS b, round(sqrt(value), 9) AS c, round(ln(1 + value), 9) AS d, round(cos(value), 9) AS f, greatest(least(value / 100, 1.0), 0.0) AS g, event_id % 1000 AS h, printf('TARGET-%04d', user_id) AS i, substr(event_type, 1, 3) AS j, make_timestamp(ms * 1000) AS k FROM e")
def _(spark, sf):
    x = F.col("value")
    return events(spark, sf).select("event_id", F.abs(x - 50).alias("a"), F.floor(x / 7).cast("double").alias("b"), F.round(F.sqrt(x), 9).alias("c"), F.round(F.log1p(x), 9).alias("d"), F.round(F.cos(x), 9).alias("f"), clip01(x / 100).alias("g"), (F.col("event_id") % 1000).alias("h"), F.format_string("TARGET-%04d", "user_id").alias("i"), F.substring("event_type", 1, 3).alias("j"), F.timestamp_millis("ms").cast("timestamp_ntz").alias("k"))


@query("zoned_times", f"WITH {E} SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN 1704067200000 ELSE 1704060000000 END AS since_ms FROM e")
def _(spark, sf):
    text = F.when(F.col("event_id") % 3 == 0, "2024-01-01T00:00:00").when(F.col("event_id") % 3 == 1, "2024-01-01T00:00:00Z").otherwise("2024-01-01T00:00:00+02:00")
    return events(spark, sf).select("event_id", zoned_millis(text).alias("since_ms"))
