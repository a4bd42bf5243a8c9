"""Queries: projections, joins, windows and order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from eventloom.functions.scalars import time_bucket
from eventloom.operators.fusion import match_rate, near_pairs, nearest_in_order, payload_audit, prepare_left, prepare_right, union_all
from eventloom.operators.ordered import numbered
from eventloom.operators.ordering import page, pooled, recent, strata_left, top_features
from eventloom.operators.scoring import stratified_split
from eventloom.operators.sinks import insert_ignore, promote, write_back
from eventloom.operators.windows import ecdf_risk, inter_arrival, lateness, latest, rolling_rate, rules_for, sequence_rules, sliding_counts
from eventloom.sources.files import decode_json, events, replay, table

from . import views as v
from .views import E, FUSED, SCORED, WINDOW_MS

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


@query("fusion_nearest", f"WITH {FUSED} SELECT aid, a_ms, sid, s_ms, sensor_type, abs_dt FROM fused")
def _(spark, sf):
    e = events(spark, sf)
    left = e.where(F.col("event_type") == v.LEFT).select(F.col("event_id").alias("aid"), F.col("ms").alias("a_ms"))
    right = e.where(F.col("event_type").isin(*v.RIGHTS)).select(F.col("event_id").alias("sid"), F.col("ms").alias("s_ms"), F.col("event_type").alias("sensor_type"))
    return nearest_in_order(left, right, WINDOW_MS)


@query("fusion_nearest_pairs", f"WITH {FUSED} SELECT aid, a_ms, sid, s_ms, sensor_type, abs_dt FROM fused")
def _(spark, sf):
    return v.fused(spark, sf)


#: Lines of an order against all orders within three days: some hundred pairs for each line at 0.1 of the scale, and no pair is made.
DENSE = """
    l AS (SELECT l_orderkey * 8 + l_linenumber AS aid, epoch_ms(l_shipdate) + l_orderkey * 7 % 24 * 3600000 AS a_ms FROM lineitem),
    o AS (SELECT epoch_ms(o_orderdate) + o_orderkey % 24 * 3600000 AS s_ms, min(o_orderkey) AS sid FROM orders GROUP BY 1),
    low AS (SELECT aid, a_ms, sid, s_ms FROM l ASOF LEFT JOIN o ON a_ms >= s_ms),
    d AS (SELECT DISTINCT a_ms FROM l),
    high AS (SELECT a_ms, sid, s_ms FROM d ASOF JOIN o ON a_ms < s_ms),
    best AS (SELECT low.aid, low.a_ms, low.s_ms IS NOT NULL AND (high.s_ms IS NULL OR low.a_ms - low.s_ms <= high.s_ms - low.a_ms) AS first, low.sid AS sid0, low.s_ms AS s0, high.sid AS sid1, high.s_ms AS s1 FROM low LEFT JOIN high ON low.a_ms = high.a_ms)"""


@query("fusion_nearest_dense", f"WITH {DENSE} SELECT aid, a_ms, CASE WHEN first THEN sid0 ELSE sid1 END AS sid, CASE WHEN first THEN s0 ELSE s1 END AS s_ms, abs(CASE WHEN first THEN s0 ELSE s1 END - a_ms) AS abs_dt FROM best WHERE abs(CASE WHEN first THEN s0 ELSE s1 END - a_ms) <= 259200000")
def _(spark, sf):
    hour = 3_600_000
    at = lambda c: F.unix_millis(F.col(c).cast("timestamp"))
    left = table(spark, sf, "lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("aid"), (at("l_shipdate") + F.col("l_orderkey") * 7 % 24 * hour).alias("a_ms"))
    right = v.orders(spark, sf).select(F.col("o_orderkey").alias("sid"), (at("o_orderdate") + F.col("o_orderkey") % 24 * hour).alias("s_ms"), F.lit("order").alias("sensor_type"))
    return nearest_in_order(left, right, 72 * hour).drop("sensor_type")


@query("interval_pairs", f"WITH {FUSED} SELECT aid, sid, a_ms, s_ms, sensor_type FROM pairs")
def _(spark, sf):
    left, right = v.rows_of_sides(spark, sf)
    return near_pairs(left, right, WINDOW_MS).select("aid", "sid", "a_ms", "s_ms", "sensor_type")


@query("union_streams", f"WITH {FUSED} SELECT sid, s_ms, sensor_type, s_ms // 600000 AS s_bucket FROM s")
def _(spark, sf):
    e = events(spark, sf)
    return union_all([prepare_right(e.where(F.col("event_type") == k), "event_id", "ms", k, WINDOW_MS) for k in v.RIGHTS]).drop("s_time")


@query("bucket_fanout", f"WITH {FUSED} SELECT aid, a_ms, unnest(range((a_ms - 300000) // 600000, (a_ms + 300000) // 600000 + 1)) AS bucket FROM a")
def _(spark, sf):
    return v.sides(spark, sf)[0].drop("a_time")


@query("match_rate", f"WITH {FUSED} SELECT (SELECT count(*) FROM fused) AS matched, (SELECT count(*) FROM a) AS total, (SELECT count(*) FROM fused) / (SELECT count(*) FROM a) AS rate")
def _(spark, sf):
    return match_rate(v.fused(spark, sf), events(spark, sf).where(F.col("event_type") == v.LEFT))


@query("payload_audit", f"WITH {FUSED} SELECT aid, sid, abs((s_ms + sid % 7 * 60000) - a_ms) AS payload_dt FROM fused WHERE abs((s_ms + sid % 7 * 60000) - a_ms) > 300000")
def _(spark, sf):
    e = events(spark, sf)
    left, right = e.select(F.col("event_id").alias("aid"), F.col("ms").alias("a_payload_ms")), e.select(F.col("event_id").alias("sid"), (F.col("ms") + F.col("event_id") % 7 * 60_000).alias("s_payload_ms"))
    return payload_audit(v.fused(spark, sf), left, right, WINDOW_MS).select("aid", "sid", "payload_dt")


@query("event_time", f"WITH {E} SELECT event_id, ms, make_timestamp(ms * 1000) AS event_ts FROM e")
def _(spark, sf):
    return events(spark, sf).select("event_id", "ms", F.timestamp_millis("ms").cast("timestamp_ntz").alias("event_ts"))


@query("key_time_projection", f"WITH {E} SELECT CAST(event_id AS VARCHAR) AS key, ms, upper(event_type) AS kind, lower(upper(event_type)) AS source_type FROM e")
def _(spark, sf):
    return events(spark, sf).select(F.col("event_id").cast("string").alias("key"), "ms", F.upper("event_type").alias("kind"), F.lower(F.upper("event_type")).alias("source_type"))


@query("filters", f"WITH {E} SELECT event_id FROM e WHERE event_type IN ('error', 'view') AND ms >= 1704500000000 AND value BETWEEN 10 AND 50")
def _(spark, sf):
    return events(spark, sf).where(F.col("event_type").isin("error", "view") & (F.col("ms") >= 1_704_500_000_000) & F.col("value").between(10, 50)).select("event_id")


@query("json_decode", f"WITH {E} SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM e")
def _(spark, sf):
    return events(spark, sf).select("event_id", decode_json(F.col("props"), StructType([StructField("k", IntegerType())]))["k"].alias("k"))


@query("omit_null_json", f"WITH {SCORED} SELECT event_id, CASE WHEN anomaly_label IS NULL THEN '{{\"event_id\":' || event_id || ',\"sensor_type\":\"' || sensor_type || '\"}}' ELSE '{{\"event_id\":' || event_id || ',\"sensor_type\":\"' || sensor_type || '\",\"anomaly_label\":' || anomaly_label || '}}' END AS value FROM scored")
def _(spark, sf):
    return v.scored(spark, sf).select("event_id", F.to_json(F.struct("event_id", "sensor_type", "anomaly_label")).alias("value"))


@query("ordered_replay", f"WITH {E} SELECT event_id, ms FROM e WHERE event_type = 'purchase' ORDER BY ms, event_id")
def _(spark, sf):
    return events(spark, sf).where(F.col("event_type") == v.LEFT).select("event_id", "ms").orderBy("ms", "event_id")


@query("replay_rebased", f"WITH {E}, p AS (SELECT event_id, ms FROM e WHERE event_type = 'purchase'), l AS (SELECT unnest([1, 2, 3]) AS loop) SELECT event_id, CAST(loop AS BIGINT) AS loop, ms + (loop - 1) * ((SELECT max(ms) - min(ms) FROM p) + 1000) AS replay_ms FROM p, l")
def _(spark, sf):
    return replay(events(spark, sf).where(F.col("event_type") == v.LEFT).select("event_id", "ms"), "ms", 3).select("event_id", "loop", "replay_ms")


# Joins. Customers of odd nations stand for rows that have gone from the right side.
@query("left_join_orphans", "SELECT o_orderkey, c_name, c_acctbal FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_nationkey % 2 = 0) ON o_custkey = c_custkey")
def _(spark, sf):
    right = table(spark, sf, "customer").where("c_nationkey % 2 = 0").select("c_custkey", "c_name", "c_acctbal")
    return v.orders(spark, sf).join(right, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name", "c_acctbal")


@query("match_count", "SELECT count(*) AS matched FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey % 2 = 0)")
def _(spark, sf):
    right = table(spark, sf, "customer").where("c_nationkey % 2 = 0")
    return v.orders(spark, sf).join(right, F.col("o_custkey") == F.col("c_custkey"), "left_semi").agg(F.count(F.lit(1)).alias("matched"))


@query("resolution_counts", f"WITH {FUSED}, l AS (SELECT event_id FROM e WHERE event_id % 5 <> 0), r AS (SELECT event_id, value FROM e WHERE event_id % 7 <> 0) SELECT count(*) AS total, count_if(l.event_id IS NOT NULL AND r.event_id IS NOT NULL) AS both_sides, count_if(r.value > 50) AS feature_bearing FROM fused LEFT JOIN l ON aid = l.event_id LEFT JOIN r ON sid = r.event_id")
def _(spark, sf):
    e = events(spark, sf)
    left, right = e.where("event_id % 5 != 0").select(F.col("event_id").alias("l")), e.where("event_id % 7 != 0").select(F.col("event_id").alias("r"), "value")
    joined = v.fused(spark, sf).join(left, F.col("aid") == F.col("l"), "left").join(right, F.col("sid") == F.col("r"), "left")
    return joined.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("both_sides"), F.count_if(F.col("value") > 50).alias("feature_bearing"))


@query("split_membership", f"WITH {E}, t AS (SELECT event_id FROM e WHERE event_id % 5 = 0) SELECT event_id, event_id IN (SELECT event_id FROM t) AS is_test FROM e")
def _(spark, sf):
    e = events(spark, sf)
    test = e.where("event_id % 5 = 0").select("event_id")
    return e.join(test, "event_id", "left_semi").select("event_id", F.lit(True).alias("is_test")).unionByName(e.join(test, "event_id", "left_anti").select("event_id", F.lit(False).alias("is_test")))


@query("upsert_ignore", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def _(spark, sf):
    o = v.orders(spark, sf)
    target, batch = o.where("o_orderdate < '1998-01-01'"), o.unionByName(o.where("o_orderkey % 3 = 0"))
    return insert_ignore(target, batch, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("keyed_update", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders")
def _(spark, sf):
    o = v.orders(spark, sf).select("o_orderkey", "o_totalprice")
    return write_back(o, o.where("o_orderkey % 4 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2), ["o_orderkey"], ["o_totalprice"])


@query("promotion", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'promoted' ELSE o_orderstatus END AS load_status FROM orders")
def _(spark, sf):
    staging = v.orders(spark, sf).select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "validated").otherwise(F.col("o_orderstatus")).alias("load_status"), "o_totalprice")
    return promote(staging, F.col("o_totalprice") > 100_000)[1].select("o_orderkey", "load_status")


@query("promotion_strict", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 100000 THEN 'promoted' WHEN o_orderstatus = 'O' THEN 'validated' ELSE o_orderstatus END AS load_status FROM orders")
def _(spark, sf):
    staging = v.orders(spark, sf).select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "validated").otherwise(F.col("o_orderstatus")).alias("load_status"), "o_totalprice")
    return promote(staging, F.col("o_totalprice") > 100_000, strict=True)[1].select("o_orderkey", "load_status")


# Windows.
@query("sequence_rules", f"WITH {E} SELECT event_id, CASE WHEN event_id - lag(event_id) OVER w > 1 THEN 'sequence_gap' WHEN ms - lag(ms) OVER w <= 0 THEN 'timestamp_not_advancing' END AS rule FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ms, event_id)")
def _(spark, sf):
    return sequence_rules(events(spark, sf), "user_id", ["ms", "event_id"], "event_id", "ms").select("event_id", "rule")


@query("rules_on_full_stream", f"WITH {FUSED}, n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ms, event_id) * (1 + event_id % 2) AS seq FROM e WHERE ms BETWEEN (SELECT min(a_ms) - 60000 FROM fused) AND (SELECT max(a_ms) FROM fused)), f AS (SELECT event_id, CASE WHEN seq - lag(seq) OVER w > 1 THEN 'sequence_gap' WHEN ms - lag(ms) OVER w <= 0 THEN 'timestamp_not_advancing' END AS rule FROM n WINDOW w AS (PARTITION BY user_id ORDER BY ms, seq)) SELECT aid, sid, rule FROM fused LEFT JOIN f ON sid = event_id")
def _(spark, sf):
    fused = v.fused(spark, sf).withColumnsRenamed({"a_ms": "timestamp_ms", "sid": "sensor_event_id"})
    span = fused.agg(F.min("timestamp_ms").alias("lo"), F.max("timestamp_ms").alias("hi"))
    around = events(spark, sf).join(F.broadcast(span), (F.col("ms") >= F.col("lo") - 60_000) & (F.col("ms") <= F.col("hi"))).drop("lo", "hi")
    stream = numbered(around, ["user_id"], ["ms", "event_id"], "seq").withColumn("seq", F.col("seq") * (1 + F.col("event_id") % 2))
    return rules_for(fused, stream, "user_id", "seq", "ms").select("aid", F.col("sensor_event_id").alias("sid"), "rule")


@query("ecdf_risk", f"WITH {E} SELECT x.event_id, round((SELECT count(*) FROM e r WHERE r.event_type = x.event_type AND r.event_id % 5 <> 0 AND r.value <= x.value) / (SELECT count(*) FROM e r WHERE r.event_type = x.event_type AND r.event_id % 5 <> 0), 9) AS risk FROM e x")
def _(spark, sf):
    e = events(spark, sf).select("event_id", "event_type", "value")
    return ecdf_risk(e, e.where("event_id % 5 != 0"), "value", "event_type").select("event_id", F.round("risk", 9).alias("risk"))


@query("lateness_class", f"WITH {E}, j AS (SELECT *, ms - (event_id * 7919 % 20000) AS t, max(ms - (event_id * 7919 % 20000)) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM e) SELECT event_id, CASE WHEN high IS NULL OR t > high THEN 'on_time' WHEN high - t >= 5000 THEN 'late_beyond' ELSE 'late_tolerated' END AS lateness FROM j")
def _(spark, sf):
    e = events(spark, sf).withColumn("t", F.col("ms") - F.col("event_id") * 7919 % 20_000)
    return lateness(e, "event_type", "t", "event_id").select("event_id", "lateness")


@query("latest_per_key", f"WITH {E} SELECT user_id, event_id, ms FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ms DESC, event_id DESC) = 1")
def _(spark, sf):
    return latest(events(spark, sf), "user_id", "ms", "event_id").select("user_id", "event_id", "ms")


@query("sliding_rate", f"WITH {E}, k AS (SELECT ms, unnest(range(0, 60)) AS i FROM e WHERE event_type = 'error') SELECT make_timestamp(((ms // 1000) - i) * 1000000) AS window_start, count(*) AS n FROM k GROUP BY 1")
def _(spark, sf):
    e = events(spark, sf).where("event_type = 'error'")
    return sliding_counts(e, "ms").select(F.timestamp_seconds("window_start_s").cast("timestamp_ntz").alias("window_start"), "n")


@query("inter_arrival", f"WITH {E} SELECT event_id, ms - lag(ms) OVER (PARTITION BY event_type ORDER BY ms, event_id) AS gap_ms FROM e")
def _(spark, sf):
    return inter_arrival(events(spark, sf), "event_type", "ms", "event_id").select("event_id", "gap_ms")


@query("rolling_rate", f"WITH {E} SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY ms // 1000 RANGE BETWEEN 600 PRECEDING AND CURRENT ROW) AS rolling_count FROM e")
def _(spark, sf):
    return rolling_rate(events(spark, sf), "event_type", "ms", 600).select("event_id", "rolling_count")


@query("arrival_order", f"WITH {E} SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS arrival_no FROM e")
def _(spark, sf):
    return numbered(events(spark, sf), ["event_type"], ["event_id"], "arrival_no").select("event_id", "arrival_no")


# Order, pages, sets.
@query("newest_five", f"WITH {SCORED} SELECT event_id, timestamp_ms FROM scored WHERE anomaly_label = 1 ORDER BY timestamp_ms DESC, event_id LIMIT 5")
def _(spark, sf):
    return v.scored(spark, sf).where("anomaly_label = 1").orderBy(F.desc("timestamp_ms"), "event_id").limit(5).select("event_id", "timestamp_ms")


@query("recent_by_risk", f"WITH {SCORED} SELECT fused_event_id, risk_score, timestamp_ms FROM scored ORDER BY risk_score DESC, timestamp_ms DESC, fused_event_id LIMIT 50")
def _(spark, sf):
    return recent(v.scored(spark, sf), "risk_desc", 50).select("fused_event_id", "risk_score", "timestamp_ms")


@query("page", f"WITH {SCORED} SELECT fused_event_id, risk_score FROM scored ORDER BY risk_score DESC, timestamp_ms DESC, fused_event_id LIMIT 25 OFFSET 50")
def _(spark, sf):
    return page(v.scored(spark, sf), 3)[0].select("fused_event_id", "risk_score")


@query("page_totals", f"WITH {SCORED} SELECT 3 AS page, count(*) AS total, CAST(ceil(count(*) / 25.0) AS BIGINT) AS total_pages FROM scored")
def _(spark, sf):
    return page(v.scored(spark, sf), 3)[1]


@query("top_features", """
    WITH x AS (SELECT vec_id, i AS feature, CAST(embedding[i] AS DOUBLE) AS shap_value, row_number() OVER (PARTITION BY vec_id ORDER BY abs(embedding[i]) DESC, i) AS r FROM embeddings, (SELECT unnest(range(1, 9)) AS i))
    SELECT vec_id, string_agg(CAST(feature AS VARCHAR), ',' ORDER BY r) AS top FROM x WHERE r <= 3 GROUP BY vec_id""")
def _(spark, sf):
    shap = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.struct(i.cast("string").alias("feature"), F.get("embedding", i - 1).cast("double").alias("shap_value"), F.lit("up").alias("direction")))
    e = table(spark, sf, "embeddings").withColumn("shap", shap)
    return e.select("vec_id", F.array_join(F.transform(top_features("shap"), lambda x: x["feature"]), ",").alias("top"))


@query("strata_left", f"WITH {E} SELECT event_type, count(*) - count_if(event_id % 5 = 0) AS n FROM e GROUP BY 1")
def _(spark, sf):
    e = events(spark, sf)
    return strata_left(e, e.where("event_id % 5 = 0"), "event_type")


@query("pooled_results", f"WITH {E} SELECT event_type AS stream, count(*) AS n, round(avg(value), 6) AS mean FROM e GROUP BY 1")
def _(spark, sf):
    e = events(spark, sf)
    parts = {k: e.where(F.col("event_type") == k).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("mean")) for k in (v.LEFT, *v.RIGHTS)}
    return pooled(parts)


@query("stratified_split", f"WITH {E}, r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY CAST('0x' || substr(md5('42:' || event_id), 1, 15) AS BIGINT), event_id) AS k, count(*) OVER (PARTITION BY event_type) AS n FROM e) SELECT event_id, event_type, k <= round(n * 0.2) AS is_test FROM r")
def _(spark, sf):
    return stratified_split(events(spark, sf), "event_id", F.col("event_type")).select("event_id", "event_type", "is_test")


@query("time_buckets", f"WITH {E} SELECT event_id, ms // 300000 * 300000 AS bucket, ms // 86400000 * 86400000 AS day FROM e")
def _(spark, sf):
    return events(spark, sf).select("event_id", time_bucket(F.col("ms"), 300_000).alias("bucket"), time_bucket(F.col("ms"), 86_400_000).alias("day"))
