"""Queries over tables that are kept and changed: indexed inserts, write-backs to touched partitions, rollups that are kept up to date."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import detectors as d
from eventloom.operators import indexed as ix
from eventloom.operators.jobs import run_batch_scoring
from eventloom.operators.partitioned import Rollup, write_back_partitions
from eventloom.operators.rollups import sketch_quantile
from eventloom.operators.sinks import append_alignment_log, in_order, write_ids, write_parquet
from eventloom.schemas import SENSOR_EVENT
from eventloom.sources.files import alignment_samples, events, ids, parquet_or_empty
from eventloom.storage import fresh_path, stored

from . import views as v
from .views import E, FUSED, SCORED

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


@query("upsert_ignore_indexed", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def _(spark, sf):
    # Two batches of older orders are there; the third has all orders, a third of them twice, and leaves the new ones.
    o = v.orders(spark, sf)
    path, layout = fresh_path(spark, "indexed"), ix.Layout.for_ids(o.count())
    old = o.where("o_orderdate < '1998-01-01'")
    ix.append_indexed(old.where("o_orderkey % 2 = 0"), path, "o_orderkey", 0, layout)
    ix.append_indexed(old, path, "o_orderkey", 1, layout)
    ix.append_indexed(o.unionByName(o.where("o_orderkey % 3 = 0")), path, "o_orderkey", 2, layout)
    return ix.indexed_rows(spark, path, 2).select("o_orderkey", "o_custkey")


@query("write_back_days", f"WITH {E} SELECT event_id, CASE WHEN event_id % 4 = 0 AND day % 3 = 0 THEN value * 2 ELSE value END AS value, day FROM (SELECT *, ms // 86400000 AS day FROM e)")
def _(spark, sf):
    path = fresh_path(spark, "days")
    e = events(spark, sf).select("event_id", "value", F.floor(F.col("ms") / 86_400_000).cast("int").alias("day"))
    e.repartition("day").write.partitionBy("day").parquet(path)
    updates = e.where("event_id % 4 = 0 AND day % 3 = 0").select("day", "event_id", (F.col("value") * 2).alias("value"))
    write_back_partitions(spark, path, updates, ["event_id"], ["value"], ["day"])
    return spark.read.parquet(path).select("event_id", "value", F.col("day").cast("bigint").alias("day"))


@query("incremental_rollup", f"""
    WITH {SCORED}
    SELECT timestamp_ms // 300000 * 300000 AS bucket, sensor_type, count(*) AS event_count, round(avg(data_loss_pct), 9) AS avg_data_loss, round(avg(latency_ms), 9) AS avg_latency,
        round(avg(CASE WHEN anomaly_label IN (0, 1) THEN anomaly_label END), 9) AS anomaly_rate, true AS p95_in_bounds
    FROM scored GROUP BY 1, 2""")
def _(spark, sf):
    # A first batch, and two that bring rows for buckets that were refreshed long ago.
    s = v.scored(spark, sf)
    rollup, turn = Rollup(fresh_path(spark, "rollup")), F.col("event_id") % 10
    for n, rows in enumerate([s.where(turn < 8), s.where(turn == 8), s.where(turn == 9)]):
        rollup.add(rows, n)
        rollup.refresh(spark)
    # The percentile of the merged sketch is one of the bucket.s latencies, so it lies between the least and the largest.
    bounds = s.groupBy(F.expr("timestamp_ms div 300000 * 300000").alias("bucket"), "sensor_type").agg(F.min("latency_ms").alias("low"), F.max("latency_ms").alias("high"))
    both = rollup.read(spark).join(bounds, ["bucket", "sensor_type"])
    return both.select("bucket", "sensor_type", "event_count", *[F.round(c, 9).alias(c) for c in ("avg_data_loss", "avg_latency", "anomaly_rate")], sketch_quantile(F.col("latency_sketch"), 0.95).between(F.col("low"), F.col("high")).alias("p95_in_bounds"))


@query("incremental_rollup_days", f"WITH {SCORED} SELECT DISTINCT timestamp_ms // 86400000 AS day FROM scored WHERE event_id % 50 = 7")
def _(spark, sf):
    # Which days a refresh takes up after a late batch: those of its rows, no others.
    s = v.scored(spark, sf)
    rollup = Rollup(fresh_path(spark, "rollup"))
    rollup.add(s.where("event_id % 50 != 7"), 0)
    rollup.refresh(spark)
    rollup.add(s.where("event_id % 50 = 7"), 1)
    days = rollup.refresh(spark)
    return spark.createDataFrame([(d,) for d in days], "day bigint")


@query("parquet_or_empty", f"WITH {E} SELECT event_type, count(*) AS n FROM e GROUP BY 1")
def _(spark, sf):
    rows = events(spark, sf).select("event_id", "event_type")
    path = fresh_path(spark, "there")
    rows.write.parquet(path)
    both = parquet_or_empty(spark, path, rows.schema).unionByName(parquet_or_empty(spark, fresh_path(spark, "absent"), rows.schema))
    return both.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("test_id_list", f"WITH {E} SELECT event_id, value FROM e WHERE event_id % 5 = 0")
def _(spark, sf):
    # The ids of a test split go to a file, one a line, and choose the split's rows again.
    e, path = events(spark, sf), fresh_path(spark, "ids")
    write_ids(e.where("event_id % 5 = 0"), "event_id", path)
    return e.join(ids(spark, path), F.col("event_id").cast("string") == F.col("id"), "left_semi").select("event_id", "value")


@query("alignment_log", f"WITH {FUSED} SELECT CAST(aid % 4 AS BIGINT) AS batch_id, count(*) AS n, min(abs_dt) AS low, max(abs_dt) AS high, CAST(sum(abs_dt) AS BIGINT) AS total FROM fused WHERE aid % 4 IN (1, 2) GROUP BY 1")
def _(spark, sf):
    # Four batches write a line of distances each; two of them are read back.
    fused, path = stored(v.fused(spark, sf), "fused"), fresh_path(spark, "log")
    for n in range(4):
        append_alignment_log(fused.where(F.col("aid") % 4 == n), n, F.current_timestamp(), path)
    rows = alignment_samples(spark, path, batches=(1, 2))
    return rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.min("abs_dt").alias("low"), F.max("abs_dt").alias("high"), F.sum("abs_dt").alias("total"))


@query("overwrite_count", f"WITH {E} SELECT (SELECT count(*) FROM e) AS first_written, (SELECT count(*) FROM e WHERE event_id % 2 = 0) AS then_written, event_id, value FROM e WHERE event_id % 2 = 0")
def _(spark, sf):
    e, path = events(spark, sf).select("event_id", "value"), fresh_path(spark, "dataset")
    first, then = write_parquet(e, path), write_parquet(e.where("event_id % 2 = 0"), path)
    return spark.read.parquet(path).select(F.lit(first).cast("bigint").alias("first_written"), F.lit(then).cast("bigint").alias("then_written"), "event_id", "value")


@query("split_by_type", f"WITH {E} SELECT event_id, value FROM e WHERE event_type = 'error'")
def _(spark, sf):
    path = fresh_path(spark, "by_type")
    write_parquet(events(spark, sf).select("event_id", "value", "event_type"), path, by=["event_type"])
    return spark.read.parquet(f"{path}/event_type=error")


@query("schema_projection", f"WITH {E} SELECT event_id, event_type, value, CAST(NULL AS VARCHAR) AS absent FROM e")
def _(spark, sf):
    return in_order(events(spark, sf), ["value", "absent", "event_type", "event_id"]).withColumn("absent", F.col("absent").cast("string"))


def radar_corpus(rows):
    test = rows.where("n % 5 = 0").select(F.col("event_id").alias("id"))
    return stored(d.load_corpus(rows, "radar", test, None), "corpus")


@query("detector_saved", f"WITH {E} SELECT CAST(event_id AS VARCHAR) AS event_id, event_type = 'error' AND value > 60 AS anomaly, true AS same_after_load, true AS flagged_if_anomaly FROM e WHERE event_id % 5 = 0")
def _(spark, sf):
    # Both detectors are trained on four fifths of the events, kept, loaded, and must score the last fifth as before; all planted anomalies alarm.
    corpus, path = radar_corpus(v.radar_rows(spark, sf)), fresh_path(spark, "model")
    model, test = d.train_stream(corpus, "radar"), corpus.where("is_test")
    model.save(path)
    seen = lambda m, name: stored(m.score(test).select("event_id", (F.col("label") == 1).alias("anomaly"), (F.col("anomaly_label") == 1).alias("flagged"), F.round("risk_score", 9).alias("risk")), name)
    first, again = seen(model, "first"), seen(d.StreamModel.load(spark, path), "again")
    both = first.join(again.select("event_id", F.col("risk").alias("risk2"), F.col("flagged").alias("flagged2")), "event_id")
    same = F.col("risk").eqNullSafe(F.col("risk2")) & (F.col("flagged") == F.col("flagged2"))
    return both.select("event_id", "anomaly", same.alias("same_after_load"), (~F.col("anomaly") | F.col("flagged")).alias("flagged_if_anomaly"))


SINCE = 1_704_500_000_000


@query("batch_scoring", f"WITH {E} SELECT CAST(event_id AS VARCHAR) AS sensor_event_id, event_id % 7 <> 0 AND ms >= {SINCE} AS scored, true AS rollup_agrees FROM e")
def _(spark, sf):
    # Every event is a fused row, six of seven have their staging row: from a time on these get scores, all others keep their nulls.
    rows = stored(v.radar_rows(spark, sf), "radar")
    model = d.train_stream(radar_corpus(rows), "radar")
    there = rows.where("n % 7 != 0")
    staging = there.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in there.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in SENSOR_EVENT])
    empty = {c: F.lit(None).cast(kind) for c, kind in (("anomaly_label", "int"), ("risk_score", "double"), ("confidence", "double"))}
    fused = rows.select(F.concat(F.lit("f"), "event_id").alias("fused_event_id"), F.col("event_id").alias("sensor_event_id"), "sensor_type", "timestamp_ms", F.lit(0.0).alias("data_loss_pct"), F.lit(5.0).alias("latency_ms")).withColumns(empty)
    stats = spark.createDataFrame([], "parameter_name string, mean double, std double, n long")
    done = run_batch_scoring(fused, staging, {"radar": model}, stats, fresh_path(spark, "summary"), since_ms=SINCE)
    agree = done.checks.select(F.col("agree").alias("rollup_agrees"))  # one row
    return done.fused.select("sensor_event_id", F.col("risk_score").isNotNull().alias("scored")).crossJoin(F.broadcast(agree))
