"""Queries that run a streaming job over the events file to its end and give back what it has written."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions.scalars import event_ms
from eventloom.operators.validation import enforce
from eventloom.schemas import FUSED_EVENT, SENSOR_EVENT
from eventloom.sources.files import events, table
from eventloom.session import state_beyond_memory
from eventloom.storage import fresh_path, path_exists
from eventloom.streaming import queries as st
from eventloom.streaming import state as keyed

from . import views as v
from .views import E

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def stream(spark, sf):
    """The events table as a stream of files, in the columns of events()."""
    raw = spark.readStream.schema(table(spark, sf, "events").schema).parquet(f"{sf}/events.parquet*")
    return raw.select("event_id", event_ms(F.col("ts")).alias("ms"), F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")


def to_end(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@query("stream_window_counts", f"WITH {E} SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS count FROM e GROUP BY 1, 2")
def _(spark, sf):
    out = fresh_path(spark, "counts")
    counts = st.counts(stream(spark, sf), "ts", "event_type", "1 hour")
    # The last update of each window is its count: complete mode writes them all.
    to_end(counts.writeStream.outputMode("complete").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/{n}")).option("checkpointLocation", fresh_path(spark, "cp")).trigger(availableNow=True).start())
    last = spark.read.option("recursiveFileLookup", "true").parquet(out)
    return last.groupBy(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type").agg(F.max("count").alias("count"))


SLIDING = "generate_series(epoch_us(ts) // 1000000 // 600 * 600 - 3000, epoch_us(ts) // 1000000 // 600 * 600, 600)"


@query("stream_sliding", f"WITH {E} SELECT make_timestamp(start * 1000000) AS window_start, event_type, count(*) AS count FROM (SELECT event_type, unnest({SLIDING}) AS start FROM e) GROUP BY 1, 2")
def _(spark, sf):
    # An hour's windows, one every ten minutes: each event is in six of them.
    out = fresh_path(spark, "sliding")
    counts = st.counts(stream(spark, sf), "ts", "event_type", "1 hour", slide="10 minutes")
    to_end(counts.writeStream.outputMode("complete").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/{n}")).option("checkpointLocation", fresh_path(spark, "cp")).trigger(availableNow=True).start())
    last = spark.read.option("recursiveFileLookup", "true").parquet(out)
    return last.groupBy(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type").agg(F.max("count").alias("count"))


@query("stream_updates", f"WITH {E} SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS count FROM e GROUP BY 1, 2")
def _(spark, sf):
    # Update mode: a batch gives the windows that it has changed, so the last update of each is the largest.
    out = fresh_path(spark, "updates")
    source = spark.readStream.schema(table(spark, sf, "events").schema).option("maxFilesPerTrigger", 1)
    parts = fresh_path(spark, "parts")
    table(spark, sf, "events").repartitionByRange(3, "ts").write.parquet(parts)
    rows = source.parquet(parts).select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    to_end(st.update_counts(st.counts(rows, "ts", "event_type", "1 hour", watermark="30 days"), out, fresh_path(spark, "cp"), trigger={"availableNow": True}))
    seen = spark.read.option("recursiveFileLookup", "true").parquet(out)
    return seen.groupBy(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type").agg(F.max("count").alias("count"))


@query("stream_staging", f"WITH {E} SELECT event_id, '1.0' AS schema_version, 'validated' AS load_status FROM (SELECT lpad(CAST(event_id AS VARCHAR), 32, '0') AS event_id FROM e WHERE event_id % 7 <> 0)")
def _(spark, sf):
    i = F.col("event_id")
    own = {"event_id": F.lpad(i.cast("string"), 32, "0"), "sensor_id": F.when(i % 7 != 0, F.col("user_id").cast("string")), "sensor_type": F.lit("TELEMETRY"), "timestamp_ms": F.col("ms"), "value": F.col("value")}
    raw = stream(spark, sf).select(*[own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SENSOR_EVENT])
    out = fresh_path(spark, "staging")
    to_end(st.stage(raw, out, fresh_path(spark, "cp"), lambda df: enforce(df, "sensor_event", SENSOR_EVENT, {"sensor_type": ("RADAR", "LIDAR", "TELEMETRY")}), trigger={"availableNow": True}, name=f"staging-{out[-8:]}"))
    return spark.read.option("recursiveFileLookup", "true").parquet(out).select("event_id", "schema_version", "load_status")


#: Rows of a file that is a batch of its own; times that repeat stay in one file.
ROWS_PER_BATCH = 1_000_000
#: Bytes of a file's row groups: a batch's file is read in several tasks.
ROW_GROUP = 4 << 20


def append_file(rows, folder: str) -> None:
    rows.coalesce(1).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(folder)


def cut_at(rows, order, cuts: list) -> list:
    """The rows cut at these values of order, each with the part that ends with it; nulls come first, empty parts are left out.

    The rows are read once for all parts, which lie in folders of their own then.
    """
    if not cuts:
        return [rows]
    spark, staged = rows.sparkSession, fresh_path(rows.sparkSession, "parts")
    part = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < order))
    rows.withColumn("__part", part).write.partitionBy("__part").parquet(staged)
    folders = [f"{staged}/__part={k}" for k in range(len(cuts) + 1)]
    return [spark.read.schema(rows.schema).parquet(f) for f in folders if path_exists(spark, f)]


def with_flush(spark, sf, step_s: int = 2 * v.WINDOW_MS // 1000):
    """The events as a stream of files, and after them rows of every type one, two and three steps past the end, one file each.

    Matches come out once the slowest stream's watermark has passed their slots, so without later rows the last would be held back.
    """
    folder, raw = fresh_path(spark, "events"), table(spark, sf, "events")
    # Files come one a batch and in order of time: a row of an earlier time in a later file would be late.
    parts = max(1, -(-raw.count() // ROWS_PER_BATCH))
    cuts = raw.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), [k / parts for k in range(1, parts)], 10_000)).first()[0] if parts > 1 else []
    for part in cut_at(raw, F.unix_micros(F.col("ts").cast("timestamp")), sorted(set(cuts or []))):
        append_file(part, folder)
    top = raw.agg(F.max("ts")).first()[0]
    kinds = [v.LEFT, *v.RIGHTS]
    for k in (1, 2, 3):
        rows = [(-(100 * k + i), kind) for i, kind in enumerate(kinds)]
        flush = spark.createDataFrame(rows, "event_id long, event_type string").withColumns({"ts": F.lit(top).cast("timestamp_ntz") + F.expr(f"INTERVAL {step_s * k} SECONDS")})
        flush.select(*[F.col(f.name) if f.name in flush.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in raw.schema]).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return source.select("event_id", event_ms(F.col("ts")).alias("ms"), F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")


@query("stream_fusion", f"WITH {v.FUSED} SELECT CAST(aid AS VARCHAR) AS alice_event_id, CAST(sid AS VARCHAR) AS sensor_event_id, a_ms AS timestamp_ms, sensor_type FROM fused")
def _(spark, sf):
    e = with_flush(spark, sf)
    matches = st.fusion_stream(e.where(F.col("event_type") == v.LEFT), {k: e.where(F.col("event_type") == k) for k in v.RIGHTS}, v.WINDOW_MS)
    out, beats = fresh_path(spark, "fused"), fresh_path(spark, "status")
    to_end(st.write_fused(matches, out, beats, fresh_path(spark, "cp"), v.WINDOW_MS, trigger={"availableNow": True}, name=f"fusion-{out[-8:]}"))
    rows = spark.read.schema(FUSED_EVENT).option("recursiveFileLookup", "true").parquet(out)
    return rows.where(~F.col("alice_event_id").startswith("-")).select("alice_event_id", "sensor_event_id", "timestamp_ms", "sensor_type")


@query("stream_dedup", f"WITH {E} SELECT event_id, count(*) AS n FROM e GROUP BY 1")
def _(spark, sf):
    e = stream(spark, sf)
    out = fresh_path(spark, "dedup")
    to_end(st.deduplicated(e.unionByName(e), "event_id", "ts").writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_path(spark, "cp")).trigger(availableNow=True).start())
    return spark.read.parquet(out).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


def outer_matches(spark, sf):
    """What the outer fusion of the events has written: matched and unmatched rows, and the rate of each batch."""
    e = with_flush(spark, sf)
    rows = st.fusion_outer_stream(e.where(F.col("event_type") == v.LEFT), {k: e.where(F.col("event_type") == k) for k in v.RIGHTS}, v.WINDOW_MS)
    out, rates = fresh_path(spark, "outer"), fresh_path(spark, "rates")
    with state_beyond_memory(spark):
        to_end(st.write_match_rate(rows, out, rates, fresh_path(spark, "cp"), trigger={"availableNow": True}, name=f"rate-{out[-8:]}"))
    found = spark.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(out)
    return found.where("aid >= 0"), spark.read.option("recursiveFileLookup", "true").parquet(rates)


@query("stream_match_rate", f"WITH {v.FUSED} SELECT (SELECT count(*) FROM fused) AS matched, (SELECT count(*) FROM a) AS total, (SELECT count(*) FROM fused) / (SELECT count(*) FROM a) AS rate, true AS batches_add_up")
def _(spark, sf):
    rows, rates = outer_matches(spark, sf)
    found = rows.agg(F.count("sid").alias("matched"), F.count(F.lit(1)).alias("total"))
    # Flush rows are in the batches' counts too: some of them have partners, all have a place.
    summed = rates.agg(F.sum("matched").alias("m"), F.sum("total").alias("t"))
    added = found.crossJoin(F.broadcast(summed))  # two single rows
    return added.select("matched", "total", F.try_divide("matched", "total").alias("rate"), F.col("t").between(F.col("total"), F.col("total") + 3).alias("batches_add_up"))


@query("stream_unmatched", f"WITH {v.FUSED} SELECT aid, a_ms FROM a WHERE aid NOT IN (SELECT aid FROM fused)")
def _(spark, sf):
    return outer_matches(spark, sf)[0].where("sid IS NULL").select("aid", "a_ms")


def restarted(spark, rows, order, parts: int, start, flush=None):
    """What start (stream, folder, checkpoint) writes of rows that come in files in an order, one a batch, with a restart half way."""
    folder, out, checkpoint = (fresh_path(spark, n) for n in ("files", "out", "cp"))
    cuts = rows.agg(F.percentile_approx(order, [k / parts for k in range(1, parts)], 10_000)).first()[0]
    files = [*cut_at(rows.where(order.isNotNull()), order, cuts), *([flush] if flush is not None else [])]
    for k, part in enumerate(files):
        append_file(part.select(*rows.columns), folder)
        if k in (parts // 2, len(files) - 1):
            source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
            with state_beyond_memory(spark):
                to_end(start(source).writeStream.queryName(f"{out[-12:]}-{k}").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return spark.read.parquet(out)


@query("stream_sequence_rules", f"WITH {E} SELECT CAST(event_id AS VARCHAR) AS id, user_id AS device, CASE WHEN event_id - lag(event_id) OVER w > 1 THEN 'sequence_gap' WHEN ms - lag(ms) OVER w <= 0 THEN 'timestamp_not_advancing' END AS rule FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ms, event_id)")
def _(spark, sf):
    # Rows arrive up to an hour out of order, in four batches, with a restart after the third; a last row far ahead lets all come out.
    e = events(spark, sf).select("event_id", "user_id", "ms")
    arrival = F.col("ms") + F.col("event_id") * 7919 % 3_600_000
    flush = e.agg(F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"), (F.max("ms") + 10 * 86_400_000).alias("ms"))
    made = restarted(spark, e, arrival, 4, lambda s: keyed.sequence_rule_stream(s, "user_id", "event_id", "event_id", "ms", "2 hours"), flush)
    return made.where("device >= 0").select("id", "device", "rule")


@query("stream_lateness", f"WITH {E}, j AS (SELECT *, ms - (event_id * 7919 % 20000) AS t, max(ms - (event_id * 7919 % 20000)) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high FROM e) SELECT CAST(event_id AS VARCHAR) AS id, event_type AS stream, CASE WHEN high IS NULL OR t > high THEN 'on_time' WHEN high - t >= 5000 THEN 'late_beyond' ELSE 'late_tolerated' END AS lateness FROM j")
def _(spark, sf):
    e = events(spark, sf).select("event_id", "event_type", (F.col("ms") - F.col("event_id") * 7919 % 20_000).alias("t"))
    return restarted(spark, e, F.col("event_id"), 4, lambda s: keyed.lateness_stream(s, "event_type", "event_id", "t", "event_id"))


@query("stream_restart", f"WITH {E} SELECT event_id, count(*) AS n FROM e GROUP BY 1")
def _(spark, sf):
    # Every event comes twice, a day apart, with a restart between most pairs: what was seen before it is known after it.
    e = events(spark, sf).select("event_id", "ts", F.col("ms").alias("came"))
    twice = e.unionByName(e.withColumn("came", F.col("came") + 86_400_000))
    made = restarted(spark, twice, F.col("came"), 4, lambda s: st.deduplicated(s, "event_id", "ts", "30 days"))
    return made.groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))


LATE = "event_id % 10 = 0 AND ts <= make_timestamp((SELECT max(ms) FROM e WHERE event_id % 10 BETWEEN 1 AND 8) * 1000) - INTERVAL 1 HOUR"


@query("stream_late_rows", f"WITH {E} SELECT (SELECT count(*) FROM e WHERE {LATE}) AS dropped, (SELECT count(*) FROM e WHERE NOT ({LATE})) AS written")
def _(spark, sf):
    # A tenth of the events comes last; what the first batch's watermark has passed is dropped, and counted. (A batch drops
    # by the watermark with which the batch before it ran, so there is one between.)
    e, folder, out = events(spark, sf).select("event_id", "ts"), fresh_path(spark, "late"), fresh_path(spark, "out")
    for part in ("event_id % 10 BETWEEN 1 AND 8", "event_id % 10 = 9", "event_id % 10 = 0"):
        e.where(part).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    with state_beyond_memory(spark):
        q = st.deduplicated(source, "event_id", "ts", "1 hour").writeStream.format("parquet").option("path", out).option("checkpointLocation", fresh_path(spark, "cp")).trigger(availableNow=True).start()
        to_end(q)
    return spark.read.parquet(out).agg(F.lit(st.dropped_rows(q)).cast("bigint").alias("dropped"), F.count(F.lit(1)).alias("written"))
