"""Streaming jobs: windowed counts, staging, fusion; each takes frames, so that sources and sinks are the caller's."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from eventloom.operators.fusion import union_all
from eventloom.operators.sinks import append_alignment_log, append_ignore, fused_rows, heartbeats, with_audit
from eventloom.operators.validation import Enforced
from eventloom.storage import path_exists

WATERMARK, TRIGGER = "5 seconds", "5 seconds"


def counts(stream: DataFrame, ts: str, by: str, width: str = "5 seconds", watermark: str | None = WATERMARK, slide: str | None = None) -> DataFrame:
    """Rows in each window and group of a stream (or table)."""
    marked = stream.withWatermark(ts, watermark) if watermark else stream
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    return marked.groupBy(window, by).agg(F.count(F.lit(1)).alias("count")).select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), by, "count")


def update_counts(counted: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Writes what each batch has changed, in a folder for each batch: windows come again as often as they change."""

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = counted.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.queryName(name) if name else writer).trigger(**(trigger or {"processingTime": TRIGGER})).start()


def fusion_stream(left: DataFrame, rights: dict[str, DataFrame], window_ms: int, watermark: str = WATERMARK, id_col: str = "event_id", ms_col: str = "ms") -> DataFrame:
    """Nearest matches of streams: each right stream has a watermark of its own before the union, and the slowest governs."""
    return fusion_outer_stream(left, rights, window_ms, watermark, id_col, ms_col).where("sid IS NOT NULL")


def fusion_outer_stream(left: DataFrame, rights: dict[str, DataFrame], window_ms: int, watermark: str = WATERMARK, id_col: str = "event_id", ms_col: str = "ms") -> DataFrame:
    """The same with left rows that found no partner: these have nulls.

    No pairs are made. Time is cut into slots as long as the window; of three slots that follow each other, a group of the
    stream holds the rows of the middle one, the last right row of the first and the first of the third, so a left row's
    nearest right row is in the group that has it in the middle. A group comes out once every watermark has passed it; work and state grow with its rows.
    """
    kinds, slot = list(rights), max(window_ms, 1)
    at, none = F.timestamp_millis(F.col(ms_col)).alias("at"), F.lit(None).cast("string")
    sides = [left.select(at, F.lit(True).alias("left"), F.col(id_col).alias("id"), F.col(ms_col).cast("bigint").alias("ms"), none.alias("kind"))]
    sides += [rights[k].select(at, F.lit(False).alias("left"), F.col(id_col).alias("id"), F.col(ms_col).cast("bigint").alias("ms"), F.lit(k).alias("kind")) for k in kinds]
    rows = union_all([s.withWatermark("at", watermark) for s in sides])
    slots = rows.withColumn("slots", F.window("at", f"{3 * slot} milliseconds", f"{slot} milliseconds"))
    place = F.floor((F.col("ms") - F.unix_millis("slots.start")) / slot)
    slots = slots.withColumn("place", place).where("NOT left OR place = 1")
    found, right = F.struct(F.col("ms").alias("s_ms"), F.col("id").alias("sid"), F.col("kind").alias("sensor_type")), ~F.col("left")
    grouped = slots.groupBy("slots").agg(
        F.collect_set(F.when(F.col("left"), F.struct(F.col("id").alias("aid"), F.col("ms").alias("a_ms")))).alias("lefts"),
        F.collect_list(F.when(right & (F.col("place") == 1), found)).alias("rights"),
        F.min(F.when(right & (F.col("place") == 0), F.struct(-F.col("ms"), found.alias("row"))))["row"].alias("low"),  # of the last time, the smallest id
        F.min(F.when(right & (F.col("place") == 2), found)).alias("high"),
    )
    asked = grouped.where(F.size("lefts") > 0).select("lefts", F.sort_array(F.concat(F.array_compact(F.array("low", "high")), "rights")).alias("rights"))
    kind = left.schema[id_col].dataType.simpleString()
    return asked.mapInArrow(_nearest_of_groups(window_ms), f"aid {kind}, a_ms bigint, sid {kind}, s_ms bigint, sensor_type string, abs_dt bigint")


def _nearest_of_groups(window_ms: int):
    """For each group's left rows the nearest of its right rows, which are in order of time and id, or nulls."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lefts, rights in zip(batch.column("lefts"), batch.column("rights"), strict=True):
                (aid, a_ms), (s_ms, sid, kind) = lefts.values.flatten(), rights.values.flatten()
                t, ms = s_ms.to_numpy(zero_copy_only=False), a_ms.to_numpy(zero_copy_only=False)
                times, first = np.unique(t, return_index=True)  # the first row of a time has its smallest id
                best, away = np.zeros(len(ms), np.int64), np.full(len(ms), window_ms + 1, np.int64)
                if len(times):
                    after = np.searchsorted(times, ms, "right")
                    low, high = np.maximum(after - 1, 0), np.minimum(after, len(times) - 1)
                    nearer = np.where(np.abs(ms - times[low]) <= np.abs(times[high] - ms), low, high)
                    best, away = first[nearer], np.abs(times[nearer] - ms)
                lost = away > window_ms
                at = pa.array(best, mask=lost)
                yield pa.RecordBatch.from_arrays([aid, a_ms, sid.take(at), s_ms.take(at), kind.take(at), pa.array(away, mask=lost)], ["aid", "a_ms", "sid", "s_ms", "sensor_type", "abs_dt"])

    return nearest


def write_match_rate(matches: DataFrame, path: str, rate_path: str, checkpoint: str, trigger: dict | None = None, name: str = "match_rate") -> StreamingQuery:
    """Writes matched and unmatched left rows, and for each batch that isn't empty how many were matched; a retry writes over itself."""

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/batch={number}")
        written = df.sparkSession.read.schema(df.schema).parquet(f"{path}/batch={number}")
        counts = written.agg(F.count("sid").alias("matched"), F.count(F.lit(1)).alias("total")).where("total > 0")
        counts.withColumn("rate", F.col("matched") / F.col("total")).write.mode("overwrite").parquet(f"{rate_path}/batch={number}")

    return matches.writeStream.queryName(name).outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": TRIGGER})).start()


def deduplicated(stream: DataFrame, id_col: str, ts: str, within: str = "10 seconds") -> DataFrame:
    return stream.where(F.col(id_col).isNotNull()).withWatermark(ts, within).dropDuplicatesWithinWatermark([id_col])


def stage(stream: DataFrame, path: str, checkpoint: str, check, keys: tuple[str, ...] = ("event_id",), sensor: bool = True, trigger: dict | None = None, name: str = "staging") -> StreamingQuery:
    """Writes what check (rows -> Enforced) lets through, with audit columns, each key once; a batch that is tried again writes over itself."""

    def batch(df: DataFrame, number: int) -> None:
        passed: Enforced = check(df)
        valid = passed.valid.persist()
        try:
            if not valid.isEmpty():
                append_ignore(with_audit(valid, F.current_timestamp(), f"{name}-{number}", sensor), path, list(keys), number)
        finally:
            valid.unpersist()

    return stream.writeStream.queryName(name).foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": TRIGGER})).start()


def write_fused(matches: DataFrame, path: str, status_path: str, checkpoint: str, window_ms: int, log_path: str | None = None, trigger: dict | None = None, name: str = "fusion") -> StreamingQuery:
    """Fused rows once for each (timestamp_ms, alice_event_id), two heartbeats and a line of distances for each batch that isn't empty."""

    def batch(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            if df.isEmpty():
                return
            now = F.unix_millis(F.current_timestamp())
            rows = fused_rows(df, window_ms, now)
            append_ignore(rows, path, ["timestamp_ms", "alice_event_id"], number)
            heartbeats(rows, F.current_timestamp()).write.mode("overwrite").parquet(f"{status_path}/batch={number}")
            if log_path:
                append_alignment_log(df, number, F.current_timestamp(), log_path)
        finally:
            df.unpersist()

    return matches.writeStream.queryName(name).outputMode("append").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": TRIGGER})).start()


def checkpoint_of(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def has_checkpoint(spark: SparkSession, path: str) -> bool:
    """Whether a query has begun there: its offsets folder is there and not empty."""
    if not path_exists(spark, f"{path}/offsets"):
        return False
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/offsets")
    return len(folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)) > 0


class LateRows(StreamingQueryListener):
    """Counts rows that watermarks have dropped, by query."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.dropped[p.name or str(p.id)] = self.dropped.get(p.name or str(p.id), 0) + late


def dropped_rows(query: StreamingQuery) -> int:
    """Rows that the query's recent batches have dropped as late."""
    return sum(s.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for s in p.get("stateOperators", []))


def drain(query: StreamingQuery, wait_s: float = 60.0) -> bool:
    """Stops a query between two batches, so that a running one ends and is committed; True if it did within wait_s.

    A batch that takes longer than that is interrupted, and done again by the next start.
    """
    end, between = time.monotonic() + wait_s, False
    while not between and time.monotonic() < end:
        between = not query.isActive or not query.status["isTriggerActive"]
        if not between:
            time.sleep(0.002)
    query.stop()
    return between


def run_all(spark: SparkSession, queries: list[StreamingQuery], stop: threading.Event, poll_s: float = 1.0, drain_s: float = 60.0) -> dict[str, str]:
    """Waits until stop is set or every query has ended; one that fails leaves the others running, running batches end first.

    A failure is raised at the end, so that the process doesn't end as if all were well.
    """
    failed: dict[str, str] = {}
    active = list(queries)
    while active and not stop.is_set():
        for q in list(active):
            if not q.isActive:
                active.remove(q)
                if q.exception() is not None:
                    failed[q.name or str(q.id)] = str(q.exception())
                spark.streams.resetTerminated()
        stop.wait(poll_s)
    threads = [threading.Thread(target=drain, args=(q, drain_s)) for q in active]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failed:
        raise RuntimeError(f"queries failed: {failed}")
    return failed
