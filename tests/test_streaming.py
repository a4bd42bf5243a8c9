"""Streams of files: matches across batches, late rows, restarts."""

import json
import threading

import pytest
from eventloom.storage import path_exists
from eventloom.streaming import queries as st
from pyspark.sql import functions as F

SCHEMA = "event_id string, ms long"


def put(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps({"event_id": i, "ms": t}) + "\n" for i, t in rows))


def source(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))


def fusion(spark, tmp_path, name):
    left, right = source(spark, tmp_path / "left"), {k: source(spark, tmp_path / k) for k in ("radar", "lidar")}
    return st.fusion_stream(left, right, 500).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/cp-{name}").start()


def test_a_later_and_closer_match_wins(spark, tmp_path):
    put(tmp_path / "left", "1", ("a", 100_000), ("b", 100_010))
    put(tmp_path / "radar", "1", ("far", 100_300))
    put(tmp_path / "lidar", "1", ("other", 99_400))
    q = fusion(spark, tmp_path, "closer")
    q.processAllAvailable()
    put(tmp_path / "radar", "2", ("near", 100_050))
    q.processAllAvailable()
    for flush in (200_000, 300_000):  # every input must move on before anything comes out
        for folder in ("left", "radar", "lidar"):
            put(tmp_path / folder, str(flush), (f"f{flush}-{folder}", flush))
            q.processAllAvailable()
    q.stop()
    got = {r.aid: r.sid for r in spark.table("closer").collect()}
    assert got["a"] == "near" and got["b"] == "near"


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    put(tmp_path / "in", "1", ("a", 100_000), ("b", 200_000))
    counted = st.counts(source(spark, tmp_path / "in").withColumn("ts", F.timestamp_millis("ms")).withColumn("k", F.lit("x")), "ts", "k")
    q = counted.writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp").start()
    q.processAllAvailable()
    put(tmp_path / "in", "2", ("late", 100_000))
    q.processAllAvailable()
    assert st.dropped_rows(q) == 1
    q.stop()


def test_restart_writes_nothing_twice(spark, tmp_path):
    put(tmp_path / "left", "1", ("a", 100_000))
    put(tmp_path / "radar", "1", ("s", 100_100))
    put(tmp_path / "lidar", "1", ("t", 100_200))
    for folder in ("left", "radar", "lidar"):
        put(tmp_path / folder, "2", (f"f{folder}", 300_000))
        put(tmp_path / folder, "3", (f"g{folder}", 500_000))
    out, beats, cp = (f"file://{tmp_path}/{x}" for x in ("out", "beats", "cp"))
    assert not st.has_checkpoint(spark, cp)
    for _ in range(2):
        m = st.fusion_stream(source(spark, tmp_path / "left"), {k: source(spark, tmp_path / k) for k in ("radar", "lidar")}, 500)
        st.write_fused(m, out, beats, cp, 500, log_path=f"{tmp_path}/log", trigger={"availableNow": True}).awaitTermination()
    assert st.has_checkpoint(spark, cp) and path_exists(spark, beats)
    rows = spark.read.option("recursiveFileLookup", "true").parquet(out)
    assert [r.sensor_event_id for r in rows.where("alice_event_id = 'a'").collect()] == ["s"]
    assert rows.count() == rows.dropDuplicates(["timestamp_ms", "alice_event_id"]).count()


def test_a_failed_query_is_raised(spark, tmp_path):
    put(tmp_path / "in", "1", ("a", 1))

    def broken(df, n):
        raise RuntimeError("broken")

    q = source(spark, tmp_path / "in").writeStream.queryName("broken").foreachBatch(broken).option("checkpointLocation", f"{tmp_path}/cp").start()
    with pytest.raises(RuntimeError, match="broken"):
        st.run_all(spark, [q], threading.Event(), 0.2)
