"""Whole jobs: ingestion, batch scoring, the generators' stream, sinks that other tests don't reach."""

import json
import threading

import pytest
from eventloom.operators import detectors as d
from eventloom.operators import jobs, sinks
from eventloom.schemas import SENSOR_EVENT
from eventloom.sources.generators import generate, generate_stream
from eventloom.storage import stored
from eventloom.streaming import queries as st
from pyspark.sql import functions as F


def test_ingestion(spark, tmp_path):
    rows = [json.loads(r.j) for r in generate(spark, "RADAR", 20, rate=0.0).select(F.to_json(F.struct(*SENSOR_EVENT.names)).alias("j")).collect()]
    bad = [rows[0] | {"schema_version": "2.0"}, rows[1] | {"range_m": "far"}, {n: v for n, v in rows[2].items() if n != "target_id"}]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text("\n".join([*map(json.dumps, rows), "", "{torn", *map(json.dumps, bad), json.dumps(rows[5])]))
    target = f"file://{tmp_path}/staging"
    first = jobs.ingest_ndjson(spark, f"file://{tmp_path}/in", target, SENSOR_EVENT, sensor=True, batch_id="b1")
    assert first == {"malformed": 1, "rejected": 3, "valid": 21, "inserted": 20}
    assert jobs.ingest_ndjson(spark, f"file://{tmp_path}/in", target, SENSOR_EVENT, sensor=True)["inserted"] == 0
    staged = spark.read.parquet(target)
    assert staged.count() == 20 and {(r.batch_id, r.load_status, r.label) for r in staged.select("batch_id", "load_status", "label").distinct().collect()} == {("b1", "validated", 0)}


def test_report_on_files(spark, tmp_path):
    good = {"event_id": "f47ac10b58cc4372a5670e02b2c3d479", "sensor_id": "R-01", "sensor_type": "RADAR", "timestamp_ms": 5, "target_id": "T", "range_m": 1.5, "bearing_deg": 10.0, "elevation_deg": 3.0, "velocity_ms": 1.0, "signal_strength_db": -50.0, "schema_version": "1.0"}
    lines = [json.dumps(good), "", "{torn", json.dumps(good | {"bearing_deg": 400.0}), json.dumps({n: v for n, v in good.items() if n != "range_m"}), json.dumps(good | {"target_id": None, "sensor_type": "RADAR"})]
    (tmp_path / "q.jsonl").write_text("\n".join(lines))
    got = jobs.quality_of_files(spark, f"file://{tmp_path}/q.jsonl", SENSOR_EVENT)
    assert got["report"].first().asDict() == {"total_records": 5, "invalid_json": 1, "schema_failures": 0, "missing_required": 1, "required_nulls": 2, "range_violations": 1}
    assert {(r.check, r.field, r.n) for r in got["fields"].collect()} == {("missing", "range_m", 1), ("null", "range_m", 1), ("null", "target_id", 1), ("range", "bearing_deg", 1), ("sensor_type", "RADAR", 4)}
    assert [(r.line, r.check) for r in got["examples"].collect()] == [(3, "JSON"), (4, "Range"), (5, "Completeness"), (5, "Null"), (6, "Null")]


def test_line_numbers_over_splits(spark, tmp_path):
    from eventloom.sources.files import numbered_lines

    (tmp_path / "a.txt").write_text("".join(f"a{i}\n" if i % 7 else "\n" for i in range(1, 3000)))
    (tmp_path / "b.txt").write_text("b1\nb2")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = {(r.file.rsplit("/", 1)[-1], r.line): r.value for r in numbered_lines(spark, f"file://{tmp_path}").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {("a.txt", i): f"a{i}" for i in range(1, 3000) if i % 7} | {("b.txt", 1): "b1", ("b.txt", 2): "b2"}


def test_topic_adapters():
    """Options of the topic source, with a reader that only notes them: the connector is not here."""
    from types import SimpleNamespace

    from eventloom.sources.files import kafka_stream

    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, kind):
            self.seen["format"] = kind
            return self

        def option(self, key, value):
            self.seen[key] = value
            return self

        def load(self):
            return self.seen

    plain = kafka_stream(SimpleNamespace(readStream=Reader()), "a,b", "host:9092")
    assert plain == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "a,b", "startingOffsets": "latest", "maxOffsetsPerTrigger": 50_000}
    timed = kafka_stream(SimpleNamespace(readStream=Reader()), "a", "host:9092", most_offsets=0, starting_ms=7)
    assert "maxOffsetsPerTrigger" not in timed and (timed["startingTimestamp"], timed["startingOffsetsByTimestampStrategy"]) == (7, "latest")


def test_late_rows_in_shuffled_blocks(spark):
    from eventloom.sources.generators import inject_lateness

    rows = spark.range(1000).select(F.col("id").alias("event_id"), (F.col("id") * 1000).alias("ms"), F.col("id").alias("arrival"))
    got = inject_lateness(rows, "ms", "event_id", 0.1, 1000, 5000, buffer=50).collect()
    assert all(r.arrival // 50 == r.event_id // 50 for r in got) and 40 < sum(r.shift_ms > 0 for r in got) < 160
    assert all((r.shift_ms == 0 or 1000 <= r.shift_ms <= 5000) and r.ms == r.event_id * 1000 - r.shift_ms for r in got)
    order = [r.event_id for r in sorted(got, key=lambda r: r.arrival)]
    assert order != sorted(order)


def test_batch_scoring_job(spark, tmp_path):
    rows = stored(generate(spark, "RADAR", 3000), "radar")
    corpus = stored(d.load_corpus(rows, "radar", rows.where("n % 5 = 0").select(F.col("event_id").alias("id")), None), "corpus")
    models = {"radar": d.train_stream(corpus, "radar")}
    stats = spark.createDataFrame([], "parameter_name string, mean double, std double, n long")
    fused = rows.where("n < 200").select(F.concat(F.lit("f"), "event_id").alias("fused_event_id"), F.col("event_id").alias("sensor_event_id"), "sensor_type", "timestamp_ms").withColumns({
        "data_loss_pct": F.lit(0.0), "latency_ms": F.lit(5.0), "anomaly_label": F.lit(None).cast("int"), "risk_score": F.lit(None).cast("double"), "confidence": F.lit(None).cast("double"),
    })
    since = fused.agg(F.percentile("timestamp_ms", F.lit(0.5)).cast("bigint")).first()[0]
    dry = jobs.run_batch_scoring(fused, rows, models, stats, since_ms=since, dry_run=True)
    late = fused.where(F.col("timestamp_ms") >= since).count()
    assert dry.fused is None and dry.checks is None and dry.scores.count() == late
    path = f"file://{tmp_path}/summary"
    done = jobs.run_batch_scoring(fused, rows, models, stats, path, since_ms=since)
    checks = done.checks.first()
    assert (checks.fused_rows, checks.scored_rows, checks.rolled_events, checks.agree) == (200, late, 200, True) and checks.scored_buckets > 0
    assert done.fused.where(F.col("timestamp_ms") < since).where("risk_score IS NOT NULL").count() == 0
    again = jobs.refresh_rollups(done.fused, path)  # reads the table anew and writes over the rollup
    assert again.agg(F.sum("event_count")).first()[0] == 200 and spark.read.parquet(path).count() == again.count()


def test_endless_generators(spark):
    from pyspark.errors import StreamingQueryException  # noqa: F401

    for kind in ("RADAR", "LIDAR", "TELEMETRY"):
        q = generate_stream(spark, kind, 200, 1_700_000_000_000).writeStream.format("memory").queryName(f"endless_{kind}").start()
        try:
            for _ in range(30):
                q.processAllAvailable()
                if spark.table(f"endless_{kind}").count() >= 200:
                    break
                threading.Event().wait(0.3)
        finally:
            q.stop()
        got = spark.table(f"endless_{kind}")
        assert got.count() >= 200 and got.select("event_id").distinct().count() == got.count() and {r[0] for r in got.select("sensor_type").distinct().collect()} == {kind}


def test_split_and_order(spark, tmp_path):
    rows = spark.createDataFrame([("RADAR", 1), ("LIDAR", 2), ("RADAR", 3)], "sensor_type string, v int")
    assert sinks.write_parquet(rows, f"file://{tmp_path}/s", ["sensor_type"]) == 3
    assert sorted(p.name for p in (tmp_path / "s").iterdir() if p.is_dir()) == ["sensor_type=LIDAR", "sensor_type=RADAR"]
    assert spark.read.parquet(f"file://{tmp_path}/s").where("sensor_type = 'RADAR'").count() == 2
    assert sinks.in_order(rows, ["v", "w", "sensor_type"]).columns == ["v", "w", "sensor_type"] and sinks.in_order(rows, ["w"]).where("w IS NULL").count() == 3


def test_a_failed_query_leaves_others_running_until_stopped(spark, tmp_path):
    def fail(df, n):
        raise ValueError("broken on purpose")

    seen, stop = [], threading.Event()
    source = lambda: spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    bad = source().writeStream.queryName("bad_one").foreachBatch(fail).start()
    good = source().writeStream.queryName("good_one").foreachBatch(lambda df, n: seen.append(n)).trigger(processingTime="200 milliseconds").start()
    raised = []

    def run():
        try:
            st.run_all(spark, [bad, good], stop, 0.1)
        except RuntimeError as e:
            raised.append(str(e))

    t = threading.Thread(target=run)
    t.start()
    for _ in range(100):
        if not bad.isActive:
            break
        threading.Event().wait(0.1)
    before = len(seen)
    for _ in range(100):
        if len(seen) > before + 1:
            break
        threading.Event().wait(0.1)
    assert good.isActive and len(seen) > before  # one has failed, the other goes on
    stop.set()
    t.join(30)
    assert not good.isActive and raised and "bad_one" in raised[0]


def test_append_reads_only_the_batchs_times(spark, tmp_path):
    path = f"file://{tmp_path}/fused"
    keys = ["timestamp_ms", "alice_event_id"]
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "timestamp_ms long, alice_event_id string")
    sinks.append_ignore(rows((1, "a"), (2, "b")), path, keys, 0)
    sinks.append_ignore(rows((2, "b"), (3, "c"), (3, "c")), path, keys, 1)
    sinks.append_ignore(rows((2, "b"), (3, "c"), (3, "c")), path, keys, 1)
    sinks.append_ignore(rows(), path, keys, 2)
    got = spark.read.option("recursiveFileLookup", "true").parquet(path)
    assert sorted(map(tuple, got.select(*keys).collect())) == [(1, "a"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("mode", ["refuse", "local"])
def test_shared_folder(spark, monkeypatch, mode):
    from types import SimpleNamespace

    from eventloom import storage

    conf = SimpleNamespace(getConf=lambda: SimpleNamespace(get=lambda key: None), master="spark://somewhere:7077" if mode == "refuse" else "local[2]", setCheckpointDir=lambda d: None)
    if mode == "refuse":
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            storage.shared_dir(SimpleNamespace(sparkContext=conf))
    else:
        assert storage.shared_dir(SimpleNamespace(sparkContext=conf)).startswith("file://")
