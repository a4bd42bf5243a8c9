"""Raw records, Avro against the Java library on Spark's class path, ranked sums against plain ones."""

import json
import math
import random
import zlib

import pytest
from eventloom.operators import ranked
from eventloom.operators import records as k
from eventloom.operators.validation import enforce
from eventloom.schemas import PHYSICS_EVENT, SENSOR_EVENT, SENSOR_TYPES
from eventloom.sources import avro
from pyspark.sql import functions as F

GOOD = {"event_id": "f47ac10b-58cc-4372-a567-0e02b2c3d479", "run_number": 7, "timestamp_ms": 1_283_299_200_042, "track_count": 3, "net_momentum_x": 0.5, "net_momentum_y": -0.125, "net_momentum_z": 1.25, "max_energy_gev": 4.875, "total_energy_gev": 89.5, "schema_version": "1.0"}


def reason(spark, record, policy):
    raw = record if isinstance(record, str) or record is None else json.dumps(record)
    row = k.check_records(spark.createDataFrame([(raw,)], "raw string"), "raw", PHYSICS_EVENT, policy).first()
    return row.reason, row.stamped


@pytest.mark.parametrize("change,enforced,lenient,strict,producer", [
    ({}, None, None, None, None),
    ({"max_energy_gev": 0.1}, None, None, "max_energy_gev does not survive as a 32-bit float", None),
    ({"max_energy_gev": 16_777_217}, None, None, "max_energy_gev does not survive as a 32-bit float", "max_energy_gev does not survive as a 32-bit float"),
    ({"max_energy_gev": 1e39}, *["max_energy_gev does not survive as a 32-bit float"] * 4),
    ({"run_number": "7"}, *["run_number has the wrong type"] * 4),
    ({"run_number": 2**31}, *["run_number has the wrong type"] * 4),
    ({"run_number": None}, *["run_number is null"] * 4),
    ({"extra": 1}, "unknown key: extra", None, "unknown key: extra", None),
    ({"_comment": "x"}, "unknown key: _comment", None, None, None),
    ({"net_momentum_x": ...}, "net_momentum_x is absent", None, "net_momentum_x is absent", "net_momentum_x is null"),
    ({"schema_version": "9.9"}, "version drift", None, None, None),
])
def test_policies(spark, change, enforced, lenient, strict, producer):
    record = {n: v for n, v in (GOOD | change).items() if v is not ...}
    assert [reason(spark, record, p)[0] for p in (k.ENFORCE, k.LENIENT, k.STRICT, k.PRODUCER)] == [enforced, lenient, strict, producer]


def test_stamps_and_odd_lines(spark):
    assert reason(spark, GOOD | {"schema_version": None}, k.ENFORCE) == (None, True) and reason(spark, GOOD, k.ENFORCE) == (None, False)
    assert reason(spark, GOOD | {"schema_version": "9.9"}, k.PRODUCER) == (None, True)
    for line, want in ((None, "invalid JSON"), ("", "invalid JSON"), ("{", "invalid JSON"), ("[]", "not an object"), ("null", "not an object"), ('{"a": 1, "a": 2}', "invalid JSON")):
        assert reason(spark, line, k.ENFORCE)[0] == want
    with pytest.raises(ValueError, match="unknown stream"):
        k.record_checks(PHYSICS_EVENT, {}, k.ENFORCE, "no_such_stream")


def test_findings_keep_columns_of_any_name(spark):
    rows = spark.createDataFrame([(1, "e", json.dumps({"event_id": "x", "sensor_type": "RADAR"})), (2, "f", "{"), (3, "g", "7")], "line int, event_id string, raw string")
    got = {r.line: r for r in k.findings(rows, "raw", SENSOR_EVENT).collect()}
    assert got[1].event_id == "e" and set(got[1].missing) >= {"sensor_id", "timestamp_ms", "target_id"} and got[1].nulls == got[1].missing
    assert got[2].invalid_json and got[2].missing == [] and got[3].schema_reason == "not an object"
    none = k.findings(rows.limit(0), "raw", SENSOR_EVENT)
    assert k.quality_report(none).first().asDict() == {"total_records": 0, "invalid_json": 0, "schema_failures": 0, "missing_required": 0, "required_nulls": 0, "range_violations": 0}
    assert k.examples(none, "line").count() == k.field_counts(none).count() == 0


# Avro.
WIDE = {"type": "record", "name": "wide", "fields": [
    {"name": "l", "type": "long"}, {"name": "s", "type": ["null", "string"], "default": None}, {"name": "e", "type": {"type": "enum", "name": "kind", "symbols": ["A", "B"]}}, {"name": "f", "type": "float"}, {"name": "d", "type": ["null", "double"]},
    {"name": "b", "type": "boolean"}, {"name": "y", "type": "bytes"}, {"name": "x", "type": {"type": "fixed", "name": "four", "size": 4}}, {"name": "a", "type": {"type": "array", "items": "int"}}, {"name": "m", "type": {"type": "map", "values": "long"}},
    {"name": "r", "type": ["null", {"type": "record", "name": "inner", "fields": [{"name": "k", "type": "kind"}, {"name": "again", "type": ["null", "kind"]}]}]},
]}


def some(r):
    return {"l": r.choice([0, -1, 63, 64, 2**63 - 1, -(2**63), r.getrandbits(40)]), "s": r.choice([None, "", "ä中\0", "x" * 300]), "e": r.choice("AB"), "f": r.choice([0.0, -0.5, 2.0**100]), "d": r.choice([None, 1 / 3]), "b": r.random() < 0.5, "y": r.randbytes(r.randint(0, 9)), "x": r.randbytes(4), "a": [r.randint(-9, 9) for _ in range(r.randint(0, 5))], "m": {f"k{i}": i for i in range(r.randint(0, 3))}, "r": r.choice([None, {"k": "A", "again": None}, {"k": "B", "again": "A"}])}


def java_records(spark, path):
    """Records of a container as the Java library's JSON."""
    jvm = spark._jvm
    reader = jvm.org.apache.avro.file.DataFileReader(jvm.java.io.File(str(path)), jvm.org.apache.avro.generic.GenericDatumReader())
    return [json.loads(reader.next().toString()) for _ in iter(reader.hasNext, False)]


@pytest.mark.parametrize("codec", ["null", "deflate"])
def test_containers_as_the_java_library_reads_them(spark, tmp_path, codec):
    r = random.Random(4)
    records = [some(r) for _ in range(2500)]
    raw = avro.container(WIDE, records, b"0123456789abcdef", codec)
    (tmp_path / "c.avro").write_bytes(raw)
    assert list(avro.read_container(raw)) == records
    got = java_records(spark, tmp_path / "c.avro")
    assert [(g["l"], g["s"], g["e"], g["a"], g["m"], g["b"]) for g in got] == [(x["l"], x["s"], x["e"], x["a"], x["m"], x["b"]) for x in records]


def test_payloads_that_do_not_fit():
    own = avro.Codec(WIDE)
    good = some(random.Random(1))
    for change in ({"l": "7"}, {"l": 2**63}, {"l": True}, {"e": "C"}, {"f": 1e39}, {"x": b"12345"}, {"a": [1.5]}, {"s": 5}, {"r": {"k": "Z", "again": None}}):
        with pytest.raises(avro.AvroError):
            own.encode(good | change)
    with pytest.raises(avro.AvroError):
        own.encode({n: v for n, v in good.items() if n != "l"})
    assert own.decode(own.encode({n: v for n, v in good.items() if n != "s"}))["s"] is None
    raw = own.encode(good)
    for bad in (raw[:-1], raw + b"\0", b"", b"\xff" * 20):
        with pytest.raises(avro.AvroError):
            own.decode(bad)
    with pytest.raises(avro.AvroError):
        list(avro.read_container(b"not one"))
    assert math.isnan(own.decode(own.encode(good | {"f": math.nan}))["f"])


def test_tolerant_payloads(spark):
    schema = avro.avro_schema(PHYSICS_EVENT, "alice_event")
    good = avro.Codec(schema).encode(GOOD)
    rows = spark.createDataFrame([("t", 1, good), ("t", 2, good[:5]), ("u", 3, None)], "topic string, run_number int, value binary")
    got = sorted(avro.decode_payload(rows, "value", schema, tolerant=True).collect(), key=lambda x: x.run_number)
    assert [(x.topic, x.run_number, x.event_id) for x in got] == [("t", 1, GOOD["event_id"]), ("t", 2, None), ("u", 3, None)]
    with pytest.raises(Exception, match="too early"):
        avro.decode_payload(rows, "value", schema).collect()


def test_payloads_of_a_stream(spark, tmp_path):
    schema = avro.avro_schema(PHYSICS_EVENT, "alice_event")
    rows = spark.createDataFrame([tuple(GOOD.values()), (*list(GOOD.values())[:1], None, *list(GOOD.values())[2:])], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PHYSICS_EVENT))
    sent = avro.encode_payload(rows, schema, tolerant=True).withColumn("topic", F.lit("alice"))
    assert sent.where("value IS NULL").count() == 1  # the one with a null that its schema forbids
    with pytest.raises(Exception, match="run_number"):
        avro.encode_payload(rows, schema).collect()
    sent.where("value IS NOT NULL").write.parquet(f"file://{tmp_path}/topic")
    stream = spark.readStream.schema("value binary, topic string").parquet(f"file://{tmp_path}/topic")
    q = avro.decode_payload(stream, "value", schema).writeStream.format("memory").queryName("decoded").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.table("decoded").collect()
    assert [(r.topic, r.event_id, r.track_count, r.total_energy_gev) for r in got] == [("alice", GOOD["event_id"], 3, 89.5)]


def test_written_containers(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(avro, "FILE_BYTES", 2000)
    schema = avro.avro_schema(SENSOR_EVENT, "sensor_event", {"sensor_type": SENSOR_TYPES})
    rows = spark.range(300).select(F.col("id").cast("string").alias("event_id"), F.lit("R-01").alias("sensor_id"), F.when(F.col("id") % 50 == 0, "SONAR").otherwise("RADAR").alias("sensor_type"), F.col("id").alias("timestamp_ms"), F.lit("1.0").alias("schema_version")).repartition(3)
    wide = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in SENSOR_EVENT if f.name not in rows.columns})
    path = f"file://{tmp_path}/out"
    summary = avro.write_enforced(enforce(wide, "sensor_event", SENSOR_EVENT, {"sensor_type": SENSOR_TYPES}), path, schema).collect()
    assert len(summary) == 3 and sum(r.record_count for r in summary) == 294 and sum(r.rejected_round_trip_failed for r in summary) == 6 and sum(r.containers for r in summary) == 6
    assert avro.read_avro(spark, path, schema).count() == 294
    files = [f for f in (tmp_path / "out").iterdir() if f.name.startswith("part-")]
    assert len(files) == sum(r.containers for r in summary) and sum(len(java_records(spark, f)) for f in files) == 294
    # A second run writes over the first; no rows give no container; a path that is not there has no rows.
    assert avro.write_avro(wide.limit(0), path, schema).count() == 0 and avro.read_avro(spark, path, schema).count() == 0
    assert avro.read_avro(spark, f"file://{tmp_path}/none", schema).columns == SENSOR_EVENT.names
    assert avro.avro_to_parquet(spark, path, f"file://{tmp_path}/p", schema) == 0 and avro.parquet_to_avro(spark, f"file://{tmp_path}/none", path, schema) == 0


# Ranked sums and percentiles.
def test_running_sums(spark):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", None]), x, r.choice([1, 2, None])) for x in random.Random(5).sample(range(10_000), 400)] + [("a", None, 3)]
    df = spark.createDataFrame([(g, None if x is None else float(x), v) for g, x, v in rows], "g string, x double, v int")
    got = {(o.g, o.x): o.upto for o in ranked.running_sum(df, ["g"], "x", {"upto": "v"}, ranges=7).collect()}
    for g, x, _ in rows:
        assert got[g, None if x is None else float(x)] == sum(v or 0 for h, y, v in rows if h == g and (y is None or (x is not None and y <= x)))
    assert ranked.running_sum(df.limit(0), ["g"], "x", {"upto": "v"}).count() == 0
    assert ranked.running_sum(df.where("x < 500"), [], "x", {"upto": "v"}, 3).count() == df.where("x < 500").count()


def test_percentiles(spark):
    r = random.Random(8)
    values = [round(r.gauss(0, 5), r.choice([0, 3])) for _ in range(500)]
    df = spark.createDataFrame([("x" if i % 3 else "y", v if i % 17 else None) for i, v in enumerate(values)], "g string, v double")
    want = {x.g: (x.a, x.b, x.c) for x in df.groupBy("g").agg(F.percentile("v", F.lit(0.0)).alias("a"), F.percentile("v", F.lit(0.5)).alias("b"), F.percentile("v", F.lit(0.95)).alias("c")).collect()}
    got = {x.g: (x.a, x.b, x.c) for x in ranked.percentiles(df, ["g"], "v", {"a": 0.0, "b": 0.5, "c": 0.95}, ranges=5).collect()}
    assert got.keys() == want.keys() and all(got[g] == pytest.approx(want[g]) for g in want)
    assert ranked.percentiles(df, [], "v", {"m": 0.5}).first().m == pytest.approx(df.agg(F.percentile("v", F.lit(0.5))).first()[0])
    assert ranked.percentiles(df.where("v IS NULL"), ["g"], "v", {"m": 0.5}).count() == 0 and zlib.crc32(b"") == 0


def test_a_task_holds_no_records(spark, tmp_path, monkeypatch):
    """A record is encoded once, when it comes, and a dataset of several files is no single task."""
    import tracemalloc

    from eventloom.sources.avro import write_avro

    schema = {"type": "record", "name": "r", "fields": [{"name": "x", "type": "long"}, {"name": "t", "type": "string"}]}
    peak = []

    class Frame:
        sparkSession = spark

        def select(self, *cols):
            return self

        def mapInArrow(self, run, shape):
            import pyarrow as pa

            monkeypatch.setattr("eventloom.sources.avro.TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": staticmethod(lambda: 0)})())}))
            batches = (pa.RecordBatch.from_pylist([{"x": k, "t": "a" * 20}] * 1000) for k in range(100))
            tracemalloc.start()
            self.rows = sum(b["record_count"][0].as_py() for b in run(batches))
            peak.append(tracemalloc.get_traced_memory()[1])
            tracemalloc.stop()
            raise StopIteration

    frame = Frame()
    frame.columns = ["x", "t"]
    with pytest.raises(StopIteration):
        write_avro(frame, f"file://{tmp_path}/a", schema)
    assert frame.rows == 100_000 and peak[0] < 5_000_000


def test_a_dataset_becomes_containers_in_several_tasks(spark, tmp_path):
    from eventloom.sources import avro

    schema = {"type": "record", "name": "r", "fields": [{"name": "x", "type": "long"}]}
    source, path = f"file://{tmp_path}/p", f"file://{tmp_path}/a"
    spark.range(0, 4000, 1, 4).select(F.col("id").alias("x")).write.parquet(source)
    assert avro.parquet_to_avro(spark, source, path, schema) == 4000
    assert len(list((tmp_path / "a").glob("part-*"))) > 1
    assert sorted(r.x for r in avro.read_avro(spark, path, schema).collect()) == list(range(4000))
