"""Streams with a state of their own, restarts with state in RocksDB, unmatched rows, and stops that let a batch end."""

import json
import random
import threading
import time

import pytest
from eventloom.session import STATE, state_beyond_memory
from eventloom.streaming import queries as st
from eventloom.streaming import state as keyed
from pyspark.sql import functions as F

ROCKS = STATE["spark.sql.streaming.stateStore.providerClass"]


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))
    time.sleep(0.02)  # files are read in order of their times


def run(spark, df, tmp_path, name="q"):
    q = df.writeStream.queryName(f"{name}-{random.random()}").format("parquet").option("path", f"{tmp_path}/out-{name}").option("checkpointLocation", f"{tmp_path}/cp-{name}").trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    return spark.read.parquet(f"{tmp_path}/out-{name}")


def test_rules_in_event_order_across_restarts(spark, tmp_path):
    r = random.Random(2)
    rows, last = [], {}
    for i in range(300):
        d = r.choice("xyz")
        seq, ms = last.get(d, (0, 1_000_000))
        last[d] = seq + r.choice([1, 1, 3]), ms + r.choice([0, 700, 700])
        rows.append({"d": d, "i": i, "seq": last[d][0], "ms": last[d][1]})
    want = {}
    for d in "xyz":
        own = [x for x in rows if x["d"] == d]
        want |= {str(b["i"]): None if a is None else "sequence_gap" if b["seq"] - a["seq"] > 1 else "timestamp_not_advancing" if b["ms"] <= a["ms"] else None for a, b in zip([None, *own], own, strict=False)}
    # Rows move by up to 20 places, within the watermark; null keys and times are left out.
    arrived = sorted(rows, key=lambda x: x["i"] + r.randint(0, 20))
    schema = "d string, i long, seq long, ms long"
    for k in range(4):
        put(tmp_path / "in", str(k), arrived[k * 75 : (k + 1) * 75] + [{"d": None, "i": -1, "seq": 1, "ms": 1_000_000}, {"d": "x", "i": -2, "seq": None, "ms": 1_000_000}])
        if k == 3:
            put(tmp_path / "in", "z", [{"d": "end", "i": -3, "seq": 1, "ms": 9_000_000}])
        with state_beyond_memory(spark):
            source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
            got = run(spark, keyed.sequence_rule_stream(source, "d", "i", "seq", "ms", "60 seconds"), tmp_path)
        rows_now = {x.id: x.rule for x in got.where("device <> 'end'").collect()}
        assert got.count() == got.select("id").distinct().count() and rows_now.items() <= want.items()
    assert rows_now == want


@pytest.mark.parametrize("ttl", [None, 3_600_000])
def test_lateness_by_arrival(spark, tmp_path, ttl):
    r = random.Random(3)
    rows = [{"s": r.choice("ab"), "n": n, "ms": 10_000 + n * 500 - r.choice([0, 0, 3000, 9000])} for n in range(120)]
    want, high = {}, {}
    for x in rows:
        h = high.get(x["s"])
        want[str(x["n"])] = "on_time" if h is None or x["ms"] > h else "late_beyond" if h - x["ms"] >= 5000 else "late_tolerated"
        high[x["s"]] = max(x["ms"], x["ms"] if h is None else h)
    for k in range(3):
        put(tmp_path / "in", str(k), r.sample(rows[k * 40 : (k + 1) * 40], 40))
    source = spark.readStream.schema("s string, n long, ms long").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    stream = keyed.lateness_stream(source, "s", "n", "ms", "n", ttl_ms=ttl)
    if ttl is None:
        got = run(spark, stream, tmp_path)
    else:
        q = stream.writeStream.format("memory").queryName("ttl").option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="200 milliseconds").start()
        for _ in range(300):
            if spark.table("ttl").count() >= 120:
                break
            time.sleep(0.2)
        assert st.drain(q)
        got = spark.table("ttl")
    assert {x.id: x.lateness for x in got.collect()} == want


def test_unmatched_rows_come_once(spark, tmp_path):
    schema = "event_id string, ms long"
    put(tmp_path / "left", "1", [{"event_id": "m", "ms": 100_000}, {"event_id": "edge", "ms": 100_900}, {"event_id": "alone", "ms": 150_000}])
    put(tmp_path / "radar", "1", [{"event_id": "s", "ms": 100_400}, {"event_id": "t", "ms": 100_390}])
    for k, ms in ((2, 300_000), (3, 500_000), (4, 700_000)):
        for side in ("left", "radar"):
            put(tmp_path / side, str(k), [{"event_id": f"f{k}{side}", "ms": ms + (5000 if side == "left" else 0)}])
    for _ in range(2):  # the second run is a restart that finds nothing new
        source = {s: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / s)) for s in ("left", "radar")}
        rows = st.fusion_outer_stream(source["left"], {"radar": source["radar"]}, 500)
        q = st.write_match_rate(rows, f"file://{tmp_path}/out", f"file://{tmp_path}/rate", f"file://{tmp_path}/cp", {"availableNow": True}, f"outer-{random.random()}")
        q.awaitTermination()
        assert q.exception() is None
    got = spark.read.option("recursiveFileLookup", "true").schema(rows.schema).parquet(f"file://{tmp_path}/out")
    found = sorted((x.aid, x.sid) for x in got.collect() if not x.aid.startswith("f"))
    assert sorted(found, key=str) == sorted([("m", "t"), ("edge", "s"), ("alone", None)], key=str)
    rates = spark.read.option("recursiveFileLookup", "true").parquet(f"file://{tmp_path}/rate")
    assert rates.agg(F.sum("matched")).first()[0] == 2 and all(abs(r.rate - r.matched / r.total) < 1e-12 for r in rates.collect())


def test_state_lies_in_rocksdb_and_survives_a_restart(spark, tmp_path):
    """Rows that were counted and seen before the restart are known after it; the session's other settings come back."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    put(tmp_path / "in", "1", [{"k": f"k{i % 10}", "ms": 100_000 + i} for i in range(50)])
    seen = []
    for n in (1, 2):
        with state_beyond_memory(spark):
            source = spark.readStream.schema("k string, ms long").json(str(tmp_path / "in")).withColumn("ts", F.timestamp_millis("ms"))
            got = run(spark, st.deduplicated(source, "k", "ts", "1 hour"), tmp_path)
        seen.append(sorted(r.k for r in got.collect()))
        put(tmp_path / "in", "2", [{"k": f"k{i}", "ms": 200_000 + i} for i in range(12)])
    assert seen == [sorted(f"k{i}" for i in range(10)), sorted(f"k{i}" for i in range(12))]
    assert ROCKS in (tmp_path / "cp-q" / "offsets" / "0").read_text() and list((tmp_path / "cp-q" / "state").rglob("*.changelog"))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_a_stop_lets_the_batch_end(spark, tmp_path):
    put(tmp_path / "in", "1", [{"k": "a", "ms": 1}])
    began, ended = threading.Event(), []

    def slow(df, n):
        began.set()
        df.sparkSession.range(1).count()
        time.sleep(3)
        ended.append(df.count())

    q = spark.readStream.schema("k string, ms long").json(str(tmp_path / "in")).writeStream.queryName("slow").foreachBatch(slow).option("checkpointLocation", f"{tmp_path}/cp").trigger(processingTime="1 second").start()
    stop = threading.Event()
    out = []
    t = threading.Thread(target=lambda: out.append(st.run_all(spark, [q], stop, 0.1)))
    t.start()
    assert began.wait(30)
    stop.set()
    t.join(60)
    assert out == [{}] and ended == [1] and not q.isActive and q.exception() is None
    assert (tmp_path / "cp" / "commits" / "0").exists()  # the next start doesn't do it again


def test_a_batch_that_takes_too_long_is_cut_off(spark, tmp_path):
    put(tmp_path / "in", "1", [{"k": "a", "ms": 1}])
    began = threading.Event()
    q = spark.readStream.schema("k string, ms long").json(str(tmp_path / "in")).writeStream.foreachBatch(lambda df, n: (began.set(), time.sleep(4))).option("checkpointLocation", f"{tmp_path}/cp").start()
    assert began.wait(30)
    assert not st.drain(q, 0.2) and not q.isActive
