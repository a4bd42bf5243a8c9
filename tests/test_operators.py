"""Golden cases of single operators: joins, rules, decisions, writers."""

import json
import math
import random

import numpy as np
import pytest
from eventloom.functions.scalars import quality_score, quality_status, quoted_csv
from eventloom.operators import rollups, scoring
from eventloom.operators.forest import Forest, mean_depth
from eventloom.operators.fusion import fuse, prepare_left, prepare_right
from eventloom.operators.sinks import append_ignore, insert_ignore, promote, write_back, write_csv, write_ids, write_parquet
from eventloom.operators.validation import cleaned, enforce, fused_conformance, sensor_ranges, staging_sensor
from eventloom.operators.windows import ecdf_risk, lateness, sequence_rules
from eventloom.schemas import FUSED_EVENT, PHYSICS_EVENT, SENSOR_EVENT
from eventloom.sources import files, generators
from eventloom.storage import path_exists
from pyspark.sql import functions as F


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: [(x is None, x) for x in r])


def match(spark, left, right, window=500):
    a = prepare_left(spark.createDataFrame(left, "id string, ms long"), "id", "ms", window)
    s = prepare_right(spark.createDataFrame(right, "id string, ms long"), "id", "ms", "RADAR", window)
    return rows(fuse(a, [s], window), "aid", "sid", "abs_dt")


@pytest.mark.parametrize(
    ("left", "right", "want"),
    [
        ([("a", 10_000)], [("s1", 9_700), ("s2", 10_100)], [("a", "s2", 100)]),
        ([("a", 10_000)], [("late", 10_200), ("early", 9_800)], [("a", "early", 200)]),
        ([("a", 10_000)], [("s2", 9_900), ("s1", 9_900)], [("a", "s1", 100)]),
        ([("a", 10_000), ("b", 10_100)], [("s", 10_050)], [("a", "s", 50), ("b", "s", 50)]),
        ([("a", 10_000)], [("in", 10_500), ("out", 9_499)], [("a", "in", 500)]),
        ([("a", 10_000)], [("out", 10_501)], []),
        ([("a", 0)], [("s", -500)], [("a", "s", 500)]),
        ([], [("s", 1)], []),
    ],
)
def test_nearest_match(spark, left, right, want):
    assert match(spark, left, right) == want


def test_nearest_match_against_brute_force(spark):
    r = random.Random(3)
    left, right = [(f"a{i}", r.randrange(20_000)) for i in range(60)], [(f"s{i:03}", r.randrange(20_000)) for i in range(120)]
    want = []
    for a, ta in left:
        near = [(abs(ts - ta), ts, s) for s, ts in right if abs(ts - ta) <= 500]
        if near:
            want.append((a, min(near)[2], min(near)[0]))
    assert match(spark, left, right) == sorted(want)


def test_sequence_rules(spark):
    df = spark.createDataFrame([("d", 1, 100), ("d", 2, 200), ("d", 4, 300), ("d", 5, 300), ("d", 9, 290), ("e", 7, 1)], "device string, seq long, ms long")
    got = dict(rows(sequence_rules(df, "device", ["seq"], "seq", "ms").where("device = 'd'"), "seq", "rule"))
    assert got == {1: None, 2: None, 4: "sequence_gap", 5: "timestamp_not_advancing", 9: "sequence_gap"}


def test_lateness(spark):
    df = spark.createDataFrame([("r", i, t) for i, t in enumerate([10_000, 12_000, 11_000, 7_000, 12_000, 12_001])], "s string, n long, ms long")
    assert [x[1] for x in rows(lateness(df, "s", "ms", "n"), "n", "lateness")] == ["on_time", "on_time", "late_tolerated", "late_beyond", "late_tolerated", "on_time"]


def test_ecdf_and_decisions(spark):
    ref = spark.createDataFrame([("x", v) for v in (1.0, 2.0, 2.0, 4.0)], "k string, s double")
    df = spark.createDataFrame([("x", 0.5), ("x", 2.0), ("x", 9.0)], "k string, s double")
    assert rows(ecdf_risk(df, ref, "s", "k"), "s", "risk") == [(0.5, 0.0), (2.0, 0.75), (9.0, 1.0)]
    risk = spark.createDataFrame([(0.99, None), (0.5, "sequence_gap"), (0.5, None), (1.0, "")], "r double, rule string")
    out = scoring.decide(F.col("r"), 0.99, F.col("rule"))
    got = risk.select(*[c.alias(k) for k, c in out.items()]).collect()
    assert [(g.anomaly_label, g.risk_score) for g in got] == [(1, 0.99), (1, 1.0), (0, 0.5), (1, 1.0)]
    assert got[0].confidence == 0.0 and got[1].confidence == 1.0 and math.isclose(got[2].confidence, 0.49 / 0.99)


def test_alarm_reasons(spark):
    df = spark.createDataFrame([("sequence_gap", 0.995, 1.0), ("", 0.99, 0.9)], "rule string, f double, z double")
    why = scoring.alarm_reason(F.col("rule"), F.col("f"), F.col("z"), F.lit("velocity_ms"))
    assert [r[0] for r in df.select(why).collect()] == ["rule:sequence_gap+isolation_forest+zscore:velocity_ms", ""]


def test_quality(spark):
    df = spark.createDataFrame([(0.0, 500.0), (0.0, 2500.0), (25.5, 100.0), (50.1, 0.0), (0.0, 99_999.0)], "l double, t double")
    score = quality_score(F.col("l"), F.col("t"))
    assert [tuple(r) for r in df.select(score, quality_status(score)).collect()] == [(100, "ok"), (80, "ok"), (74, "degraded"), (49, "critical"), (0, "critical")]


def test_nearest_rank_and_mad(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(1, 12)] + [("b", 5.0)], "k string, x double")
    got = {r.k: (r.p50, r.p95) for r in rollups.nearest_rank_percentiles(df, "x", "k").collect()}
    assert got == {"a": (6.0, 11.0), "b": (5.0, 5.0)}
    assert {r.k: (r.med, r.mad) for r in rollups.median_mad(df, "k", "x").collect()} == {"a": (6.0, 3.0), "b": (5.0, 1.0)}


def test_empty_aggregates(spark):
    none = spark.createDataFrame([], "dt long, k string, ok boolean")
    assert rollups.alignment_summary(none, "dt", 500).first().n == 0
    assert rollups.roc_auc(spark.createDataFrame([(1.0, True)], "s double, t boolean"), "s", F.col("t")).first().auc is None


def test_enforce(spark):
    good = {f.name: None for f in PHYSICS_EVENT} | {"event_id": "x", "run_number": 1, "timestamp_ms": 1, "track_count": 1, "net_momentum_x": 0.1, "net_momentum_y": 0.0, "net_momentum_z": 0.0, "max_energy_gev": 1.0, "total_energy_gev": 1.0, "schema_version": "1.0"}
    cases = [good, good | {"schema_version": None}, good | {"schema_version": "2.0"}, good | {"max_energy_gev": float("nan")}, good | {"max_energy_gev": 1e300}, good | {"track_count": None}]
    loose = "event_id string, run_number int, timestamp_ms long, track_count int, net_momentum_x double, net_momentum_y double, net_momentum_z double, max_energy_gev double, total_energy_gev double, schema_version string"
    out = enforce(spark.createDataFrame([tuple(c.values()) for c in cases], loose), "alice_event", PHYSICS_EVENT)
    assert [r.schema_version for r in out.valid.collect()] == ["1.0", "1.0"]
    assert [r.reason for r in out.rejected.collect()] == ["version drift", "max_energy_gev doesn't fit", "max_energy_gev doesn't fit", "track_count is null"]
    m = out.metrics.first()
    assert (m.total, m.passed, m.rejected, m.version_drift, m.data_loss_pct) == (6, 2, 4, 1, 66.6667)
    with pytest.raises(KeyError):
        enforce(out.valid, "unknown", PHYSICS_EVENT)


def test_validators(spark):
    radar = generators.generate(spark, "RADAR", 50, rate=0.0)
    assert radar.where(staging_sensor().isNotNull()).count() == 0
    assert radar.where(F.size(sensor_ranges()) > 0).count() == 0
    assert radar.withColumn("bearing_deg", F.lit(361.0)).select(sensor_ranges()).first()[0] == ["bearing_deg: must be between 0 and 360"]


def test_cleaning(spark):
    df = spark.createDataFrame([("a", 0), ("a", 9_000), ("a", 30_000), (None, 1), ("b", 99_999)], "event_id string, timestamp_ms long")
    assert rows(cleaned(df, F.lit(50_000)), "event_id", "timestamp_ms") == [("a", 0), ("a", 30_000)]


def test_conformance(spark):
    one = ("1" * 32, "2" * 32, "3" * 32, 5, "RADAR", 500, 0.0, 1.0, "1.0")
    df = spark.createDataFrame([one, one, ("x", "2" * 32, "3" * 32, -5, "SONAR", 600, 101.0, -1.0, "2")], FUSED_EVENT)
    got = fused_conformance(df).first().asDict()
    assert got["total"] == 3 and got["duplicate_ids"] == 1 and all(v == 1 for k, v in got.items() if k.startswith("bad_") and k not in ("bad_alice_event_id", "bad_sensor_event_id"))


def test_insert_ignore(spark):
    target = spark.createDataFrame([(1, "old")], "k int, v string")
    batch = spark.createDataFrame([(1, "x"), (2, "a"), (2, "b"), (None, "n"), (None, "m")], "k int, v string")
    assert sorted(map(str, rows(insert_ignore(target, batch, ["k"], order="v"), "k", "v"))) == ["(2, 'a')", "(None, 'm')", "(None, 'n')"]


def test_append_is_idempotent(spark, tmp_path):
    path, batch = f"file://{tmp_path}/t", spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    append_ignore(batch, path, ["k"], 0)
    append_ignore(batch, path, ["k"], 0)  # a retry
    append_ignore(batch, path, ["k"], 1)  # a replay
    assert spark.read.option("recursiveFileLookup", "true").parquet(path).count() == 2


@pytest.mark.parametrize(("fit", "strict", "want"), [(True, False, ["promoted", "promoted", "raw"]), (False, False, ["raw", "validated", "validated"]), (True, True, ["promoted", "raw", "validated"])])
def test_promotion(spark, fit, strict, want):
    df = spark.createDataFrame([(1, "validated", fit), (2, "validated", False), (3, "raw", True)], "k int, load_status string, ok boolean")
    done, after = promote(df, F.col("ok"), strict=strict)
    assert done.count() == int(fit) and sorted(r.load_status for r in after.collect()) == want


def test_write_back(spark):
    df = spark.createDataFrame([(1, 0.5), (2, None)], "k int, risk double")
    assert rows(write_back(df, spark.createDataFrame([(2, 0.9), (1, None)], "k int, risk double"), ["k"], ["risk"]), "k", "risk") == [(1, 0.5), (2, 0.9)]


def test_files(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1}\n\n{"a": oops\n{"a": 2}\n')
    good, bad = files.ndjson(spark, str(p), spark.createDataFrame([], "a int").schema)
    assert rows(good, "a") == [(1,), (2,)] and bad.first()[0] == '{"a": oops'
    c = files.ndjson_counts(spark, str(p), good.schema).first()
    assert (c.total, c.invalid_json) == (3, 1)
    assert files.parquet_or_empty(spark, f"{tmp_path}/none", good.schema).count() == 0
    assert write_parquet(good, f"{tmp_path}/d") == 2 and path_exists(spark, f"{tmp_path}/d")
    write_ids(good, "a", f"{tmp_path}/ids")
    assert rows(files.ids(spark, f"{tmp_path}/ids"), "id") == [("1",), ("2",)]
    write_csv(spark.createDataFrame([('q"x', None, "")], "a string, b string, c string"), f"{tmp_path}/csv")
    assert [r[0] for r in spark.read.text(f"{tmp_path}/csv").collect()][1] == '"q""x",,""'
    assert spark.createDataFrame([('q"x',), (None,)], "a string").select(quoted_csv(F.col("a"))).collect()[1][0] == ""
    (tmp_path / "log").write_text(json.dumps({"batch_id": 1, "logged_at": "2024-01-01T00:00:00Z", "abs_dt_ms": [1, 2]}) + '\n{"batch_id": 2, "abs')
    assert files.alignment_samples(spark, str(tmp_path / "log"), (0, 5)).count() == 2
    assert files.stream_kind(["run_number", "track_count"]) == "alice" and files.stream_kind(["sensor_type"], {"sensor_type": "LIDAR"}) == "lidar" and files.stream_kind(["x"]) == "unknown"


def test_generators(spark):
    for kind in generators.ANOMALIES:
        a, b = generators.generate(spark, kind, 400, rate=0.5), generators.generate(spark, kind, 400, rate=0.5)
        assert a.exceptAll(b).count() == 0 and {f.name for f in SENSOR_EVENT} <= set(a.columns)
        assert {r[0] for r in a.select("anomaly_type").distinct().collect()} == {None, *generators.ANOMALIES[kind]}
    t = generators.generate(spark, "TELEMETRY", 400, rate=0.5).orderBy("n").select("sequence_number", "anomaly_type").collect()
    assert all(y.sequence_number == x.sequence_number + 1 for x, y in zip(t, t[1:], strict=False) if y.anomaly_type != "missing_reading")
    with pytest.raises(ValueError, match="unsupported"):
        generators.base_records(spark.range(1), "SONAR", 0)
    with pytest.raises(ValueError, match="rate"):
        generators.inject(spark.range(1), "RADAR", 2.0)
    with pytest.raises(ValueError, match="share"):
        generators.inject_lateness(spark.range(1), "ms", "id", 2.0, 0, 1)


def test_forest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    forest = Forest.fit(x, trees=50)
    again = Forest.from_json(forest.to_json())
    far, near = again.score(np.full((1, 3), 8.0))[0], again.score(np.zeros((1, 3)))[0]
    assert far > 0.65 > 0.5 > near and mean_depth(2) == 1 and mean_depth(1) == 0
    with pytest.raises(ValueError, match="expects"):
        Forest.from_json(forest.to_json(), "other")


def test_bootstrap_covers_the_rates(spark):
    """Poisson weights have mean and variance 1, and the intervals of recall and false alarms are those of resampling."""
    import numpy as np
    from eventloom.operators.rollups import bootstrap_interval, poisson_weight

    ids = spark.range(3000).withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(19))))
    w = ids.select(poisson_weight("id", F.col("draw")).alias("w")).agg(F.avg("w"), F.var_pop("w"), F.max("w")).first()
    assert abs(w[0] - 1) < 0.02 and abs(w[1] - 1) < 0.04 and 5 <= w[2] <= 11
    rows = [(i, i % 3 == 0, (i % 3 == 0) == (i % 7 < 5), "g") for i in range(900)] + [(i, True, True, "one class") for i in range(5)]
    df = spark.createDataFrame([(i, int(t), int(f), g) for i, t, f, g in rows], "id long, t int, f int, g string")
    got = {r.g: r for r in bootstrap_interval(df, "t", "f", "g", "id").collect()}
    t, f = np.array([r[1] for r in rows[:900]]), np.array([r[2] for r in rows[:900]])
    rng = np.random.default_rng(1)
    draws = [rng.integers(0, 900, 900) for _ in range(500)]
    recall = np.percentile([f[d][t[d]].mean() for d in draws], [2.5, 97.5])
    fpr = np.percentile([f[d][~t[d]].mean() for d in draws], [2.5, 97.5])
    assert np.allclose([got["g"].recall_low, got["g"].recall_high, got["g"].fpr_low, got["g"].fpr_high], [*recall, *fpr], atol=0.02)
    assert got["one class"].recall_low is None
