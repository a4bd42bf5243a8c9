"""Tables that are kept: inserts by index, write-backs to touched partitions, rollups after late batches."""

import random
from pathlib import Path

import pytest
from eventloom.operators import indexed as ix
from eventloom.operators import partitioned as pt
from eventloom.operators.rollups import summary_5min
from pyspark.sql import functions as F

LAYOUT = ix.Layout(32, 2)


def ids(spark, numbers, extra="x"):
    return spark.createDataFrame([(None if n is None else f"id-{n}", extra) for n in numbers], "event_id string, v string")


def files(path, pattern):
    return {str(p) for p in Path(path).rglob(pattern) if p.suffix == ".parquet" and "_pending" not in str(p)}


def test_each_id_goes_in_once(spark, tmp_path):
    r, path, there, nulls = random.Random(3), f"file://{tmp_path}/t", set(), 0
    for batch in range(4):
        numbers = [r.choice([None, *range(600)]) for _ in range(400)]
        made = ix.append_indexed(ids(spark, numbers, str(batch)), path, "event_id", batch, LAYOUT)
        fresh = set(numbers) - there - {None}
        assert sorted(x.event_id for x in made.fresh.where("event_id IS NOT NULL").collect()) == sorted(f"id-{n}" for n in fresh)
        there |= fresh
        nulls += numbers.count(None)
    rows = ix.indexed_rows(spark, path)
    assert rows.where("event_id IS NOT NULL").count() == len(there) == rows.select("event_id").distinct().where("event_id IS NOT NULL").count()
    assert rows.where("event_id IS NULL").count() == nulls


def test_a_retry_writes_the_same(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    ix.append_indexed(ids(spark, range(50)), path, "event_id", 0, LAYOUT)
    for _ in range(2):
        ix.append_indexed(ids(spark, range(40, 90)), path, "event_id", 1, LAYOUT)
    assert ix.indexed_rows(spark, path).count() == 90 and ix.indexed_rows(spark, path, 1).count() == 40


def test_new_ids_open_few_groups(spark, tmp_path):
    """Ten thousand ids are there; a batch of a thousand new ones opens next to nothing, one old id opens its group."""
    path, layout = f"file://{tmp_path}/t", ix.Layout.for_ids(10_000, 64)
    ix.append_indexed(ids(spark, range(10_000)), path, "event_id", 0, layout)
    looked = ix.new_rows(ids(spark, range(50_000, 51_000)), path, "event_id", layout)
    assert looked.fresh.count() == 1000 and len(looked.opened) <= 64 // 10
    looked = ix.new_rows(ids(spark, [77, *range(60_000, 60_100)]), path, "event_id", layout)
    assert looked.fresh.count() == 100 and 1 <= len(looked.opened) <= 3
    named = looked.fresh.join(spark.read.parquet(f"{path}/rows").where(F.col("group").isin(looked.opened)).select("event_id"), "event_id", "left_anti")
    assert named.count() == 100


def test_filters_can_be_put_together(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    for batch in range(3):
        ix.append_indexed(ids(spark, range(batch * 30, batch * 30 + 40)), path, "event_id", batch, LAYOUT)
    ix.compact_filters(spark, path)
    assert spark.read.parquet(f"{path}/filters").select("batch").distinct().count() == 1
    assert ix.new_rows(ids(spark, range(200)), path, "event_id", LAYOUT, 7).fresh.count() == 100


def test_an_overfull_layout_stays_exact(spark, tmp_path):
    path, tiny = f"file://{tmp_path}/t", ix.Layout(2, 1)
    ix.append_indexed(ids(spark, range(60_000)), path, "event_id", 0, tiny)
    looked = ix.new_rows(ids(spark, range(59_000, 61_000)), path, "event_id", tiny)
    assert looked.fresh.count() == 1000 and looked.opened == [0, 1]


def test_empty_batches(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    assert ix.new_rows(ids(spark, []), path, "event_id", LAYOUT).fresh.count() == 0
    ix.append_indexed(ids(spark, [1]), path, "event_id", 0, LAYOUT)
    assert ix.append_indexed(ids(spark, []), path, "event_id", 1, LAYOUT).fresh.count() == 0
    assert ix.indexed_rows(spark, path).count() == 1


@pytest.fixture()
def days(spark, tmp_path):
    path = f"{tmp_path}/days"
    spark.range(100).select("id", (F.col("id") % 5).cast("int").alias("day"), F.lit(1.0).alias("value"), F.lit("k").alias("kind")).repartition("day").write.partitionBy("day").parquet(f"file://{path}")
    return path


def updates(spark):
    return spark.createDataFrame([(1, 1, 9.0), (2, 2, None), (2, 7, 8.0), (2, 7, 8.0), (2, 5000, 3.0)], "day int, id long, value double")


def test_write_back_leaves_other_partitions(spark, days):
    before = files(days, "*.parquet")
    pt.write_back_partitions(spark, f"file://{days}", updates(spark), ["id"], ["value"], ["day"])
    after = files(days, "*.parquet")
    kept = lambda names: {n for n in names if "/day=1/" not in n and "/day=2/" not in n}
    assert kept(before) == kept(after) and not (before - kept(before)) & after
    got = {r.id: r.value for r in spark.read.parquet(f"file://{days}").collect()}
    assert len(got) == 100 and got[1] == 9.0 and got[7] == 8.0 and got[2] == 1.0 and sum(x != 1.0 for x in got.values()) == 2


def test_a_write_back_that_was_cut_off_is_finished(spark, days):
    path = f"file://{days}"
    pt.write_back_partitions(spark, path, updates(spark), ["id"], ["value"], ["day"], stop_before_commit=True)
    assert spark.read.parquet(path).where("value != 1").count() == 0  # nothing is seen of it yet
    Path(days, pt.PENDING, "torn").mkdir()  # one that never got whole
    assert pt.finish_pending(spark, path, ["day"]) == 1 and pt.finish_pending(spark, path, ["day"]) == 0
    assert spark.read.parquet(path).where("value != 1").count() == 2 and spark.read.parquet(path).count() == 100
    pt.write_back_partitions(spark, path, updates(spark), ["id"], ["value"], ["day"])
    assert spark.read.parquet(path).where("value != 1").count() == 2


def test_write_back_without_updates(spark, days):
    before = files(days, "*.parquet")
    pt.write_back_partitions(spark, f"file://{days}", updates(spark).where("false"), ["id"], ["value"], ["day"])
    assert files(days, "*.parquet") == before


def test_two_partition_columns(spark, tmp_path):
    path = f"file://{tmp_path}/two"
    spark.range(40).select("id", (F.col("id") % 2).cast("int").alias("a"), F.when(F.col("id") % 4 < 2, "x").otherwise("y").alias("b"), F.lit(0).alias("v")).write.partitionBy("a", "b").parquet(path)
    pt.write_back_partitions(spark, path, spark.createDataFrame([(0, "x", 4, 5)], "a int, b string, id long, v int"), ["id"], ["v"], ["a", "b"])
    got = spark.read.parquet(path)
    assert got.count() == 40 and [r.id for r in got.where("v = 5").collect()] == [4]


def fused(spark, n, seed, days=4):
    r = random.Random(seed)
    rows = [(r.randint(0, days * 86_400_000 - 1), r.choice(["radar", "lidar", None]), r.choice([None, 1.5, 3.0]), r.choice([None, float(r.randint(0, 900))]), r.choice([None, 0, 1, 7])) for _ in range(n)]
    return spark.createDataFrame(rows, "timestamp_ms long, sensor_type string, data_loss_pct double, latency_ms double, anomaly_label int")


def test_rollup_after_late_batches(spark, tmp_path):
    rollup, parts = pt.Rollup(f"file://{tmp_path}/r"), [fused(spark, 500, s) for s in (1, 2)] + [fused(spark, 50, 3, 1)]
    for n, part in enumerate(parts):
        rollup.add(part, n)
        rollup.add(part, n)  # a retry
    assert rollup.refresh(spark) == [0, 1, 2, 3] and rollup.refresh(spark) == []
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])

    def same():
        got = {(r.bucket, r.sensor_type): (r.event_count, r.avg_data_loss, r.avg_latency, r.anomaly_rate) for r in rollup.read(spark).collect()}
        want = {(r.bucket, r.sensor_type): (r.event_count, r.avg_data_loss, r.avg_latency, r.anomaly_rate) for r in summary_5min(every).collect()}
        assert got.keys() == want.keys() and all(g == pytest.approx(want[k]) if None not in g else g == want[k] for k, g in got.items())

    same()
    before = files(f"{tmp_path}/r/rollup", "*.parquet")
    late = fused(spark, 30, 9, 4).where("timestamp_ms >= 2 * 86400000 AND timestamp_ms < 3 * 86400000")
    rollup.add(late, 3)
    every = every.unionByName(late)
    assert rollup.refresh(spark, stop_before_commit=True) == [2]  # the driver dies here, and the next refresh goes on
    assert files(f"{tmp_path}/r/rollup", "*.parquet") == before
    rollup.refresh(spark)
    same()
    after = files(f"{tmp_path}/r/rollup", "*.parquet")
    assert {n for n in before if "/day=2/" not in n} == {n for n in after if "/day=2/" not in n} and before != after


def test_merged_sketches_keep_their_rank(spark, tmp_path):
    rollup, r = pt.Rollup(f"file://{tmp_path}/r"), random.Random(5)
    values = [r.random() for _ in range(20_000)]
    for n in range(4):
        rows = [(1000, "radar", 0.0, x, 0) for x in values[n::4]]
        rollup.add(spark.createDataFrame(rows, "timestamp_ms long, sensor_type string, data_loss_pct double, latency_ms double, anomaly_label int"), n)
    rollup.refresh(spark)
    p95 = rollup.read(spark).select(F.kll_sketch_get_quantile_double("latency_sketch", F.lit(0.95))).first()[0]
    assert abs(sum(x <= p95 for x in values) / len(values) - 0.95) < 0.02
