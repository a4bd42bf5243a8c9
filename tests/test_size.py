"""Queries on tables of which each row comes several times under other ids, as larger tables hold them."""

import pytest
from compare import SF, plain
from eventloom.plans import catalog, q_streaming, views
from pyspark.sql import functions as F

COPIES = 12


@pytest.fixture(scope="module")
def larger(spark, tmp_path_factory):
    """sf0.001 with all events so many times over, at the same times, in a folder of several files."""
    folder = str(tmp_path_factory.mktemp("larger"))
    e = spark.read.parquet(f"{SF}/events.parquet")
    step = e.agg(F.max("event_id") + 1).first()[0]
    e.crossJoin(spark.range(COPIES)).withColumn("event_id", F.col("event_id") + F.col("id") * step).select(*e.columns).repartition(3).write.parquet(f"{folder}/events.parquet")
    return folder


def same_events(spark, name, folder):
    """same, of a table that is a folder."""
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    want, df = con.sql(catalog.ORACLES[name]), catalog.QUERIES[name](spark, folder)
    assert sorted(tuple(map(plain, r)) for r in df.select(*want.columns).collect()) == sorted(tuple(map(plain, r)) for r in want.fetchall())


def test_rollup_of_full_hours(spark, tmp_path):
    """Hours of thousands of different values, nulls and such that the rank falls on a row."""
    rows = spark.range(6000).select("id", F.when(F.col("id") % 50 != 7, F.col("id") * 7919 % 6007 / 8).alias("value"), F.when(F.col("id") < 4000, "click").otherwise("view").alias("event_type"))
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 3000).cast("timestamp_ntz").alias("ts")
    rows.select(F.col("id").alias("event_id"), ts, (F.col("id") % 9).alias("user_id"), "event_type", "value", F.lit("{}").alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    same_events(spark, "perf_sketch", str(tmp_path))


FUSED = "fusion_nearest_pairs alignment_summary rules_on_full_stream fused_conformance payload_audit resolution_counts alignment_log fused_records nearest_rank api_fusion_events fused_daily match_rate".split()


def test_fused_rows_make_no_pairs(spark):
    plan = views.fused(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "s_bucket" not in plan and "aid" in plan


@pytest.mark.parametrize("name", FUSED)
def test_fused_over_copies(spark, larger, name):
    same_events(spark, name, larger)


@pytest.mark.parametrize("name", ["stream_fusion", "stream_unmatched"])
def test_streams_of_several_files(spark, larger, monkeypatch, name):
    """Files that overlap in time become batches in order of time."""
    monkeypatch.setattr(q_streaming, "ROWS_PER_BATCH", 5000)
    same_events(spark, name, larger)


def test_bootstrap_hashes_each_row_once(spark):
    """The hash stands below the step that makes a row's resamples."""
    plan = catalog.QUERIES["bootstrap_interval"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5") and "md5" not in plan[: plan.index("Generate explode")]


def test_ranges_of_neighbours_spread_over_tasks(spark, monkeypatch):
    """More rows make more tasks, not larger ones, however few partitions the session has."""
    from eventloom.operators import ordered

    monkeypatch.setattr(ordered, "ROWS_PER_TASK", 1000)
    df = spark.range(20_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id")).alias("mark"))
    rows = ordered.neighbours(df, ["id"], "mark", "low", "high").withColumn("task", F.spark_partition_id())
    assert rows.where("low != id - id % 10 OR high != id - id % 10 + 10").isEmpty()
    held = [r["count"] for r in rows.groupBy("task").count().collect()]
    assert sum(held) == 20_000 and len(held) == 20 and max(held) < 3000


@pytest.mark.parametrize("window", [0, 1, 7, 300])
def test_near_pairs_in_tasks_by_rows(spark, monkeypatch, window):
    """The pairs of every window, in tasks as many as the rows call for."""
    from eventloom.operators import fusion

    monkeypatch.setattr(fusion, "RIGHTS_PER_TASK", 50)
    left = spark.range(200).select(F.col("id").alias("aid"), F.when(F.col("id") != 3, F.col("id") * 7919 % 1999 - 900).alias("a_ms"))
    right = spark.range(500).select(F.col("id").alias("sid"), F.when(F.col("id") != 5, F.col("id") * 104729 % 2003 - 900).alias("s_ms"), F.lit("x").alias("sensor_type"))
    made = fusion.near_pairs(left, right, window)
    want = left.crossJoin(right).where(F.abs(F.col("s_ms") - F.col("a_ms")) <= window)
    assert sorted((r.aid, r.sid) for r in made.collect()) == sorted((r.aid, r.sid) for r in want.collect())
    assert made.rdd.getNumPartitions() == 10


def test_interval_pairs_over_copies(spark, larger):
    same_events(spark, "interval_pairs", larger)


@pytest.mark.parametrize("window", [0, 7, 300])
def test_streamed_nearest_makes_no_pairs(spark, window):
    """The expressions of the stream over tables, against all pairs; times below zero, ends of the window and ties are among them."""
    from eventloom.operators.fusion import nearest_or_none
    from eventloom.streaming import queries as st

    left = spark.range(150).select(F.concat(F.lit("l"), "id").alias("event_id"), (F.col("id") * 7919 % 1999 - 900).alias("ms"))
    left = left.unionByName(left.where("ms % 3 = 0")).unionByName(spark.createDataFrame([("far", 99_999)], "event_id string, ms long"))
    rights = {k: spark.range(90).select(F.concat(F.lit(k), "id").alias("event_id"), F.when(F.col("id") != 5, F.col("id") * n % 503 * 4 - 900).alias("ms")) for k, n in (("a", 104729), ("b", 1299709))}
    got = st.fusion_outer_stream(left, rights, window)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert "Join" not in plan
    every = rights["a"].withColumn("k", F.lit("a")).unionByName(rights["b"].withColumn("k", F.lit("b"))).select(F.col("event_id").alias("sid"), F.col("ms").alias("s_ms"), F.col("k").alias("sensor_type"))
    a = left.select(F.col("event_id").alias("aid"), F.col("ms").alias("a_ms"), F.timestamp_millis("ms").alias("a_time"))
    want = nearest_or_none(a.join(every, F.abs(F.col("s_ms") - F.col("a_ms")) <= window, "left"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_files_of_a_stream_are_cut_in_one_pass(spark, tmp_path):
    """Each file holds its stretch of the order, and the table is read once, not once for each file."""
    seen = spark.sparkContext.accumulator(0)

    def counted(parts):
        for p in parts:
            seen.add(len(p))
            yield p

    rows = spark.range(1000).select("id", F.when(F.col("id") % 100 != 7, F.col("id") * 7919 % 1000).alias("t")).mapInPandas(counted, "id long, t long")
    parts = q_streaming.cut_at(rows, F.col("t"), [99, 499, 998, 999])
    low, high = [None, 99, 499, 998], [99, 499, 998, 999]
    for part, below, upto in zip(parts, low, high, strict=True):
        assert part.where(F.coalesce((F.col("t") <= (below if below is not None else -1)) | (F.col("t") > upto), F.lit(below is not None))).isEmpty()
    assert sum(p.count() for p in parts) == 1000 and seen.value == 1000


@pytest.mark.parametrize("per_entry", [100_000, 300])
def test_waiting_rows_are_packed(monkeypatch, per_entry):
    """A thousand waiting rows are one entry of the state, or as many as its bound calls for; a part of them waits on."""
    import pandas as pd
    from eventloom.streaming import state

    class Kept:
        def __init__(self):
            self.rows, self.most = [], 0

        get = lambda self: self.rows[0] if self.single and self.rows else None if self.single else iter(self.rows)
        update = lambda self, row: self.rows.__setitem__(slice(None), [row])
        clear = lambda self: self.rows.clear()

        def put(self, rows):
            self.rows[:] = rows

        def appendList(self, rows):
            self.rows += rows

    class Handle:
        def __init__(self):
            self.value, self.waiting, self.timers = Kept(), Kept(), []
            self.value.single, self.waiting.single = True, False
            self.getValueState, self.getListState = lambda *a: self.value, lambda *a: self.waiting
            self.listTimers, self.deleteTimer, self.registerTimer = lambda: list(self.timers), self.timers.remove, self.timers.append

    class Clock:
        def __init__(self, ms):
            self.getCurrentWatermarkInMs = lambda: ms

    monkeypatch.setattr(state, "ROWS_PER_ENTRY", per_entry)
    rules, handle = state.SequenceRules(), Handle()
    rules.init(handle)
    rows = pd.DataFrame({"id": [str(i) for i in range(1000)], "seq": [i + i // 7 for i in range(1000)], "ms": [i // 2 * 10 for i in range(1000)]})
    want = [None] + ["sequence_gap" if i % 7 == 0 else "timestamp_not_advancing" if i % 2 else None for i in range(1, 1000)]
    assert not len(next(rules.handleInputRows(("k",), iter([rows.sample(frac=1, random_state=1)]), Clock(-1))))
    assert len(handle.waiting.rows) == -(-1000 // per_entry) and handle.timers == [0]
    first = next(rules.handleExpiredTimer(("k",), Clock(2500), None))
    assert handle.timers == [2510] and len(handle.waiting.rows) == -(-498 // per_entry)
    last = next(rules.handleExpiredTimer(("k",), Clock(9999), None))
    got = pd.concat([first, last])
    assert dict(zip(got["id"], got["rule"], strict=True)) == {str(i): r for i, r in enumerate(want)} and not handle.waiting.rows and not handle.timers


def test_forest_asks_tasks_for_few_rows(spark, monkeypatch):
    """The rows of least hash, in its order, without a pool of rows from every task; also where hashes are far from even."""
    from eventloom.operators import forest

    taken = []
    monkeypatch.setattr(forest.Forest, "fit", lambda x, *a: taken.append(x))
    stages = lambda: {s.stageId(): s.resultSize() for s in map(every().apply, range(every().size()))}
    every = lambda: spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    rows = spark.range(0, 40_000, 1, 40).select("id", F.when(F.col("id") % 10 != 3, F.col("id")).alias("a"), (F.col("id") % 7).alias("b"))
    least = rows.dropna().select("a", "b", F.xxhash64(F.col("id").cast("string"), F.lit(42)).alias("h")).orderBy("h").limit(500).drop("h").toPandas()
    before = stages()
    forest.fit_forest(rows, ["a", "b"], "id", pool=500)
    sent = sum(size for k, size in stages().items() if k not in before)
    assert (taken[0] == least.to_numpy(float)).all() and sent < 500_000  # 40 times 500 rows are over a million bytes
    forest.fit_forest(rows.withColumn("id", F.col("id") % 3), ["a", "b"], "id", pool=500)
    forest.fit_forest(rows, ["a", "b"], "id", pool=50_000)
    assert [len(x) for x in taken] == [500, 500, 36_000]


def test_forest_scores_rows_once(spark):
    """What comes after the scores reads them from a table, so that no step goes through the trees again."""
    assert "EvalPython" not in catalog.QUERIES["isolation_forest"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_forest_score_is_the_mean_path():
    import numpy as np
    from eventloom.operators.forest import Forest, mean_depth

    x = np.random.default_rng(3).normal(size=(300, 3))
    x[0, 1], x[1, 2] = np.inf, -np.inf
    forest = Forest.fit(x[2:], trees=20, sample=100)

    def path(tree, row):
        at = 0
        while (f := forest.feature[tree, at]) >= 0:
            at = (forest.left if row[f] <= forest.cut[tree, at] else forest.right)[tree, at]
        return forest.ends[tree, at]

    want = [2 ** (-sum(path(t, row) for t in range(20)) / 20 / mean_depth(100)) for row in x]
    assert np.allclose(forest.score(x), want, rtol=1e-12, atol=0)


def test_near_pairs_come_in_order(spark, monkeypatch):
    """Within a task by bucket, left row and right row: what a file of pairs needs to stay small."""
    from eventloom.operators import fusion

    monkeypatch.setattr(fusion, "RIGHTS_PER_TASK", 100)
    left = spark.range(200).select(F.col("id").alias("aid"), (F.col("id") * 7919 % 1999 - 900).alias("a_ms"))
    right = spark.range(500).select(F.col("id").alias("sid"), (F.col("id") * 104729 % 103 * 20 - 900).alias("s_ms"), F.lit("x").alias("sensor_type"))
    for rows in fusion.near_pairs(left, right, 300).rdd.glom().collect():
        key = [(r.s_ms // 150, r.a_ms, r.aid, r.s_ms, r.sid) for r in rows]
        assert rows and key == sorted(key)
