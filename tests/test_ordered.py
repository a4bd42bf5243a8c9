"""Ordered passes and the linear nearest match against plain loops, with hot keys, bursts, ties and nulls."""

import random

import pytest
from compare import same
from eventloom.operators import ordered as o
from eventloom.operators.fusion import interval_join, nearest_in_order, nearest_match, prepare_left, prepare_right
from eventloom.operators.ranked import running_sum
from eventloom.operators.windows import inter_arrival, sequence_rules, sliding_counts
from eventloom.plans import catalog
from pyspark.sql import functions as F


def events(spark, n=3000, seed=1):
    """A third of all rows in one key, some in none; times repeat."""
    r = random.Random(seed)
    rows = [(r.choice(["hot", "hot", None, *"abcdefgh"]), r.choice([None, *range(0, 500)]), i, r.choice([None, i])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, t long, id long, x long").repartition(5)


def by_key(rows):
    keys = {}
    for row in rows:
        keys.setdefault(row[0], []).append(row)
    return {k: sorted(v, key=lambda r: (r[1] is not None, r[1] or 0, r[2])) for k, v in keys.items()}


@pytest.fixture(params=[None, 40])
def ranges(request, monkeypatch):
    """The normal number of ranges, or one that rows decide."""
    if request.param:
        monkeypatch.setattr(o, "ROWS_PER_RANGE", request.param)
        monkeypatch.setattr(o, "LEAST_RANGES", 1)


def test_lag(spark, ranges):
    rows, df = events(spark)
    got = {r.id: (r.before, r.t0) for r in o.lagged(df, ["k"], ["t", "id"], {"before": "x", "t0": "t"}).collect()}
    want = {}
    for own in by_key(rows).values():
        want |= {b[2]: (a[3], a[1]) for a, b in zip([(None,) * 4, *own], own, strict=False)}
    assert got == want


def test_numbers(spark, ranges):
    rows, df = events(spark)
    got = {r.id: r.x for r in o.numbered(df, ["k"], ["t", "id"], "x").collect()}
    assert got == {row[2]: n for own in by_key(rows).values() for n, row in enumerate(own, 1)}


def test_ranges_split_a_key_evenly(spark):
    hot = spark.range(20_000).select(F.lit("one").alias("k"), F.lit(7).alias("t"), F.col("id"))
    sizes = [r["count"] for r in o.placed(hot, ["k", "t", "id"])[0].groupBy("__range").count().collect()]
    assert len(sizes) >= 60 and max(sizes) <= 20_000 * 2 / 64


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "k string, t long, id long, x long")
    assert o.lagged(empty, ["k"], ["t"], {"b": "x"}).count() == 0 and o.numbered(empty, ["k"], ["t"], "n").count() == 0
    one = spark.createDataFrame([("a", 1, 2, 3)], "k string, t long, id long, x long")
    assert o.lagged(one, ["k"], ["t"], {"b": "x"}).first().b is None and o.numbered(one, [], ["t"], "n").first().n == 1


def test_rules_of_a_split_device(spark, ranges):
    r = random.Random(4)
    rows, seq, ms = [], 0, 0
    for i in range(2000):
        seq, ms = seq + r.choice([1, 1, 1, 2]), ms + r.choice([0, 5, 5, 5])
        rows.append(("d", seq, ms, i))
    df = spark.createDataFrame(rows, "d string, seq long, ms long, id long").repartition(4)
    got = {x.id: x.rule for x in sequence_rules(df, "d", ["seq"], "seq", "ms").collect()}
    want = {b[3]: None if a is None else "sequence_gap" if b[1] - a[1] > 1 else "timestamp_not_advancing" if b[2] <= a[2] else None for a, b in zip([None, *rows], rows, strict=False)}
    assert got == want
    gaps = {x.id: x.gap_ms for x in inter_arrival(df, "d", "ms", "id").collect()}
    assert gaps == {b[3]: None if a is None else b[2] - a[2] for a, b in zip([None, *rows], rows, strict=False)}


def test_sliding_counts(spark, ranges):
    r = random.Random(6)
    times = [r.randint(-3000, 400_000) for _ in range(300)] + [700_123] * 400 + [None, 5_000_000]
    got = {x.window_start_s: x.n for x in sliding_counts(spark.createDataFrame([(t,) for t in times], "ms long"), "ms", 7).collect()}
    seconds = [t // 1000 for t in times if t is not None]
    starts = {s - i for s in seconds for i in range(7)}
    assert got == {s: sum(s <= t < s + 7 for t in seconds) for s in starts}


def test_sliding_counts_make_one_row_for_a_second(spark):
    """Many rows of each second: what comes after the first stage grows with seconds, not with rows."""
    df = spark.range(50_000).select((F.col("id") % 50 * 1000).alias("ms"))
    got = sliding_counts(df, "ms", 60).agg(F.count(F.lit(1)), F.max("n")).first()
    assert tuple(got) == (50 + 59, 50_000)


def pairs(left, right, window):
    return nearest_match(interval_join(prepare_left(left, "aid", "a_ms", window), prepare_right(right, "sid", "s_ms", F.col("sensor_type"), window), window))


@pytest.mark.parametrize("window", [1, 5, 200])
def test_nearest_equals_the_pairs(spark, ranges, window):
    r = random.Random(window)
    left = spark.createDataFrame([(i, r.choice([r.randint(-50, 2000), 777, 777, None])) for i in range(900)], "aid long, a_ms long")
    right = spark.createDataFrame([(f"s{r.randint(0, 300)}", r.choice([r.randint(-50, 1500), 770, None]), r.choice(["x", "y", None])) for i in range(250)], "sid string, s_ms long, sensor_type string")
    columns = ["aid", "a_ms", "sid", "s_ms", "sensor_type", "abs_dt"]
    rows = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert rows(nearest_in_order(left, right, window)) == rows(pairs(left, right, window))


def test_nearest_without_rows(spark):
    left, right = spark.createDataFrame([(1, 5)], "aid long, a_ms long"), spark.createDataFrame([], "sid long, s_ms long, sensor_type string")
    assert nearest_in_order(left, right, 10).count() == 0 and nearest_in_order(left.where("false"), right, 10).count() == 0
    only = spark.createDataFrame([(9, 7, "x")], right.schema)
    assert nearest_in_order(left, only, 2).collect()[0].sid == 9 and nearest_in_order(left, only, 1).count() == 0


def test_nearest_is_linear_in_a_burst(spark):
    """All left rows at one time, all right rows around it: no operator makes more rows than four times the input."""
    left = spark.range(20_000).select(F.col("id").alias("aid"), F.lit(1000).cast("long").alias("a_ms"))
    right = spark.range(20_000).select(F.col("id").alias("sid"), (F.col("id") % 5 + 998).alias("s_ms"), F.lit("x").alias("sensor_type"))
    df = nearest_in_order(left, right, 500)
    assert {(r.sid, r["count"]) for r in df.groupBy("sid").count().collect()} == {(2, 20_000)}
    df.collect()
    most = [0]

    def walk(node):
        name = node.nodeName()
        inner = node.executedPlan() if name.startswith("AdaptiveSparkPlan") else node.plan() if "QueryStage" in name else None
        metrics = node.metrics()
        if metrics.contains("numOutputRows"):
            most.append(metrics.apply("numOutputRows").value())
        for child in [inner] if inner is not None else [node.children().apply(i) for i in range(node.children().size())]:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    assert 20_000 <= max(most) <= 4 * 40_000


@pytest.mark.parametrize("rows_per_range", [None, 30])
def test_running_folds_and_percentiles(spark, monkeypatch, rows_per_range):
    """In one range and in many: sums, largest before, percentiles and ranks of groups of every size, null groups too."""
    from eventloom.operators.ranked import nearest_ranks, percentiles, running_max_before, running_sum

    if rows_per_range:
        monkeypatch.setattr(o, "ROWS_PER_RANGE", rows_per_range)
    r = random.Random(8)
    rows = [(r.choice(["hot", "hot", None, "a", "b"]), float(i) if i else None, r.choice([None, *range(-9, 9)]), r.choice([None, 1.5, 2.5, float(r.randint(0, 50))])) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, at double, x long, v double").repartition(3)
    sums, most = {}, {}
    for g in {k[0] for k in rows}:
        total, high = 0, None
        for _, at, x, _ in sorted((k for k in rows if k[0] == g), key=lambda k: (k[1] is not None, k[1] or 0)):
            most[at] = high
            total, high = total + (x or 0), x if high is None else high if x is None else max(high, x)
            sums[at] = total
    assert {k["at"]: k.s for k in running_sum(df, ["g"], "at", {"s": "x"}).collect()} == sums
    assert {k["at"]: k.m for k in running_max_before(df, ["g"], "at", {"m": "x"}).collect()} == most
    import numpy as np

    own = {g: sorted(k[3] for k in rows if k[0] == g and k[3] is not None) for g in {k[0] for k in rows}}
    got = {k.g: (k.lo, k.hi) for k in percentiles(df, ["g"], "v", {"lo": 0.25, "hi": 0.9}).collect()}
    assert got.keys() == own.keys() and all(np.allclose(got[g], np.percentile(v, [25, 90])) for g, v in own.items())
    ranks = {k.g: k.p for k in nearest_ranks(df, ["g"], "v", {"p": 0.9}).collect()}
    assert ranks == {g: v[round(0.9 * (len(v) - 1))] for g, v in own.items()}
    assert percentiles(df.where("false"), ["g"], "v", {"p": 0.5}).count() == 0 and percentiles(df, [], "v", {"p": 0.5}).first().p == pytest.approx(np.median([k[3] for k in rows if k[3] is not None]))


def test_split_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(o, "ROWS_PER_RANGE", 100)
    same(spark, catalog.QUERIES["stratified_split"], catalog.ORACLES["stratified_split"])


def test_sums_beside_columns_of_any_name(spark, ranges):
    df = spark.range(200).select(F.col("id").alias("__place"), F.lit(1).alias("__v0"), F.lit("x").alias("__all"))
    got = running_sum(df, ["__all"], "__place", {"n": "__v0"}).collect()
    assert sorted((r["__place"], r["__v0"], r["__all"], r.n) for r in got) == [(i, 1, "x", i + 1) for i in range(200)]
