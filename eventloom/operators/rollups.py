"""Rollups, percentiles and quality-of-detection measures; all aggregates combine before the shuffle where they can."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranked import inclusive_ranks, nearest_ranks, percentiles, running_sum

from eventloom.functions.scalars import nearest_rank, time_bucket
from eventloom.storage import stored


def anomaly_rate(label: Column) -> Column:
    """Mean of 0/1 labels; other labels and nulls don't count, and a group of these alone has none."""
    return F.avg(F.when(label == 1, 1.0).when(label == 0, 0.0))


def summary_5min(df: DataFrame, ms: str = "timestamp_ms", kind: str = "sensor_type", loss: str = "data_loss_pct", latency: str = "latency_ms", label: str = "anomaly_label", width_ms: int = 300_000, wide: bool = False) -> DataFrame:
    """One row for each bucket and sensor type. p95 is exact: from a buffer of the group's distinct values, or with wide (groups
    of very many distinct values, as over whole days) from counts over ranges of them.
    """
    named = df.withColumns({"bucket": time_bucket(F.col(ms), width_ms), "sensor_type": F.col(kind)})
    means = [F.count(F.lit(1)).alias("event_count"), F.avg(loss).alias("avg_data_loss"), F.avg(latency).alias("avg_latency")]
    rate = anomaly_rate(F.col(label)).alias("anomaly_rate")
    if not wide:
        return named.groupBy("bucket", "sensor_type").agg(*means, F.percentile(latency, F.lit(0.95)).alias("p95_latency"), rate)
    p95 = percentiles(named, ["bucket", "sensor_type"], latency, {"p95_latency": 0.95}).toDF("__bucket", "__type", "p95_latency")
    joined = named.groupBy("bucket", "sensor_type").agg(*means, rate).join(p95, F.col("bucket").eqNullSafe(F.col("__bucket")) & F.col("sensor_type").eqNullSafe(F.col("__type")), "left")
    return joined.select("bucket", "sensor_type", "event_count", "avg_data_loss", "avg_latency", "p95_latency", "anomaly_rate")


def summary_5min_plain(df: DataFrame, ms: str, label: str, risk: str, width_ms: int = 300_000) -> DataFrame:
    """The older rollup without sensor types, which the summary endpoint still names."""
    return df.groupBy(time_bucket(F.col(ms), width_ms).alias("bucket")).agg(
        F.count(F.lit(1)).alias("total_fused_events"), F.count_if(F.col(label) == 1).alias("anomaly_count"), F.avg(risk).alias("avg_risk_score"), F.max(risk).alias("max_risk_score"),
    )


def window_counts(df: DataFrame, ts: str, by: str, width: str = "5 seconds", slide: str | None = None) -> DataFrame:
    return df.groupBy(F.window(ts, width, slide) if slide else F.window(ts, width), by).agg(F.count(F.lit(1)).alias("count"))


def perf_sketch(df: DataFrame, ms: str, by: str, latency: str, loss: str, width_ms: int = 60_000) -> DataFrame:
    """One-minute rollup that keeps a quantile sketch as its state."""
    return df.groupBy(time_bucket(F.col(ms), width_ms).alias("bucket"), by).agg(
        F.count(F.lit(1)).alias("event_count"), F.kll_sketch_agg_double(latency).alias("latency_sketch"), F.avg(loss).alias("avg_data_loss")
    )


def perf_exact(df: DataFrame, ms: str, by: str, latency: str, loss: str, width_ms: int = 60_000) -> DataFrame:
    """The rollup of perf_sketch with the exact p95 (of inclusive rank) in place of the sketch, for groups of any size."""
    named = df.withColumns({"bucket": time_bucket(F.col(ms), width_ms), "__by": F.col(by)})
    p95 = inclusive_ranks(named, ["bucket", "__by"], latency, {"p95": "0.95"}).withColumnRenamed("bucket", "__bucket")
    joined = perf_sketch(df, ms, by, latency, loss, width_ms).drop("latency_sketch").join(p95, F.col("bucket").eqNullSafe(F.col("__bucket")) & F.col(by).eqNullSafe(F.col("__by")), "left")
    return joined.select("bucket", by, "event_count", "p95", "avg_data_loss")


def sketch_quantile(sketch: Column, p: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(p))


def merge_sketches(rollup: DataFrame, width_ms: int, by: str) -> DataFrame:
    return rollup.groupBy(time_bucket(F.col("bucket"), width_ms).alias("bucket"), by).agg(F.sum("event_count").alias("event_count"), F.kll_merge_agg_double("latency_sketch").alias("latency_sketch"))


def cascade(rollup: DataFrame, width_ms: int, by: str) -> DataFrame:
    """A coarser level from a finer: counts add up, p95 is the largest (an upper bound), means are means of means."""
    return rollup.groupBy(time_bucket(F.col("bucket"), width_ms).alias("bucket"), by).agg(
        F.sum("event_count").alias("event_count"), F.max("p95_latency").alias("p95_latency"), F.avg("avg_latency").alias("avg_latency")
    )


def refresh_window(old: DataFrame, fresh: DataFrame, now_ms: int, start_offset_ms: int = 900_000, end_offset_ms: int = 300_000, width_ms: int = 300_000) -> DataFrame:
    """The rollup after a refresh: whole buckets inside [now - start, now - end] come from fresh, all others stay."""
    low, high = -((start_offset_ms - now_ms) // width_ms) * width_ms, (now_ms - end_offset_ms) // width_ms * width_ms
    inside = (F.col("bucket") >= low) & (F.col("bucket") < high)
    return old.where(~inside).unionByName(fresh.where(inside))


def retained(df: DataFrame, ms: str, now_ms: int, days: int) -> DataFrame:
    return df.where(F.col(ms) >= now_ms - days * 86_400_000)


def alignment_summary(df: DataFrame, dt: str, window_ms: int) -> DataFrame:
    """n, min, nearest-rank percentiles, max, mean, and counts within 1 ms, at and over the window.

    Percentiles take exact ranks of value counts: one row for each distinct distance, never a list of all samples.
    """
    counts = stored(df.groupBy(F.col(dt).alias("dt")).agg(F.count(F.lit(1)).alias("here")), "distances")  # read three times
    total = counts.agg(F.sum("here").alias("n"))  # one row
    ordered = running_sum(counts, [], "dt", {"upto": "here"}).crossJoin(F.broadcast(total))
    at = lambda p: F.min(F.when(F.col("upto") > F.bround(F.lit(p) * (F.col("n") - 1)), F.col("dt")))
    within = lambda c: F.coalesce(F.sum(F.when(c, F.col("here"))), F.lit(0))
    return ordered.agg(
        F.coalesce(F.sum("here"), F.lit(0)).alias("n"), F.min("dt").alias("min"), at(0.5).alias("p50"), at(0.9).alias("p90"), at(0.95).alias("p95"), at(0.99).alias("p99"), F.max("dt").alias("max"),
        F.round(F.try_divide(F.sum(F.col("dt") * F.col("here")), F.sum("here")), 2).alias("mean"), within(F.col("dt") > window_ms).alias("over_window"), within(F.col("dt") == window_ms).alias("at_window"),
        within(F.col("dt") <= 1).alias("within_1ms"), F.round(F.try_divide(within(F.col("dt") <= 1) * 100.0, F.sum("here")), 2).alias("within_1ms_pct"),
    )


def nearest_rank_percentiles(df: DataFrame, value: str, by: str, ps: tuple[float, ...] = (0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """Exact nearest-rank percentiles of groups of any size."""
    found = nearest_ranks(df, [by], value, {f"p{round(p * 100)}": p for p in ps})
    return found.select(by, *[F.col(f"p{round(p * 100)}").cast(df.schema[value].dataType).alias(f"p{round(p * 100)}") for p in ps])


def small_nearest_rank(df: DataFrame, value: str, by: str, p: float) -> DataFrame:
    """The same for groups known to be small, such as the samples of a batch."""
    return df.groupBy(by).agg(nearest_rank(F.sort_array(F.collect_list(value)), p).alias("value"))


def enforcement_metrics(df: DataFrame, by: str, ok: Column) -> DataFrame:
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("passed"), F.count_if(~ok).alias("rejected"), F.coalesce(F.bround(F.try_divide(F.count_if(~ok) * 100.0, F.count(F.lit(1))), 4), F.lit(0.0)).alias("data_loss_pct")
    )


def track_totals(df: DataFrame, tracks: str, mass: float = 0.13957) -> DataFrame:
    """Momentum sums, greatest and total energy of a row's tracks (struct px, py, pz); zeros without tracks."""
    t = F.coalesce(F.col(tracks), F.array().cast("array<struct<px:double,py:double,pz:double>>"))
    total = lambda part: F.aggregate(t, F.lit(0.0), lambda s, x: s + part(x))
    energy = lambda x: F.sqrt(x["px"] * x["px"] + x["py"] * x["py"] + x["pz"] * x["pz"] + F.lit(mass * mass))
    return df.withColumns({
        "track_count": F.size(t), "net_momentum_x": total(lambda x: x["px"]), "net_momentum_y": total(lambda x: x["py"]), "net_momentum_z": total(lambda x: x["pz"]),
        "max_energy_gev": F.coalesce(F.array_max(F.transform(t, energy)), F.lit(0.0)), "total_energy_gev": total(energy),
    })


def momentum(alpha: Column, p2: Column, p3: Column, p4: Column, clamp: bool = False) -> Column:
    """px, py, pz from the five track parameters that files hold: p2 = sin(phi), p3 = tan(dip), p4 = charge / pt."""
    pt = F.try_divide(F.lit(1.0), F.abs(p4))
    phi = alpha + F.asin(F.greatest(F.least(p2, F.lit(1.0)), F.lit(-1.0)) if clamp else p2)
    return F.struct((pt * F.cos(phi)).alias("px"), (pt * F.sin(phi)).alias("py"), (pt * p3).alias("pz"))


def median_mad(df: DataFrame, by: str, value: str) -> DataFrame:
    """Median and median absolute deviation of each group; a deviation of 0 counts as 1. Groups may be of any size."""
    med = percentiles(df, [by], value, {"med": 0.5})
    # Few groups are the rule here (features, parameters), but nothing bounds them: the join is the planner's.
    away = df.join(med, by).select(by, F.abs(F.col(value) - F.col("med")).alias("away"))
    return med.join(percentiles(away, [by], "away", {"m": 0.5}), by).select(by, "med", F.when(F.col("m") > 0, F.col("m")).otherwise(1.0).alias("mad"))


def value_stats(df: DataFrame, by: str, value: str, normal: Column, train: Column) -> DataFrame:
    """Mean and population deviation of normal training rows."""
    return df.where(normal & train).groupBy(by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, truth: Column, flagged: Column, *by: str) -> DataFrame:
    """Rates of false alarms and recall (null without negatives or positives), precision (0 without alarms)."""
    tp, fp = F.count_if(truth & flagged), F.count_if(~truth & flagged)
    return df.groupBy(*by).agg(
        F.try_divide(fp, F.count_if(~truth)).alias("fpr"), F.try_divide(tp, F.count_if(truth)).alias("recall"), F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"), tp.alias("true_alarms"), fp.alias("false_alarms"),
    )


def roc_auc(df: DataFrame, score: str, truth: Column, *by: str) -> DataFrame:
    """Mann-Whitney area with ties as halves, from counts of each distinct score; null with one class only."""
    counts = df.groupBy(*by, score).agg(F.count_if(truth).alias("p"), F.count_if(~truth).alias("q"))
    won = running_sum(counts, list(by), score, {"upto": "q"}).withColumn("won", F.col("p") * (F.col("upto") - F.col("q") / 2.0))
    return won.groupBy(*by).agg(F.try_divide(F.sum("won"), F.sum("p") * F.sum("q")).alias("auc"))


def evaluation(df: DataFrame, truth: Column, flagged: Column, score: str, by: str, pooled: str = "pooled") -> DataFrame:
    """Area, rates and counts of each stream, and of all rows together under the name pooled."""
    every = df.unionByName(df.withColumn(by, F.lit(pooled)))
    counts = every.groupBy(by).agg(F.count(F.lit(1)).alias("n_test"), F.count_if(truth).alias("n_anomalies"))
    return roc_auc(every, score, truth, by).join(confusion(every, truth, flagged, by), by).join(counts, by)


def variants(df: DataFrame, truth: Column, detectors: dict[str, str], rule: Column, line: float = 0.99) -> DataFrame:
    """variant, fpr, recall, precision of each detector (name: its risk) with and without rules, and of both: either alarms at the line, or at half the budget."""
    risks = [F.col(c) for c in detectors.values()]
    either, half = F.greatest(*risks), 1.0 - (1.0 - line) / 2
    hits = {name: (F.col(c) >= line) | rule for name, c in detectors.items()} | {f"{name}_no_rules": F.col(c) >= line for name, c in detectors.items()}
    hits |= {"either": (either >= line) | rule, "either_half_budget": (either >= half) | rule}
    long = df.select(truth.alias("truth"), F.explode(F.array(*[F.struct(F.lit(n).alias("variant"), h.alias("hit")) for n, h in hits.items()])).alias("v")).select("truth", "v.*")
    return confusion(long, F.col("truth"), F.col("hit"), "variant")


def alarm_sources(df: DataFrame, reason: str, truth: Column) -> DataFrame:
    parts = df.where(F.col(reason) != "").select(truth.alias("truth"), F.explode(F.split(reason, r"\+")).alias("part"))
    return parts.groupBy(F.split_part("part", F.lit(":"), F.lit(1)).alias("source")).agg(F.count_if("truth").alias("true_alarms"), F.count_if(~F.col("truth")).alias("false_alarms"))


#: A prime below 2^31: products of two numbers under it fit a long, here and in any SQL.
PRIME = 2_147_483_647
#: Up to how many hundred-millionths of draws a row counts 0, 1, 2 ... times in a resample (Poisson with mean 1).
POISSON = tuple(round(1e8 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(11))


def id_numbers(id_col: str, seed: int = 42) -> list[Column]:
    """Three numbers of 28 bits of the MD5 of a row's id."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return [F.conv(F.substring(digest, at, 7), 16, 10).cast("long") for at in (1, 8, 15)]


def poisson_weight(id_col: str, draw: Column, seed: int = 42, numbers: list[Column] | None = None) -> Column:
    """How often a row counts in a resample: 0, 1, 2 ... with mean 1, from a hash of its id and the resample's number.

    Two numbers of a row's MD5 and the resample's number give a point modulo PRIME, which is squared and mixed; the table POISSON
    is read backwards with it. Any engine gives the same numbers, and a lost task gives them again.
    """
    one, two, three = numbers or id_numbers(id_col, seed)
    x = F.pmod(one + (draw + 1) * two, F.lit(PRIME))
    y = F.pmod(F.pmod(x * x, F.lit(PRIME)) * F.lit(48_271) + three, F.lit(PRIME))
    mixed = F.pmod(y * y + x, F.lit(PRIME))
    point = F.floor(mixed * F.lit(100_000_000) / F.lit(PRIME))
    return sum((F.when(point >= p, 1).otherwise(0) for p in POISSON), F.lit(0)).cast("long")


def bootstrap_interval(df: DataFrame, truth: str, flagged: str, by: str, id_col: str, draws: int = 200, seed: int = 42) -> DataFrame:
    """95 % interval of recall and false-alarm rate over Poisson resamples; resamples of one class are left out.

    truth and flagged are 0 or 1. A resample is one aggregation like all others: each row counts as often as its id's
    hash says, so four sums for each group and resample leave a task, whatever the rows.
    """
    named = [f"__h{k}" for k in range(3)]  # hashed once for each row, not for each resample
    many = df.select(by, truth, flagged, *[c.alias(n) for c, n in zip(id_numbers(id_col, seed), named, strict=True)]).withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    weighed = many.withColumn("w", poisson_weight(id_col, F.col("draw"), seed, [F.col(n) for n in named]))
    sums = weighed.groupBy(by, "draw").agg(*[F.sum(F.when((F.col(truth) == t) & (F.col(flagged) == f), F.col("w")).otherwise(0)).alias(f"c{t}{f}") for t in (0, 1) for f in (0, 1)])
    rates = sums.where("c00 + c01 > 0 AND c10 + c11 > 0").select(by, (F.col("c11") / (F.col("c10") + F.col("c11"))).alias("recall"), (F.col("c01") / (F.col("c00") + F.col("c01"))).alias("fpr"))
    # draws numbers for each group.
    ends = rates.groupBy(by).agg(*[F.percentile(c, p).alias(f"{c}_{end}") for c in ("recall", "fpr") for end, p in (("low", 0.025), ("high", 0.975))])
    groups = df.select(F.col(by).alias("__by")).distinct()
    return groups.join(ends, F.col("__by").eqNullSafe(F.col(by)), "left").select(F.col("__by").alias(by), "recall_low", "recall_high", "fpr_low", "fpr_high")
