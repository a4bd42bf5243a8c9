"""Validation, enforcement and conformance; the order of checks is data, and the first that fails gives the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, StructType

from eventloom.functions.scalars import float32_finite, is_uuid
from eventloom.schemas import PHYSICS_REQUIRED, SCHEMA_VERSION, SENSOR_REQUIRED, SENSOR_TYPES, STREAM_VERSIONS, TYPE_REQUIRED

Check = tuple[Column, str | Column]


def first_failure(checks: list[Check]) -> Column:
    """Reason of the first check that is true; null if none is (a null check isn't true)."""
    return F.coalesce(*[F.when(bad, F.lit(why) if isinstance(why, str) else why) for bad, why in checks])


def all_failures(checks: list[Check]) -> Column:
    return F.array_compact(F.array(*[F.when(bad, F.lit(why) if isinstance(why, str) else why) for bad, why in checks]))


def _absent(names, prefix: str = "required field missing or null: ") -> list[Check]:
    return [(F.col(n).isNull(), prefix + n) for n in names]


def _common_tail() -> list[Check]:
    return [(~is_uuid(F.col("event_id").cast("string")), "event_id is not a valid UUID v4"), (F.coalesce(F.col("timestamp_ms"), F.lit(0)) <= 0, "timestamp_ms must be a positive integer")]


def staging_physics() -> Column:
    version = ~F.col("schema_version").eqNullSafe(F.lit(SCHEMA_VERSION))
    return first_failure([(version, f"schema_version must be '{SCHEMA_VERSION}'"), *_absent(PHYSICS_REQUIRED), *_common_tail()])


def staging_sensor() -> Column:
    version, kind = ~F.col("schema_version").eqNullSafe(F.lit(SCHEMA_VERSION)), F.upper("sensor_type")
    by_type = [((kind == t) & F.col(n).isNull(), f"required {t} field missing or null: {n}") for t, names in TYPE_REQUIRED.items() for n in names]
    return first_failure([
        (version, f"schema_version must be '{SCHEMA_VERSION}'"), *_absent(SENSOR_REQUIRED), (~kind.isin(*SENSOR_TYPES), F.concat(F.lit("sensor_type not supported: "), kind)), *by_type, *_common_tail(),
    ])


def promotion_physics() -> Column:
    missing = lambda n: F.col(n).isNull()
    below = lambda n: missing(n) | (F.col(n) < 0)
    return first_failure([
        (missing("event_id") | (F.col("event_id") == ""), "event_id missing"), (missing("timestamp_ms") | (F.col("timestamp_ms") <= 0), "timestamp_ms invalid"), (missing("run_number"), "run_number missing"),
        (below("track_count"), "track_count invalid"), *[(missing(f"net_momentum_{a}"), f"net_momentum_{a} missing") for a in "xyz"], (below("max_energy_gev"), "max_energy_gev invalid"), (below("total_energy_gev"), "total_energy_gev invalid"),
    ])


def promotion_sensor() -> Column:
    return first_failure([
        (F.col("event_id").isNull() | (F.col("event_id") == ""), "event_id missing"), (F.col("timestamp_ms").isNull() | (F.col("timestamp_ms") <= 0), "timestamp_ms invalid"),
        (~F.coalesce(F.upper("sensor_type").isin(*SENSOR_TYPES), F.lit(False)), "sensor_type invalid"), (~F.coalesce(F.col("label").isin(0, 1), F.lit(False)), "label invalid"),
    ])


def _outside(name: str, low: float | None, high: float | None, why: str) -> Check:
    c = F.col(name)
    bad = (c < low) if high is None else (c > high) if low is None else ~c.between(low, high)
    return bad, f"{name}: {why}"


def sensor_ranges() -> Column:
    """Every range rule that a sensor row breaks, in order; nulls break none."""
    of = lambda t, check: ((F.col("sensor_type") == t) & check[0], check[1])
    floor0 = lambda n: _outside(n, 0, None, "must be greater than or equal to 0")
    return all_failures([
        (~F.coalesce(F.col("sensor_type").isin(*SENSOR_TYPES), F.lit(False)), "sensor_type: unsupported sensor type"),
        (F.col("timestamp_ms") <= 0, "timestamp_ms: must be greater than 0"), (~F.col("schema_version").eqNullSafe(F.lit(SCHEMA_VERSION)), "schema_version: must equal 1.0"),
        of("RADAR", floor0("range_m")), of("RADAR", _outside("bearing_deg", 0, 360, "must be between 0 and 360")), of("RADAR", _outside("elevation_deg", -90, 90, "must be between -90 and 90")),
        *[of("LIDAR", floor0(n)) for n in ("point_count", "max_range_m", "avg_intensity", "min_intensity")],
        of("LIDAR", (F.col("min_intensity") > F.col("avg_intensity"), "min_intensity: must not exceed avg_intensity")), of("TELEMETRY", floor0("sequence_number")),
        of("TELEMETRY", ((F.col("parameter_name") == "battery_pct") & ~F.col("value").between(0, 100), "value: battery_pct must be between 0 and 100")),
    ])


def physics_ranges() -> Column:
    over0 = lambda n: (F.col(n) <= 0, f"{n}: must be greater than 0")
    floor0 = lambda n: _outside(n, 0, None, "must be greater than or equal to 0")
    return all_failures([
        over0("run_number"), over0("timestamp_ms"), floor0("track_count"), floor0("max_energy_gev"), floor0("total_energy_gev"),
        (F.col("max_energy_gev") > F.col("total_energy_gev"), "max_energy_gev: must not exceed total_energy_gev"), (~F.col("schema_version").eqNullSafe(F.lit(SCHEMA_VERSION)), "schema_version: must equal 1.0"),
    ])


def absent_keys(raw: str, names) -> Column:
    """Names that a raw JSON record doesn't have at all; a key with a null is there."""
    return F.array_except(F.array(*map(F.lit, names)), F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>")))


def null_or_absent(names) -> Column:
    return all_failures([(F.col(n).isNull(), n) for n in names])


@dataclass
class Enforced:
    valid: DataFrame
    rejected: DataFrame
    metrics: DataFrame
    #: Rows of both kinds with their reason.
    judged: DataFrame


def enforce(df: DataFrame, stream: str, schema: StructType, domains: dict[str, tuple[str, ...]] | None = None, extra: Column | None = None) -> Enforced:
    """Splits rows by version drift and by whether a record survives its wire type.

    A null version is stamped, another one is drift. A record doesn't survive if a field that can't be null is, if a
    text is outside its domain, or a number is NaN or beyond 32 bits; extra marks records with unknown or missing keys.
    """
    version = STREAM_VERSIONS[stream]
    lost: list[Check] = [(F.coalesce(extra, F.lit(False)), "unknown or missing key")] if extra is not None else []
    for f in schema:
        if f.name == "schema_version":
            continue
        if not f.nullable:
            lost.append((F.col(f.name).isNull(), f"{f.name} is null"))
        if isinstance(f.dataType, FloatType):
            lost.append((~float32_finite(F.col(f.name)), f"{f.name} doesn't fit"))
        if domains and f.name in domains:
            lost.append((~F.col(f.name).isin(*domains[f.name]), f"{f.name} outside its domain"))
    drift = F.col("schema_version").isNotNull() & (F.col("schema_version") != version)
    judged = df.withColumn("reason", first_failure([(drift, "version drift"), *lost]))
    valid = judged.where("reason IS NULL").withColumn("schema_version", F.lit(version)).drop("reason")
    metrics = judged.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("reason").isNull()).alias("passed"), F.count("reason").alias("rejected"), F.count_if(F.col("reason") == "version drift").alias("version_drift"),
        F.coalesce(F.bround(F.try_divide(F.count("reason") * 100.0, F.count(F.lit(1))), 4), F.lit(0.0)).alias("data_loss_pct"),
    )
    return Enforced(valid, judged.where("reason IS NOT NULL"), metrics, judged)


def survives_exactly(x: Column) -> Column:
    """Strict check of one number: its 32-bit form is the same number."""
    return x.cast("float").cast("double") == x.cast("double")


def survives_nearly(x: Column, tolerance: float = 1e-3) -> Column:
    """Producer's check: the 32-bit form is within an absolute tolerance."""
    return F.abs(x.cast("float").cast("double") - x.cast("double")) < tolerance


def fused_conformance(df: DataFrame, window_ms: int = 500, types=SENSOR_TYPES) -> DataFrame:
    """One row: how many fused rows break each of nine checks, and duplicates of the fused id."""
    bad = lambda ok: F.count_if(~F.coalesce(ok, F.lit(False)))
    ids = [bad(is_uuid(F.col(c).cast("string"))).alias(f"bad_{c}") for c in ("fused_event_id", "alice_event_id", "sensor_event_id")]
    scored = [F.count(c).alias(f"set_{c}") for c in ("anomaly_label", "risk_score", "confidence") if c in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("total"), *ids, bad(F.col("timestamp_ms") > 0).alias("bad_timestamp_ms"), bad(F.col("fusion_window_ms") == window_ms).alias("bad_fusion_window_ms"), bad(F.col("sensor_type").isin(*types)).alias("bad_sensor_type"),
        bad(F.col("data_loss_pct").between(0, 100)).alias("bad_data_loss_pct"), bad(F.col("latency_ms") >= 0).alias("bad_latency_ms"), bad(F.col("schema_version") == SCHEMA_VERSION).alias("bad_schema_version"), *scored,
        (F.count(F.lit(1)) - F.countDistinct("fused_event_id")).alias("duplicate_ids"),
    )


def score_checks() -> Column:
    """Table constraints on scores; nulls pass."""
    ok = lambda c: F.coalesce(c, F.lit(True))
    return ok(F.col("anomaly_label").isin(0, 1)) & ok(F.col("risk_score").between(0, 1)) & ok(F.col("confidence").between(0, 1))


def bar_checks(throughput: Column, p95: Column, loss: Column) -> dict[str, Column]:
    return {"throughput_ok": throughput >= 10_000, "latency_ok": p95 <= 500, "loss_ok": loss <= 1}


def label_checks(types: tuple[str, ...]) -> Column:
    """A label is 0 exactly if no anomaly type is given, and the type is one of the taxonomy."""
    a = F.col("anomaly_type")
    return ((F.col("label") == 0) == a.isNull()) & F.coalesce(a.isin(*types), F.lit(True))


def class_balance(df: DataFrame, by: str, wanted: float, tolerance: float = 0.003) -> DataFrame:
    """by, n, share of label 1, balanced: whether the share is within tolerance (0.3 percentage points) of the wanted one."""
    share = F.avg((F.col("label") == 1).cast("double"))
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), share.alias("share"), (F.abs(share - wanted) <= tolerance).alias("balanced"))


def cleaned(df: DataFrame, now_ms: Column, dedup_ms: int = 10_000) -> DataFrame:
    """Drops rows without id and rows from over 5 s ahead; of rows that repeat an id within dedup_ms of the one before only the first stays."""
    from pyspark.sql import Window

    w = Window.partitionBy("event_id").orderBy("timestamp_ms")
    fit = df.where(F.col("event_id").isNotNull() & (F.col("timestamp_ms") <= now_ms + 5000))
    return fit.withColumn("__gap", F.col("timestamp_ms") - F.lag("timestamp_ms").over(w)).where("__gap IS NULL OR __gap > " + str(dedup_ms)).drop("__gap")


def quality_counters(df: DataFrame, violations: Column) -> DataFrame:
    """How often each violation occurs."""
    return df.select(F.explode(violations).alias("violation")).groupBy("violation").agg(F.count(F.lit(1)).alias("n"))
