"""Synthetic sensors and their anomalies, as expressions over a row number: the same for tables and for rate streams.

Every draw is a hash of seed, row and purpose, so that a lost task gives the same rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.operators import ordered as in_order
from eventloom.schemas import SENSOR_EVENT, SENSOR_TYPES

RATE, INTERVAL_MS = 0.03, 1000
# Normal ranges by sensor type, parameters of telemetry with unit and range, ranges under anomalies, devices.
NORMAL = {
    "RADAR": {"range_m": (50, 5000), "bearing_deg": (0, 360), "elevation_deg": (-30, 30), "velocity_ms": (-100, 300), "signal_strength_db": (-90, -20)},
    "LIDAR": {"centroid_x_m": (-100, 100), "centroid_y_m": (-100, 100), "centroid_z_m": (-10, 50), "max_range_m": (50, 500), "avg_intensity": (80, 220)},
}
POINTS, LEAST_INTENSITY, MOST_LEAST_INTENSITY, TARGETS = (10_000, 200_000), 20, 100, 500
PARAMETERS = {"cpu_temp_c": ("C", 35.0, 75.0), "battery_pct": ("%", 20.0, 100.0), "voltage_v": ("V", 11.0, 13.0)}
OUT_OF_RANGE = {"cpu_temp_c": (125.0, 180.0), "battery_pct": (110.0, 150.0), "voltage_v": (20.0, 30.0)}
ANOMALIES = {
    "RADAR": ("ghost_target", "velocity_spike", "sensor_dropout"),
    "LIDAR": ("noise_burst", "point_cloud_dropout", "ghost_point"),
    "TELEMETRY": ("out_of_range_value", "timestamp_stall", "missing_reading"),
}
#: (field, anomaly type): range of its values.
ANOMALOUS = {
    ("range_m", "ghost_target"): (7500, 12_000), ("bearing_deg", "ghost_target"): (380, 720), ("elevation_deg", "ghost_target"): (60, 90), ("signal_strength_db", "ghost_target"): (-145, -120), ("signal_strength_db", "sensor_dropout"): (-160, -145),
    ("avg_intensity", "noise_burst"): (350, 600), ("min_intensity", "noise_burst"): (250, 340), ("min_intensity", "point_cloud_dropout"): (0, 5),
    ("centroid_x_m", "ghost_point"): (600, 1000), ("centroid_y_m", "ghost_point"): (600, 1000), ("centroid_z_m", "ghost_point"): (300, 600), ("max_range_m", "ghost_point"): (10, 25),
}
#: By how much a noise burst moves a centroid, either way; speeds of a spike, either way; points left; gaps of a counter.
SHIFTS = {"centroid_x_m": 300, "centroid_y_m": 300, "centroid_z_m": 150}
SPIKE, FEW_POINTS, GHOST_POINTS, GAP = (800, 1500), (0, 10), 1, (2, 10)
DEVICES = {"RADAR": 3, "LIDAR": 3, "TELEMETRY": 5}


class Draws:
    """Draws for a row (column n) under a seed."""

    def __init__(self, seed: int, n: str = "n"):
        self.seed, self.n = seed, n

    def digest(self, what: str) -> Column:
        return F.md5(F.concat_ws(":", F.lit(self.seed), F.col(self.n).cast("string"), F.lit(what)))

    def unit(self, what: str) -> Column:
        """In [0, 1), by the first 52 bits of an MD5 that any engine can make."""
        return F.conv(F.substring(self.digest(what), 1, 13), 16, 10).cast("bigint") / float(1 << 52)

    def uniform(self, what: str, low, high) -> Column:
        low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
        return F.round(low + (high - low) * self.unit(what), 2)

    def integer(self, what: str, low: int, high: int) -> Column:
        return (F.floor(self.unit(what) * (high - low + 1)) + low).cast("int")

    def choice(self, what: str, values) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), self.integer(what, 1, len(values)))

    def uuid(self, what: str) -> Column:
        h = self.digest(what)
        return F.concat_ws("-", *[F.substring(h, a, k) for a, k in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def base_records(df: DataFrame, kind: str, base_ms: int, seed: int = 42, n: str = "n", devices: int | None = None) -> DataFrame:
    """Normal records of a sensor type for rows with a number: foreign fields null, label 0, no anomaly type."""
    if kind not in SENSOR_TYPES:
        raise ValueError(f"unsupported sensor type {kind}")
    d, own = Draws(seed, n), {}
    device = d.integer("device", 1, devices or 1)
    # One device numbers its rows in a row; several share them out, each with a sequence of its own by numbered().
    if kind == "RADAR":
        own = {"target_id": F.format_string("TARGET-%04d", d.integer("target", 1, TARGETS))}
    elif kind == "LIDAR":
        own = {"scan_id": d.uuid("scan"), "point_count": d.integer("point_count", *POINTS), "min_intensity": d.uniform("min_intensity", F.lit(float(LEAST_INTENSITY)), F.least(F.lit(float(MOST_LEAST_INTENSITY)), d.uniform("avg_intensity", *NORMAL[kind]["avg_intensity"])))}
    else:
        parameter = d.choice("parameter_name", list(PARAMETERS))
        of = lambda k: F.coalesce(*[F.when(parameter == p, F.lit(v[k])) for p, v in PARAMETERS.items()])
        own = {"device_id": F.format_string("SENSOR-UNIT-%02d", device), "parameter_name": parameter, "value": d.uniform("value", of(1), of(2)), "unit": of(0), "sequence_number": F.col(n) + 1}
    own |= {name: d.uniform(name, *span) for name, span in NORMAL.get(kind, {}).items()}
    common = {"event_id": d.uuid(f"event {kind}"), "sensor_id": F.format_string(f"{kind}-%02d", device), "sensor_type": F.lit(kind), "timestamp_ms": F.lit(base_ms) + (F.col(n) + 1) * INTERVAL_MS, "schema_version": F.lit("1.0")}
    fields = common | own
    return df.select(F.col(n).alias("n"), *[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in SENSOR_EVENT], F.lit(0).alias("label"), F.lit(None).cast("string").alias("anomaly_type"))


def inject(df: DataFrame, kind: str, rate: float = RATE, seed: int = 42) -> DataFrame:
    """Turns a share of rows into anomalies of types drawn evenly; sets label and anomaly_type."""
    if not 0.0 <= rate <= 1.0:
        raise ValueError("rate must be between 0 and 1")
    d = Draws(seed)
    marked = df.withColumn("anomaly_type", F.when(d.unit("hit") < rate, d.choice("kind", ANOMALIES[kind]))).withColumn("label", F.col("anomaly_type").isNotNull().cast("int"))
    return mutate(marked, seed)


def mutate(df: DataFrame, seed: int = 42) -> DataFrame:
    """Applies the mutation that anomaly_type names to each row."""
    d, t = Draws(seed), F.col("anomaly_type")
    new: dict[str, list] = {}
    for (name, kind), span in ANOMALOUS.items():
        new.setdefault(name, []).append((kind, d.uniform(f"{kind} {name}", *span)))
    for name, by in SHIFTS.items():
        new.setdefault(name, []).append(("noise_burst", F.round(F.col(name) + d.uniform(f"shift {name}", -by, by), 2)))
    sign = F.when(d.unit("sign") < 0.5, -1.0).otherwise(1.0)
    new["velocity_ms"] = [("velocity_spike", F.round(sign * d.uniform("spike", *SPIKE), 2))]
    new["point_count"] = [("point_cloud_dropout", d.integer("few", *FEW_POINTS)), ("ghost_point", F.lit(GHOST_POINTS))]
    new["value"] = [("out_of_range_value", F.coalesce(*[F.when(F.col("parameter_name") == p, d.uniform(f"far {p}", *r)) for p, r in OUT_OF_RANGE.items()]))]
    new["timestamp_ms"] = [("timestamp_stall", F.col("timestamp_ms") - INTERVAL_MS)]
    new["sequence_number"] = [("missing_reading", F.col("sequence_number") + d.integer("gap", *GAP))]
    out = {}
    for name, cases in new.items():
        value = F.col(name)
        for kind, made in cases:
            value = F.when(t == kind, made.cast(df.schema[name].dataType)).otherwise(value)
        out[name] = value
    return df.withColumns(out)


def resync(df: DataFrame, device: str = "device_id", n: str = "n", seed: int = 42) -> DataFrame:
    """Telemetry whose counter goes on from where a gap has left it: numbers and times move by the sum of gaps before."""
    gap = F.when(F.col("anomaly_type") == "missing_reading", Draws(seed).integer("gap", *GAP)).otherwise(0)
    w = Window.partitionBy(device).orderBy(n).rowsBetween(Window.unboundedPreceding, -1)
    shifted = df.withColumn("__moved", F.coalesce(F.sum(gap).over(w), F.lit(0)))
    return shifted.withColumns({"sequence_number": F.col("sequence_number") + F.col("__moved"), "timestamp_ms": F.col("timestamp_ms") + F.col("__moved") * INTERVAL_MS}).drop("__moved")


def generate(spark: SparkSession, kind: str, count: int = 50_000, base_ms: int = 1_700_000_000_000, rate: float = RATE, seed: int = 42) -> DataFrame:
    rows = inject(base_records(spark.range(count).select(F.col("id").alias("n")), kind, base_ms, seed), kind, rate, seed)
    return resync(rows, seed=seed) if kind == "TELEMETRY" else rows


def generate_stream(spark: SparkSession, kind: str, per_second: int, base_ms: int, rate: float = RATE, seed: int = 42) -> DataFrame:
    """An endless stream of the same records."""
    return inject(base_records(spark.readStream.format("rate").option("rowsPerSecond", per_second).load().select(F.col("value").alias("n")), kind, base_ms, seed, devices=DEVICES[kind]), kind, rate, seed)


def numbered(df: DataFrame, device: str, order: str) -> DataFrame:
    """A sequence of its own for each device, of any size."""
    return in_order.numbered(df, [device], [order], "sequence_number")


def inject_lateness(df: DataFrame, ms: str, id_col: str, share: float, least_ms: int, most_ms: int, buffer: int = 0, seed: int = 42) -> DataFrame:
    """Moves a share of rows back by a drawn time, and shuffles arrival within blocks of buffer rows (column arrival)."""
    if not 0 <= share <= 1 or least_ms < 0 or most_ms < least_ms or buffer < 0:
        raise ValueError("share in [0, 1], 0 <= least <= most, buffer >= 0")
    d = Draws(seed, id_col)
    out = df.withColumn("shift_ms", F.when(d.unit("late") < share, d.integer("by", least_ms, most_ms)).otherwise(0)).withColumn(ms, F.col(ms) - F.col("shift_ms"))
    if buffer > 1:
        out = out.withColumn("arrival", F.floor(F.col("arrival") / buffer) * buffer + d.unit("place") * buffer)
    return out
