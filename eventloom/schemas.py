"""Record types of the event families, always given and never inferred."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, DoubleType, FloatType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

STR, INT, LONG, F32, F64, TS = StringType(), IntegerType(), LongType(), FloatType(), DoubleType(), TimestampType()


def _struct(*fields: tuple[str, DataType, bool]) -> StructType:
    return StructType([StructField(name, kind, null) for name, kind, null in fields])


# Names, order, types and nullability of the records' fields.
#: One record for each collision.
PHYSICS_EVENT = _struct(
    ("event_id", STR, False),
    ("run_number", INT, False),
    ("timestamp_ms", LONG, False),
    ("track_count", INT, False),
    ("net_momentum_x", F32, False),
    ("net_momentum_y", F32, False),
    ("net_momentum_z", F32, False),
    ("max_energy_gev", F32, False),
    ("total_energy_gev", F32, False),
    ("schema_version", STR, False),
)
#: Fields that have a default (0.0) where a record lacks them.
DEFAULTED = ("net_momentum_x", "net_momentum_y", "net_momentum_z", "max_energy_gev", "total_energy_gev")
#: One wide record for all sensors; fields of other sensor types are null.
SENSOR_EVENT = _struct(
    ("event_id", STR, False),
    ("sensor_id", STR, False),
    ("sensor_type", STR, False),
    ("timestamp_ms", LONG, False),
    ("target_id", STR, True),
    ("range_m", F32, True),
    ("bearing_deg", F32, True),
    ("elevation_deg", F32, True),
    ("velocity_ms", F32, True),
    ("signal_strength_db", F32, True),
    ("scan_id", STR, True),
    ("point_count", INT, True),
    ("centroid_x_m", F32, True),
    ("centroid_y_m", F32, True),
    ("centroid_z_m", F32, True),
    ("max_range_m", F32, True),
    ("avg_intensity", F32, True),
    ("min_intensity", F32, True),
    ("device_id", STR, True),
    ("parameter_name", STR, True),
    ("value", F32, True),
    ("unit", STR, True),
    ("sequence_number", LONG, True),
    ("schema_version", STR, False),
)
FUSED_EVENT = _struct(
    ("fused_event_id", STR, False),
    ("alice_event_id", STR, False),
    ("sensor_event_id", STR, False),
    ("timestamp_ms", LONG, False),
    ("sensor_type", STR, False),
    ("fusion_window_ms", INT, False),
    ("data_loss_pct", F32, False),
    ("latency_ms", F32, False),
    ("schema_version", STR, False),
)
AUDIT = _struct(("load_timestamp", TS, False), ("batch_id", STR, False), ("load_status", STR, False))
SCORES = _struct(("anomaly_label", INT, True), ("risk_score", F64, True), ("confidence", F64, True))
FUSION_STATUS = _struct(
    ("time", TS, False),
    ("source_type", STR, False),
    ("quality_score", INT, True),
    ("contribution_weight", F64, True),
    ("data_loss", F64, True),
    ("latency", F64, True),
    ("status", STR, True),
)
ALERT = _struct(
    ("fused_event_id", STR, False),
    ("timestamp_ms", LONG, False),
    ("source_type", STR, False),
    ("anomaly_label", INT, False),
    ("risk_score", F64, False),
    ("confidence", F64, False),
    ("model_version", STR, False),
    ("status", STR, False),
    ("status_updated_at", LONG, True),
    ("explanation_summary", STR, True),
)
SHAP_VALUE = _struct(("feature", STR, True), ("shap_value", F64, True), ("direction", STR, True))
EXPLANATION = StructType([StructField("fused_event_id", STR, False), StructField("explanation_text", STR), StructField("shap_values", ArrayType(SHAP_VALUE)), StructField("model_version", STR)])
TRACK = _struct(("alpha", F64, True), ("p2", F64, True), ("p3", F64, True), ("p4", F64, True))

SCHEMA_VERSION = "1.0"
STREAM_VERSIONS = {"alice_event": SCHEMA_VERSION, "sensor_event": SCHEMA_VERSION, "fused_event": SCHEMA_VERSION}
SENSOR_TYPES = ("RADAR", "LIDAR", "TELEMETRY")
PHYSICS_REQUIRED = tuple(f.name for f in PHYSICS_EVENT)
SENSOR_REQUIRED = ("event_id", "sensor_id", "sensor_type", "timestamp_ms", "schema_version")
#: Fields that a sensor type must fill.
TYPE_REQUIRED = {
    "RADAR": ("target_id", "range_m", "bearing_deg", "elevation_deg", "velocity_ms", "signal_strength_db"),
    "LIDAR": ("scan_id", "point_count", "centroid_x_m", "centroid_y_m", "centroid_z_m", "max_range_m", "avg_intensity", "min_intensity"),
    "TELEMETRY": ("device_id", "parameter_name", "value", "unit", "sequence_number"),
}
