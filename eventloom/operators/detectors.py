"""Two detectors for each stream, trained, kept and applied: isolation forest and robust z, either one alarms."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import scoring as s
from eventloom.operators.forest import Forest, fit_forest, score_forest
from eventloom.operators.ordered import numbered
from eventloom.operators.rollups import median_mad, value_stats
from eventloom.operators.sinks import write_back
from eventloom.operators.windows import ecdf_risk, rules_for, sequence_rules
from eventloom.storage import stored

VERSION = "combined-2"
FEATURES = {"radar": s.RADAR, "lidar": s.LIDAR, "telemetry": s.TELEMETRY}


def featurize(df: DataFrame, stream: str, stats: DataFrame | None = None) -> DataFrame:
    """Adds the stream's feature columns under f_<name>."""
    if stream == "telemetry":
        return s.telemetry_features(df, stats).withColumnRenamed("value_z", "f_value_z")
    made = s.radar_features() if stream == "radar" else s.lidar_features()
    return df.withColumns({f"f_{name}": c for name, c in zip(FEATURES[stream], made, strict=True)})


def load_corpus(df: DataFrame, stream: str, test_ids: DataFrame, stats: DataFrame | None = None, order: str = "n") -> DataFrame:
    """event_id, features, label, anomaly_type (normal where it is null or empty), is_test, arrival_no, and telemetry's rule in arrival order."""
    marked = df.join(test_ids.select(F.col("id").alias("event_id"), F.lit(True).alias("__t")), "event_id", "left")
    kind = F.when(F.coalesce("anomaly_type", F.lit("")) == "", "normal").otherwise(F.col("anomaly_type"))
    out = featurize(marked, stream, stats).withColumns({"is_test": F.coalesce("__t", F.lit(False)), "anomaly_type": kind, "arrival_no": F.col(order)})
    if stream == "telemetry":
        out = sequence_rules(out, "device_id", [order], "sequence_number", "timestamp_ms")
    keep = ["event_id", *[f"f_{f}" for f in FEATURES[stream]], "label", "anomaly_type", "is_test", "arrival_no", *(["rule"] if stream == "telemetry" else [])]
    return out.select(*keep)


@dataclass
class StreamModel:
    stream: str
    forest: Forest
    centre: dict[str, tuple[float, float]]
    reference: DataFrame

    def raw(self, df: DataFrame) -> DataFrame:
        """Adds forest_score, worst_z and worst_feature."""
        names = FEATURES[self.stream]
        columns = tuple(f"f_{f}" for f in names)
        scored = score_forest(df, self.forest, list(columns), "forest_score")
        out = s.robust_z(scored, columns, {f"f_{f}": (F.lit(m), F.lit(d)) for f, (m, d) in self.centre.items()})
        return out.withColumn("worst_feature", F.substring_index("worst_feature", "f_", -1)).drop("z")

    def score(self, df: DataFrame, rule: Column | None = None) -> DataFrame:
        """Adds risk of both detectors, anomaly_label, risk_score, confidence and reason."""
        out = self.raw(df)
        for name, column in (("forest", "forest_score"), ("z", "worst_z")):
            reference = self.reference.where(F.col("detector") == name).select(F.lit(self.stream).alias("__stream"), F.col("score").alias(column))
            out = ecdf_risk(out.withColumn("__stream", F.lit(self.stream)), reference, column, "__stream").withColumnRenamed("risk", f"risk_{name}").drop("__stream")
        hit = rule if rule is not None else F.lit(None).cast("string")
        decided = s.decide(s.combined_risk(F.col("risk_forest"), F.col("risk_z")), s.LINE_TWO, hit)
        return out.withColumns(decided | {"reason": s.alarm_reason(hit, F.col("risk_forest"), F.col("risk_z"), F.col("worst_feature"))})

    def save(self, path: str) -> None:
        spark = self.reference.sparkSession
        facts = json.dumps({"version": VERSION, "stream": self.stream, "centre": self.centre})
        spark.createDataFrame([(facts, self.forest.to_json())], "facts string, forest string").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
        self.reference.write.mode("overwrite").parquet(f"{path}/reference")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> StreamModel:
        row = spark.read.parquet(f"{path}/model").first()
        facts = json.loads(row.facts)
        if facts["version"] != VERSION:
            raise ValueError(f"model is {facts['version']}, code expects {VERSION}: train again")
        return cls(facts["stream"], Forest.from_json(row.forest), {k: tuple(v) for k, v in facts["centre"].items()}, spark.read.parquet(f"{path}/reference"))


def train_stream(corpus: DataFrame, stream: str) -> StreamModel:
    """Both detectors from training rows; normal ones give centres and reference scores."""
    train = corpus.where(~F.col("is_test"))
    normal, names = train.where("label = 0"), FEATURES[stream]
    # A row for each feature of each row, and of these a count for each value: no buffer holds all values of a feature.
    values = normal.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"f_{f}").cast("double").alias("value")) for f in names])).alias("r")).select("r.*")
    centre = {r.feature: (r.med, r.mad) for r in median_mad(values, "feature", "value").collect()}
    model = StreamModel(stream, fit_forest(train, [f"f_{f}" for f in names], "event_id"), centre, corpus.limit(0))
    raw = model.raw(normal)
    model.reference = stored(raw.select(F.explode(F.array(F.struct(F.lit("forest").alias("detector"), F.col("forest_score").alias("score")), F.struct(F.lit("z").alias("detector"), F.col("worst_z").alias("score")))).alias("r")).select("r.*"), "reference")
    return model


def score_batch(fused: DataFrame, staging: DataFrame, models: dict[str, StreamModel], stats: DataFrame, since_ms: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(scores by fused row, counts by stream and by what kept rows from being scored).

    Fused rows find their sensor row by id; telemetry rules are judged on the full stream; a row that can't be assembled has no score.
    """
    chosen = fused if since_ms is None else fused.where(F.col("timestamp_ms") >= since_ms)
    right = staging.select(F.col("event_id").alias("staging_event_id"), *[c for c in staging.columns if c not in ("event_id", "sensor_type", "timestamp_ms", "label", "anomaly_type", "schema_version")])
    joined = chosen.select("fused_event_id", "sensor_event_id", "sensor_type", "timestamp_ms").join(right, F.col("sensor_event_id") == F.col("staging_event_id"), "left")
    # A row for each parameter: a table of sensors' fixed vocabulary, as in telemetry_features.
    names = stats.select(F.col("parameter_name").alias("__name"), F.lit(True).alias("__known")).where("__name IS NOT NULL").distinct()
    named = joined.join(F.broadcast(names), F.col("parameter_name") == F.col("__name"), "left")
    judged = named.withColumn("problem", s.assembly_reason(known=F.coalesce("__known", F.lit(False)))).drop("__name", "__known")
    out = None
    for stream, model in models.items():
        rows = judged.where(F.col("problem").isNull() & (F.lower("sensor_type") == stream))
        if stream == "telemetry":
            rows = rules_for(rows, staging.where("sensor_type = 'TELEMETRY'"), "device_id", "sequence_number", "timestamp_ms")
        scored = model.score(featurize(rows, stream, stats), F.col("rule") if stream == "telemetry" else None).select("fused_event_id", "timestamp_ms", "anomaly_label", "risk_score", "confidence", "reason")
        out = scored if out is None else out.unionByName(scored)
    return out, judged.groupBy(F.lower("sensor_type").alias("stream"), "problem").agg(F.count(F.lit(1)).alias("n"))


def apply_scores(fused: DataFrame, scores: DataFrame) -> DataFrame:
    return write_back(fused, scores, ["fused_event_id", "timestamp_ms"], ["anomaly_label", "risk_score", "confidence"])


def parameter_stats(corpus: DataFrame) -> DataFrame:
    """Mean and deviation of each parameter over normal training rows (columns label, is_test, parameter_name, value)."""
    return value_stats(corpus, "parameter_name", "value", F.col("label") == 0, ~F.col("is_test"))


def arrival(df: DataFrame, order: str) -> DataFrame:
    """Adds each row's place in its stream; a stream of any size is split."""
    return numbered(df, ["sensor_type"], [order], "arrival_no")
