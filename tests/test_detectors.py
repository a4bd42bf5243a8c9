"""Training, keeping and applying the detectors on generated streams."""

import pytest
from eventloom.operators import detectors as d
from eventloom.operators.rollups import confusion, roc_auc
from eventloom.sources.generators import generate
from eventloom.storage import stored
from pyspark.sql import Window
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def trained(spark):
    made, models = {}, {}
    for kind in ("RADAR", "LIDAR", "TELEMETRY"):
        rows = stored(generate(spark, kind, 4000), kind)
        test = rows.where("n % 5 = 0").select(F.col("event_id").alias("id"))
        stats = d.parameter_stats(rows.withColumn("is_test", F.col("n") % 5 == 0)) if kind == "TELEMETRY" else None
        corpus = stored(d.load_corpus(rows, kind.lower(), test, stats), "corpus")
        made[kind] = (rows, corpus, stats)
        models[kind.lower()] = d.train_stream(corpus, kind.lower())
    return made, models


@pytest.mark.parametrize("kind", ["RADAR", "LIDAR", "TELEMETRY"])
def test_detectors_separate(spark, trained, tmp_path, kind):
    made, models = trained
    corpus = made[kind][1]
    models[kind.lower()].save(f"file://{tmp_path}/m")
    model = d.StreamModel.load(spark, f"file://{tmp_path}/m")
    test = corpus.where("is_test")
    assert 700 < test.count() < 900
    scored = stored(model.score(test, F.col("rule") if kind == "TELEMETRY" else None), "scored")
    # A clock that stalls right after a gap of the counter still advances, by the gap: no rule or feature can tell.
    before = F.lag("anomaly_type").over(Window.orderBy("n"))
    hidden = made[kind][0].withColumn("before", before).where("anomaly_type = 'timestamp_stall' AND before = 'missing_reading'").select("event_id")
    assert hidden.count() < 10
    scored = scored.join(hidden, "event_id", "left_anti")
    auc = roc_auc(scored, "risk_score", F.col("label") == 1).first().auc
    rates = confusion(scored, F.col("label") == 1, F.col("anomaly_label") == 1).first()
    assert auc > 0.97 and rates.recall > 0.85 and rates.fpr < 0.05
    assert scored.where("(anomaly_label = 1) != (reason != '')").count() == 0


def test_batch_scoring(spark, trained):
    made, models = trained
    staging = made["RADAR"][0].unionByName(made["LIDAR"][0]).unionByName(made["TELEMETRY"][0])
    fused = staging.where("n < 50").select(F.concat(F.lit("f"), "event_id").alias("fused_event_id"), F.col("event_id").alias("sensor_event_id"), "sensor_type", "timestamp_ms")
    fused = fused.unionByName(spark.createDataFrame([("lost", "no such event", "RADAR", 1)], fused.schema)).withColumns({"anomaly_label": F.lit(None).cast("int"), "risk_score": F.lit(None).cast("double"), "confidence": F.lit(None).cast("double")})
    scores, counts = d.score_batch(fused, staging, models, made["TELEMETRY"][2])
    after = d.apply_scores(fused, scores)
    assert after.count() == 151 and after.where("risk_score IS NULL").select("fused_event_id").collect()[0][0] == "lost"
    assert {(r.stream, r.problem, r.n) for r in counts.collect()} == {("radar", None, 50), ("radar", "no staging row", 1), ("lidar", None, 50), ("telemetry", None, 50)}
