"""Whole jobs: lines of JSON into staging, batch scoring with its rollups and checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eventloom.sources.files import numbered_lines
from eventloom.storage import discard, fresh_path, path_exists, stored

from .detectors import StreamModel, apply_scores, score_batch
from .records import examples, field_counts, findings, is_json, quality_report, typed
from .rollups import summary_5min
from .sinks import append_ignore, with_audit
from .validation import staging_physics, staging_sensor


def ingest_ndjson(spark: SparkSession, path: str, target: str, schema: StructType, sensor: bool = False, now: Column | None = None, batch_id: str | None = None) -> dict[str, int]:
    """Lines of JSON under path into the staging table at target: how many were malformed, rejected, valid, inserted.

    Blank lines are no lines. A line is valid if it passes the staging checks; a value of another type counts as null. An
    event id that is in staging, or came before, is valid but not inserted again. The lines are parsed once.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    judged = typed(lines, "value", schema).withColumn("__reason", F.when(~is_json(), "invalid JSON").otherwise(staging_sensor() if sensor else staging_physics()))
    seen = Observation("lines")
    counted = judged.observe(seen, F.count_if(F.col("__reason") == "invalid JSON").alias("malformed"), F.count_if(F.col("__reason") != "invalid JSON").alias("rejected"), F.count_if(F.col("__reason").isNull()).alias("valid"))
    fit = stored(with_audit(counted.where("__reason IS NULL").select(*schema.names), now if now is not None else F.current_timestamp(), batch_id, sensor), "valid")
    rows = lambda: spark.read.schema(fit.schema).option("recursiveFileLookup", "true").parquet(target).count() if path_exists(spark, target) else 0
    before = rows()
    append_ignore(fit, target, ["event_id"])
    return {**{k: seen.get[k] for k in ("malformed", "rejected", "valid")}, "inserted": rows() - before}


def quality_of_files(spark: SparkSession, path: str, schema: StructType, sensor: bool = True, most: int = 20) -> dict[str, DataFrame]:
    """The report on lines of JSON under path: totals, counts by field, and the first examples with file and line."""
    lines = numbered_lines(spark, path)
    found = stored(findings(lines, "value", schema, sensor).drop("value"), "findings")
    place = F.struct("file", "line")
    return {"report": quality_report(found), "fields": field_counts(found), "examples": examples(found.withColumn("place", place), "place", most).select("line.file", "line.line", "check", "message")}


def refresh_rollups(fused: DataFrame, path: str) -> DataFrame:
    """Computes the whole 5-minute rollup anew, puts it in place of the one at path, and returns it."""
    spark = fused.sparkSession
    made = fresh_path(spark, "rollup")
    summary_5min(fused).write.parquet(made)
    fresh = spark.read.parquet(made)
    fresh.write.mode("overwrite").parquet(path)
    discard(spark, made)
    return spark.read.schema(fresh.schema).parquet(path)


def rollup_checks(fused: DataFrame, rollup: DataFrame) -> DataFrame:
    """One row: fused rows, scored ones, anomalies, events and anomaly share that the rollup has, and whether both agree on all events."""
    table = fused.agg(F.count(F.lit(1)).alias("fused_rows"), F.count("anomaly_label").alias("scored_rows"), F.count_if(F.col("anomaly_label") == 1).alias("anomalies"))
    rolled = rollup.agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("rolled_events"), F.count("anomaly_rate").alias("scored_buckets"))
    return table.crossJoin(F.broadcast(rolled)).withColumn("agree", F.col("fused_rows") == F.col("rolled_events"))  # two single rows


@dataclass
class Scored:
    #: Scores by fused row, counts by stream and by what kept rows from being scored.
    scores: DataFrame
    counts: DataFrame
    #: The table after the run and its rollup's checks; None on a dry run.
    fused: DataFrame | None = None
    checks: DataFrame | None = None


def run_batch_scoring(fused: DataFrame, staging: DataFrame, models: dict[str, StreamModel], stats: DataFrame, rollup_path: str | None = None, since_ms: int | None = None, dry_run: bool = False) -> Scored:
    """Scores fused rows since a time, writes scores back, computes the rollup anew and checks it; a dry run only scores.

    Rows before since_ms keep what they had, and rows that can't be assembled keep their nulls.
    """
    scores, counts = score_batch(fused, staging, models, stats, since_ms)
    scores = stored(scores, "scores")
    if dry_run:
        return Scored(scores, counts)
    after = stored(apply_scores(fused, scores.drop("reason")), "fused")
    rollup = refresh_rollups(after, rollup_path or fresh_path(fused.sparkSession, "summary"))
    return Scored(scores, counts, after, rollup_checks(after, rollup))
