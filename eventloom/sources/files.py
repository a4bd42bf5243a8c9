"""Sources: tolerant files, streams of files or topics, and the driver's tables as event streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from eventloom.functions.scalars import event_ms
from eventloom.storage import path_exists


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ms (floored), ts, user_id, event_type, value, props."""
    raw = table(spark, sf_dir, "events")
    return raw.select("event_id", event_ms(F.col("ts")).alias("ms"), F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "props")


def ndjson(spark: SparkSession, path: str, schema: StructType, corrupt: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(records, malformed lines): blank lines are no lines; a malformed one is kept as text and never stops the read."""
    wide = StructType([*schema.fields, StructField(corrupt, StringType())])
    parsed = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}).alias("r"), "value")
    return parsed.where(F.col(f"r.{corrupt}").isNull()).select("r.*").drop(corrupt), parsed.where(F.col(f"r.{corrupt}").isNotNull()).select("value")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1), value of every line that isn't blank; blank ones count in the numbers.

    Lines are numbered inside each split of a file and moved by what the splits before it hold, so a file is no task of its own.
    """
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
    inside = raw.withColumn("__n", F.row_number().over(Window.partitionBy("file", "__block").orderBy("__id")))
    counts = raw.groupBy("file", "__block").agg(F.count(F.lit(1)).alias("__here"))  # a row for each split
    before = counts.select("file", "__block", (F.sum("__here").over(Window.partitionBy("file").orderBy("__block")) - F.col("__here")).alias("__before"))
    return inside.join(before, ["file", "__block"]).where(F.trim("value") != "").select("file", (F.col("__n") + F.col("__before")).alias("line"), "value")


def ndjson_counts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """(total, invalid_json) of a file, in one pass."""
    wide = StructType([*schema.fields, StructField("_bad", StringType())])
    parsed = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})["_bad"].alias("bad"))
    return parsed.agg(F.count(F.lit(1)).alias("total"), F.count("bad").alias("invalid_json"))


def decode_json(payload: Column, schema: StructType) -> Column:
    return F.from_json(payload, schema)


def parquet_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A dataset, or no rows where there is none."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def kafka_stream(spark: SparkSession, topics: str, servers: str, most_offsets: int = 50_000, starting_ms: int | None = None) -> DataFrame:
    """A stream of topics from now on, or from a time; most_offsets 0 sets no bound for a batch. Needs the connector."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics).option("startingOffsets", "latest")
    if most_offsets:
        reader = reader.option("maxOffsetsPerTrigger", most_offsets)
    if starting_ms is not None:
        reader = reader.option("startingTimestamp", starting_ms).option("startingOffsetsByTimestampStrategy", "latest")
    return reader.load()


def file_stream(spark: SparkSession, path: str, schema: StructType, kind: str = "json", most_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(kind)
    return (reader.option("maxFilesPerTrigger", most_files) if most_files else reader).load(path)


def ids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("id")).where("id != ''").distinct()


def alignment_samples(spark: SparkSession, path: str, batches: tuple[int, int] | None = None, logged: tuple[str, str] | None = None) -> DataFrame:
    """Distances from alignment logs, in ranges of batches or of times; a torn line is skipped."""
    rows = spark.read.schema("batch_id long, logged_at timestamp, abs_dt_ms array<long>").option("mode", "PERMISSIVE").json(path).where("abs_dt_ms IS NOT NULL")
    if batches:
        rows = rows.where(F.col("batch_id").between(*batches))
    if logged:
        rows = rows.where(F.col("logged_at").between(F.lit(logged[0]).cast("timestamp"), F.lit(logged[1]).cast("timestamp")))
    return rows.select("batch_id", F.explode("abs_dt_ms").alias("abs_dt"))


def stream_kind(columns: list[str], first: dict | None = None) -> str:
    """The family of records by their columns: physics, a sensor type (of the first record), or unknown."""
    if {"run_number", "track_count"} <= set(columns):
        return "alice"
    if "sensor_type" in columns:
        return str((first or {}).get("sensor_type") or "unknown").lower()
    return "unknown"


def replay(df: DataFrame, ms: str, loops: int, gap_ms: int = 1000) -> DataFrame:
    """The rows loops times over; each time they start where the last one ended, and a gap. Adds loop and replay_ms."""
    span = df.agg((F.max(ms) - F.min(ms) + gap_ms).alias("__span"))
    turns = df.sparkSession.range(1, loops + 1).select(F.col("id").alias("loop"))
    return df.join(F.broadcast(turns.join(F.broadcast(span))), how="cross").withColumn("replay_ms", F.col(ms) + (F.col("loop") - 1) * F.col("__span")).drop("__span")
