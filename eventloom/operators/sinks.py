"""Writers and mutations as table rewrites: idempotent inserts, promotion, write-backs, exports."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.scalars import quality_score, quality_status
from eventloom.storage import path_exists


def with_audit(df: DataFrame, now: Column, batch_id: str | None = None, sensor: bool = True) -> DataFrame:
    """Audit columns of staging, and for sensor rows the labels that scoring fills in."""
    out = df.withColumns({"load_timestamp": now, "batch_id": F.lit(batch_id or str(uuid.uuid4())), "load_status": F.lit("validated")})
    return out.withColumns({"label": F.lit(0), "anomaly_type": F.lit(None).cast("string")}) if sensor else out


def insert_ignore(target: DataFrame | None, batch: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Rows of batch whose key is neither in target nor earlier in batch; null keys never conflict."""
    keyed = batch.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    if order:
        cols = [c for c in batch.columns if c not in keys]
        keyed = keyed.groupBy(*keys).agg(F.min_by(F.struct(*cols), order).alias("__row")).select(*keys, "__row.*").select(*batch.columns)
    else:
        keyed = keyed.dropDuplicates(keys)
    once = keyed.unionByName(batch.where(" OR ".join(f"{k} IS NULL" for k in keys)))
    return once if target is None else once.join(target.select(*keys), keys, "left_anti").select(*batch.columns)


def append_ignore(batch: DataFrame, path: str, keys: list[str], batch_no: int | None = None) -> None:
    """Appends what is new to a table of files. With batch_no the batch has a folder of its own, written over on a retry.

    Where the time is part of the key, only the table's rows between the batch's first and last time are read.
    """
    spark = batch.sparkSession
    target = spark.read.schema(batch.schema).option("recursiveFileLookup", "true").parquet(path) if path_exists(spark, path) else None
    if target is not None and "timestamp_ms" in keys:
        low, high = batch.agg(F.min("timestamp_ms"), F.max("timestamp_ms")).first()
        target = target.where(F.col("timestamp_ms").between(low, high)) if low is not None else target.limit(0)
    if batch_no is None:
        insert_ignore(target, batch, keys).write.mode("append").parquet(path)
        return
    own = f"{path}/batch={batch_no}"
    if target is not None:
        target = target.where(~F.contains(F.col("_metadata.file_path"), F.lit(f"/batch={batch_no}/")))
    insert_ignore(target, batch, keys).write.mode("overwrite").parquet(own)


def fused_rows(matches: DataFrame, window_ms: int, now_ms: Column, loss_pct: Column | float = 0.0) -> DataFrame:
    """The record of a match: ids, time, type, window, loss and latency; its own id is new each time and never compared."""
    return matches.select(
        F.expr("uuid()").alias("fused_event_id"), F.col("aid").cast("string").alias("alice_event_id"), F.col("sid").cast("string").alias("sensor_event_id"), F.col("a_ms").alias("timestamp_ms"), "sensor_type",
        F.lit(window_ms).alias("fusion_window_ms"), F.lit(loss_pct).cast("float").alias("data_loss_pct") if isinstance(loss_pct, float) else loss_pct.cast("float").alias("data_loss_pct"),
        (now_ms - F.col("a_ms")).cast("float").alias("latency_ms"), F.lit("1.0").alias("schema_version"),
    )


def heartbeats(batch: DataFrame, now: Column, loss: str = "data_loss_pct", latency: str = "latency_ms") -> DataFrame:
    """Two rows, one for each family, from a batch's mean loss and latency; none from an empty batch."""
    means = batch.agg(F.count(F.lit(1)).alias("n"), F.avg(loss).alias("data_loss"), F.avg(latency).alias("latency")).where("n > 0")
    score = quality_score(F.col("data_loss"), F.col("latency"))
    return means.select(now.alias("time"), F.explode(F.array(F.lit("alice"), F.lit("sensor"))).alias("source_type"), score.alias("quality_score"), F.lit(1.0).alias("contribution_weight"), "data_loss", "latency").withColumn("status", quality_status(F.col("quality_score")))


def promote(staging: DataFrame, ok: Column, status: str = "load_status", strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows promoted, staging afterwards).

    The status flips for every validated row if any row was fit, also for rows that weren't; with strict only fit rows flip.
    """
    validated = F.col(status) == "validated"
    fit = staging.where(validated & ok)
    if strict:
        return fit, staging.withColumn(status, F.when(validated & ok, "promoted").otherwise(F.col(status)))
    any_fit = fit.agg((F.count(F.lit(1)) > 0).alias("__any"))
    after = staging.crossJoin(F.broadcast(any_fit)).withColumn(status, F.when(F.col("__any") & validated, "promoted").otherwise(F.col(status))).drop("__any")
    return fit, after


def write_back(table: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The table with columns replaced where updates has the key; a null in updates leaves the old value."""
    fresh = updates.select(*keys, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = table.join(fresh, keys, "left")
    return joined.select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in table.columns])


def patch_status(alerts: DataFrame, fused_event_id: str, status: str, now_ms: int) -> DataFrame:
    hit = F.col("fused_event_id") == fused_event_id
    return alerts.withColumns({"status": F.when(hit, F.lit(status)).otherwise(F.col("status")), "status_updated_at": F.when(hit, F.lit(now_ms)).otherwise(F.col("status_updated_at"))})


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> int:
    """Overwrites a dataset and returns its rows, counted while they are written."""
    from pyspark.sql import Observation

    seen = Observation("written")
    writer = df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    return seen.get["n"]


def in_order(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns by name and order; what df lacks is null."""
    return df.select(*[F.col(n) if n in df.columns else F.lit(None).alias(n) for n in names])


def write_kafka(df: DataFrame, topic: str, servers: str, key: str = "event_id", ms: str | None = None) -> None:
    """JSON records keyed by id, with a time of their own where one is given; needs the connector."""
    cols = [F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"), F.lit(topic).alias("topic")]
    if ms:
        cols.append(F.timestamp_millis(F.col(ms)).alias("timestamp"))
    df.select(*cols).write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_csv(df: DataFrame, path: str) -> None:
    """CSV in which null is empty and an empty text is quoted."""
    df.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_ids(df: DataFrame, id_col: str, path: str) -> None:
    df.select(F.col(id_col).cast("string").alias("value")).orderBy("value").write.mode("overwrite").text(path)


def append_alignment_log(matches: DataFrame, batch_no: int, now: Column, path: str, dt: str = "abs_dt") -> None:
    """One JSON line for a batch with its distances; a batch is bounded by its trigger."""
    line = matches.agg(F.sort_array(F.collect_list(dt)).alias("abs_dt_ms")).select(F.lit(batch_no).alias("batch_id"), now.alias("logged_at"), "abs_dt_ms")
    line.write.mode("append").json(path)
