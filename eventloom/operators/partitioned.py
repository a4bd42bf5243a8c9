"""Changes to tables laid out in partitions that rewrite the touched ones only: write-backs, and rollups kept up to date.

New partitions are written in full beside the table (in a folder that readers don't see) before any old one goes, so a driver that
dies on the way leaves either the old state or all that is needed to finish: the next change finishes it first.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.scalars import time_bucket
from eventloom.storage import discard, fresh_path, path_exists

PENDING = "_pending"


def _children(spark: SparkSession, path: str) -> list[str]:
    if not path_exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().toString() for s in target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)]


def _finish(spark: SparkSession, path: str, pending: str, by: list[str]) -> None:
    made = spark.read.parquet(pending)
    # Files of the staged change are taken as they are, so a repeat writes the same rows over the same partitions.
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    discard(spark, pending)


def finish_pending(spark: SparkSession, path: str, by: list[str]) -> int:
    """Ends changes that a driver left halfway: whole ones are put in place, others thrown away. Returns how many were put in place."""
    done = 0
    for pending in _children(spark, f"{path}/{PENDING}"):
        if path_exists(spark, f"{pending}/_SUCCESS"):
            _finish(spark, path, pending, by)
            done += 1
        else:
            discard(spark, pending)
    return done


def replace_partitions(made: DataFrame, path: str, by: list[str], stop_before_commit: bool = False) -> None:
    """Puts the partitions that made has rows of in place of those at path; other partitions keep their files."""
    spark = made.sparkSession
    pending = f"{path}/{PENDING}/{uuid.uuid4().hex}"
    made.repartition(*by).write.parquet(pending)
    if not stop_before_commit:
        _finish(spark, path, pending, by)


def _touched(table: DataFrame, by: list[str], keys: DataFrame) -> DataFrame:
    """Rows of the partitions that keys names: a filter on literals, so that only their files are listed and read."""
    named = [r.asDict() for r in keys.select(*by).distinct().collect()]  # names of touched partitions
    if len(by) == 1:
        return table.where(F.col(by[0]).isin([n[by[0]] for n in named]))
    hit = F.lit(False)
    for n in named:
        one = F.lit(True)
        for c in by:
            one &= F.col(c) == F.lit(n[c])
        hit |= one
    return table.where(hit)


def write_back_partitions(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], columns: list[str], by: list[str], **how) -> None:
    """Replaces columns where updates (by, keys, columns) has the key; a null leaves the old value. Only partitions of updates are read and written.

    Updates without a matching row change nothing; of several updates of one key the result is one of them. A retry repeats safely.
    """
    finish_pending(spark, path, by)
    table = spark.read.option("basePath", path).parquet(path)
    once = updates.select(*by, *keys, *columns).dropDuplicates([*by, *keys])
    fresh = once.select(*by, *keys, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = _touched(table, by, updates).join(fresh, [*by, *keys], "left")
    made = joined.select(*[F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in table.columns])
    replace_partitions(made, path, by, **how)


# Rollups from mergeable states.
@dataclass(frozen=True)
class Rollup:
    """A five-minute rollup at path: states of each batch, a log of buckets that they make stale, and what was refreshed."""

    path: str
    ms: str = "timestamp_ms"
    kind: str = "sensor_type"
    loss: str = "data_loss_pct"
    latency: str = "latency_ms"
    label: str = "anomaly_label"
    width_ms: int = 300_000

    def add(self, df: DataFrame, batch_no: int) -> None:
        """Writes the states of a batch, late or not, and which days they make stale; a batch that is tried again writes over its own."""
        label = F.when(F.col(self.label).isin(0, 1), F.col(self.label))
        states = df.groupBy(time_bucket(F.col(self.ms), self.width_ms).alias("bucket"), F.col(self.kind).alias("sensor_type")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(self.loss).alias("loss"), F.count(self.loss).alias("loss_n"), F.sum(self.latency).alias("latency"), F.count(self.latency).alias("latency_n"),
            F.sum(label).alias("label"), F.count(label).alias("label_n"), F.kll_sketch_agg_double(F.col(self.latency).cast("double")).alias("sketch"),
        )
        dated = states.withColumns({"day": F.floor(F.col("bucket") / 86_400_000), "batch": F.lit(batch_no)})
        spark = df.sparkSession
        kept = fresh_path(spark, "states")
        dated.write.parquet(kept)
        made = spark.read.parquet(kept)
        # The log first: a day that is stale for nothing is refreshed in vain, a day that isn't in the log would stay stale.
        made.groupBy("day", "batch").agg(F.count_distinct("bucket").alias("buckets")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{self.path}/stale")
        made.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "day").parquet(f"{self.path}/states")

    def stale_days(self, spark: SparkSession) -> tuple[list[int], list[int]]:
        """Days that batches have touched since they were refreshed, and these batches."""
        if not path_exists(spark, f"{self.path}/stale"):
            return [], []
        log = spark.read.parquet(f"{self.path}/stale")
        if path_exists(spark, f"{self.path}/refreshed"):
            log = log.join(spark.read.parquet(f"{self.path}/refreshed").select("batch").distinct(), "batch", "left_anti")
        rows = log.groupBy("day").agg(F.collect_set("batch").alias("batches")).collect()  # a row for each stale day
        return sorted(r.day for r in rows), sorted({b for r in rows for b in r.batches})

    def refresh(self, spark: SparkSession, **how) -> list[int]:
        """Merges the states of stale days, and of no others, into new partitions of the rollup; returns these days.

        All states of such a day are merged anew rather than added to the last result, so a refresh that is done twice is done once.
        """
        finish_pending(spark, f"{self.path}/rollup", ["day"])
        days, batches = self.stale_days(spark)
        if not days:
            return []
        states = spark.read.option("basePath", f"{self.path}/states").parquet(f"{self.path}/states").where(F.col("day").isin(days))
        merged = states.groupBy("day", "bucket", "sensor_type").agg(
            F.sum("n").alias("event_count"), F.try_divide(F.sum("loss"), F.sum("loss_n")).alias("avg_data_loss"), F.try_divide(F.sum("latency"), F.sum("latency_n")).alias("avg_latency"),
            F.kll_merge_agg_double("sketch").alias("latency_sketch"), F.try_divide(F.sum("label"), F.sum("label_n")).alias("anomaly_rate"),
        )
        replace_partitions(merged, f"{self.path}/rollup", ["day"], **how)
        spark.createDataFrame([(b,) for b in batches], "batch int").coalesce(1).write.mode("append").parquet(f"{self.path}/refreshed")
        return days

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.option("basePath", f"{self.path}/rollup").parquet(f"{self.path}/rollup")
