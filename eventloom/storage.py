"""The folder that driver and executors share, for tables between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: str | None = None
_marked: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the cluster sets it; a folder of this machine only where that is unset and the session is local."""
    global _own_dir
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder that the driver and all executors share")
    if _own_dir is None:
        _own_dir = "file://" + tempfile.mkdtemp(prefix="eventloom-")
    spark.sparkContext.setCheckpointDir(_own_dir)
    return _own_dir


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the application's folder, which goes when the driver ends."""
    folder = f"{shared_dir(spark)}/eventloom/{spark.sparkContext.applicationId}"
    if folder not in _marked:
        files, target = _file_system(spark, folder)
        files.mkdirs(target)
        files.deleteOnExit(target)
        _marked.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table that no plan reads any more."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any store that Spark reads is there."""
    files, target = _file_system(spark, path)
    return files.exists(target)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
