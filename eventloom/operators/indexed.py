"""Idempotent inserts that don't read all ids: rows lie by a hash of the id, and a Bloom filter beside them rules groups out.

An id belongs to a group and to one filter in it; a filter is a bitmap of 32,768 bits, built and merged by Spark's bitmap
aggregates. Ids whose bits aren't all set are new. Only the groups of the others are opened, by their id column, for
an exact look. A table that outgrows the ids it was laid out for opens more groups; its results stay exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.storage import path_exists, stored

from .sinks import insert_ignore

#: Bits of a filter (as Spark's bitmaps have), bits that an id sets in it, and ids for which a filter is laid out.
BITS, HASHES, IDS_PER_FILTER = 32_768, 8, 1_000


@dataclass(frozen=True)
class Layout:
    #: Groups of rows (folders that are opened or not), and filters of each group. Both stay as the table began.
    groups: int = 256
    filters: int = 64

    @staticmethod
    def for_ids(ids: int, groups: int | None = None) -> Layout:
        """For so many ids: groups of some 20,000 of them, 16 to 4,096, so that a batch doesn't end in very small files."""
        groups = groups or max(16, min(4096, ids // 20_000))
        return Layout(groups, max(1, -(-ids // (groups * IDS_PER_FILTER))))


def placed_ids(df: DataFrame, key: str, layout: Layout) -> DataFrame:
    """Adds __group, __filter and __bits (positions in the filter) of each id."""
    h = lambda seed: F.xxhash64(F.lit(seed), F.col(key))
    return df.withColumns({
        "__group": F.pmod(h(0), F.lit(layout.groups)).cast("int"), "__filter": F.pmod(h(1), F.lit(layout.filters)).cast("int"),
        "__bits": F.array(*[F.pmod(h(2 + k), F.lit(BITS)) for k in range(HASHES)]),
    })


def filters_of(placed: DataFrame) -> DataFrame:
    """(group, filter, bitmap) of placed ids, combined before the shuffle."""
    bits = placed.select(F.col("__group").alias("group"), F.col("__filter").alias("filter"), F.explode("__bits").alias("bit"))
    return bits.groupBy("group", "filter").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.expr("0") != byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), F.pmod(bit, F.lit(8)).cast("int") + 1))


@dataclass
class Looked:
    #: Rows of the batch whose id is new, and the groups that had to be opened for that.
    fresh: DataFrame
    opened: list[int]


def _parts(spark: SparkSession, path: str, batch_no: int | None) -> DataFrame | None:
    """A partitioned table without the folder that this batch has written before; None where there is no other."""
    if not path_exists(spark, path):
        return None
    found = spark.read.option("basePath", path).parquet(path)
    return found if batch_no is None else found.where(F.col("batch") != batch_no)


def new_rows(batch: DataFrame, path: str, key: str, layout: Layout, batch_no: int | None = None) -> Looked:
    """Rows of batch (one for each id; null ids all) that the table at path doesn't hold."""
    spark, once = batch.sparkSession, insert_ignore(None, batch, [key])
    filters, rows = _parts(spark, f"{path}/filters", batch_no), _parts(spark, f"{path}/rows", batch_no)
    if filters is None or rows is None:
        return Looked(once, [])
    ids = placed_ids(once.where(F.col(key).isNotNull()).select(key), key, layout)
    merged = filters.groupBy(F.col("group").alias("__group"), F.col("filter").alias("__filter")).agg(F.bitmap_or_agg("bitmap").alias("__bitmap"))
    maybe = ids.join(merged, ["__group", "__filter"]).where(F.forall("__bits", lambda b: _is_set(F.col("__bitmap"), b)))
    maybe = stored(maybe.select(key, "__group"), "maybe")
    opened = sorted(r[0] for r in maybe.select("__group").distinct().collect())  # numbers of groups, of which a table has few
    if not opened:
        return Looked(once, [])
    there = rows.where(F.col("group").isin(opened)).select(key)
    known = stored(maybe.select(key).join(there, key, "left_semi"), "known")
    return Looked(once.join(known, key, "left_anti").select(*batch.columns), opened)


def append_indexed(batch: DataFrame, path: str, key: str, batch_no: int, layout: Layout) -> Looked:
    """Appends what is new, in a folder of the batch's own for rows and filters; a batch that is tried again writes over both.

    Filters are written first: a batch that fails between the two leaves ids in them that are looked for in vain, never rows
    that filters don't know.
    """
    looked = new_rows(batch, path, key, layout, batch_no)
    fresh = stored(looked.fresh, "fresh")
    placed = placed_ids(fresh.where(F.col(key).isNotNull()), key, layout)
    filters_of(placed).withColumn("batch", F.lit(batch_no)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{path}/filters")
    grouped = placed_ids(fresh, key, layout).withColumns({"batch": F.lit(batch_no), "group": F.coalesce("__group", F.lit(0))}).drop("__group", "__filter", "__bits")
    # A task writes whole groups: a file for each group of the batch.
    grouped.repartition("group").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "group").parquet(f"{path}/rows")
    return Looked(fresh, looked.opened)


def indexed_rows(spark: SparkSession, path: str, batch_no: int | None = None) -> DataFrame:
    """The table, or what one batch has put into it."""
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return (rows if batch_no is None else rows.where(F.col("batch") == batch_no)).drop("batch", "group")


def compact_filters(spark: SparkSession, path: str) -> None:
    """Puts one filter in place of those of all batches, under the number of the last one; rows stay where they are."""
    filters = spark.read.parquet(f"{path}/filters")
    last = filters.agg(F.max("batch")).first()[0]
    merged = stored(filters.groupBy("group", "filter").agg(F.bitmap_or_agg("bitmap").alias("bitmap")).withColumn("batch", F.lit(last)), "filters")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("batch").parquet(f"{path}/filters")
