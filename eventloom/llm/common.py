"""What the training-data operators share: lineage cuts, columns by place, rows that go, ASCII case."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from eventloom.storage import fresh_path

#: Row numbers (8 bytes, some 40 in a hash table) that are broadcast at most; more meet the rows in a shuffle.
BROADCAST_ROWS = 1_000_000
#: Rows of a narrow table (ids, digests, links) that one task writes, and tasks that write even the smallest.
ROWS_PER_TASK, LEAST_TASKS = 200_000, 12


def plain_names(n: int) -> list[str]:
    return [f"c{k}" for k in range(n)]


def place_of(df: DataFrame, name: str) -> int:
    """Where a column stands: by its very name, else by one that differs in case only."""
    names = df.columns
    return names.index(name) if name in names else [n.lower() for n in names].index(name.lower())


def chosen(df: DataFrame, **names: str) -> DataFrame:
    """The named columns under new names, whatever the others are called: chosen(docs, doc_id="id")."""
    plain = df.toDF(*plain_names(len(df.columns)))
    return plain.select(*[plain[f"c{place_of(df, name)}"].alias(new) for new, name in names.items()])


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """df in no more tasks than rows of a narrow table call for: a small one isn't written as hundreds of files."""
    return df.coalesce(max(LEAST_TASKS, -(-rows // ROWS_PER_TASK)))


def cut(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back, so that nothing before is computed again.

    A lost executor costs its own tasks only; the table outlives it. Columns may differ in case only. rows, for narrow
    tables whose rows are known to be no more, decides how many tasks write at most.
    """
    df = df if rows is None else few_tasks(df, rows)
    plain = df.toDF(*plain_names(len(df.columns)))
    path = fresh_path(df.sparkSession, name)
    plain.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(plain.schema).parquet(path).toDF(*df.columns)


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """rows whose key is not in gone (one column, key, a table that is cheap to read), which is broadcast only if it is small."""
    few = gone.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(gone) if few else gone, key, "left_anti")


def running_sums(lengths: Column) -> Column:
    """Sums of an array of ints up to each place, by blocks of about the root of its size: n^1.5 steps instead of n^2."""
    none = F.array().cast("array<int>")
    grow = lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out"))
    summed = lambda a: F.aggregate(a, F.struct(F.lit(0).alias("at"), none.alias("out")), grow, lambda acc: acc["out"])
    wide = F.ceil(F.sqrt(F.size(lengths))).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), wide - 1), lambda k: summed(F.slice(lengths, k * wide + 1, wide)))
    ends = summed(F.transform(blocks, lambda s: F.coalesce(F.get(s, F.size(s) - 1), F.lit(0))))
    return F.flatten(F.zip_with(blocks, F.concat(F.array(F.lit(0)), ends), lambda s, before: F.transform(F.coalesce(s, none), lambda x: x + before)))


def ascii_lower(col: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(col, string.ascii_uppercase, string.ascii_lowercase)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(df: DataFrame, run, *more: StructField) -> DataFrame:
    """mapInArrow over whole rows, whatever their columns are called; run gets them by place and may add columns at the end."""
    fields = [*df.schema.fields, *more]
    plain = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate(fields)])
    return df.toDF(*plain.names[: len(df.columns)]).mapInArrow(run, plain).toDF(*[f.name for f in fields])
