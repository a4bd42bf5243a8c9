"""Connected components by alternating large-star and small-star steps; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.storage import discard, fresh_path

from .common import few_tasks


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (a, b): each node links its larger (large) or its smaller neighbours to the least around it."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    # The least neighbour is found with map-side combining, so a node with very many links is no hot key there.
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a")
    if large:
        made = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        made = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return made.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b: any ordered type): component is the least node reachable.

    Self links and repeated links count once; links with a null end are left out; no links give no rows. Each round
    is written to the shared folder in place of the one before; it ends when a round changes nothing, after a number of
    rounds that grows with the logarithm of the size of the largest component.
    """
    spark = edges.sparkSession

    def written(df: DataFrame, rows: int | None = None) -> tuple[DataFrame, str]:
        path = fresh_path(spark, "links")
        df = df if rows is None else few_tasks(df, rows)
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    now, path = written(edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = (now.count(),)
    while True:
        # A round leaves as many links as there are nodes that aren't the least of theirs: no more than twice the links before.
        following, its_path = written(_stars(_stars(now, True), False), 2 * state[0])
        discard(spark, path)
        now, path = following, its_path
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            least = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(least)
        state = seen
