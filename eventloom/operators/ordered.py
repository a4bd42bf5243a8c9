"""Passes over ordered rows of keys of any size: no key, and no burst of one time, is a task of its own.

All rows are put into ranges of one order, the keys first, then what orders a key's rows. Bounds come from a sample that
is gathered once, so a range is the same whenever it is computed again; they decide how even the work is, never
the result. Each range hears of what lies before it (or after it) in rows that are put in front (or at the end): one
for each key that goes on from an earlier range. A row is shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

#: Rows of a range, ranges at least and at most (their bounds are part of the plan), and sampled rows for each range.
ROWS_PER_RANGE, LEAST_RANGES, MOST_RANGES, SAMPLED = 1_000_000, 64, 16_384, 32
#: Rows of a task that sorts whole ranges, where they go to tasks by number; small ranges share one.
ROWS_PER_TASK = 500_000


def _sample(df: DataFrame, columns: list[str], most: int) -> tuple[list[str], int]:
    """So many rows at most, drawn evenly, in order and as JSON; and how many rows there are. One pass, some thousand short rows."""
    seen = Observation()
    drawn = df.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows")).withColumn("__draw", F.rand(1)).orderBy("__draw").limit(most)
    rows = drawn.sortWithinPartitions(*columns).select(F.to_json(F.struct(*columns))).collect()  # a limit leaves one partition
    return [r[0] for r in rows], seen.get["rows"]


def placed(df: DataFrame, columns: list[str], like: DataFrame | None = None, least: int | None = None) -> tuple[DataFrame, int]:
    """df with __range, the range of the order of the columns (nulls first) that a row is in, and the number of ranges.

    df, or a cheaper table like it, is read once more for that, by these columns only (twice, if it has very many rows).
    least is how many ranges even a small table is cut into.
    """
    return _placed(df, columns, like, least)[:2]


def _placed(df: DataFrame, columns: list[str], like: DataFrame | None = None, least: int | None = None) -> tuple[DataFrame, int, int]:
    """placed, and how many rows like has."""
    like, least = df if like is None else like, least or LEAST_RANGES
    sample, rows = _sample(like, columns, SAMPLED * least)
    ranges = max(least, min(MOST_RANGES, -(-rows // ROWS_PER_RANGE)))
    if ranges > least and rows > len(sample):
        sample, _ = _sample(like, columns, SAMPLED * ranges)
    picked = list(dict.fromkeys(sample[len(sample) * k // ranges] for k in range(1, ranges))) if sample else []
    if not picked:
        return df.withColumn("__range", F.lit(0)), 1, rows
    bounds = F.from_json(F.lit(f"[{','.join(picked)}]"), ArrayType(StructType([like.schema[c] for c in columns])))
    own, steps = F.struct(*columns), [1 << k for k in reversed(range(len(picked).bit_length()))]
    # How many bounds are at or below the row, by binary search; past the end there is none.
    at = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda i, s: i + F.when(F.get(bounds, i + s - 1) <= own, s).otherwise(0))
    return df.withColumn("__range", at), len(picked) + 1, rows


def _same_type(df: DataFrame, names: dict[str, Column]) -> list[Column]:
    """All columns of df, null but for the named ones."""
    return [names[f.name].alias(f.name) if f.name in names else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]


def _carried(rows: DataFrame, by: list[str], aggregated: Column, over: Column) -> DataFrame:
    """by, __range, __carry: over (an expression of __own, in order of ranges) of what aggregated makes of each key's rows in each range."""
    own = rows.groupBy("__range", *by).agg(aggregated.alias("__own"))
    # A row for each range, and one more for each key.
    return own.select("__range", *by, over.alias("__carry")).where("__carry IS NOT NULL")


def lagged(df: DataFrame, by: list[str], order: list[str], values: dict[str, str]) -> DataFrame:
    """Adds, for each (name, column) of values, the column's value in the row before, by the order within a key; null in a key's first row.

    Nulls come first in the order; a null key is a key. Rows that are equal in all of the order come in any order. An empty
    table stays empty.
    """
    rows, _ = placed(df, [*by, *order])
    names = [f"__v{k}" for k in range(len(values))]
    rows = rows.withColumns(dict(zip(names, (F.col(c) for c in values.values()), strict=True)))
    last = F.max_by(F.struct(*names), F.struct(*order))
    carry = _carried(rows, by, last, F.lag("__own").over(Window.partitionBy(*by).orderBy("__range")))
    front = carry.select(*_same_type(rows, {"__range": F.col("__range")} | {c: F.col(c) for c in by} | {n: F.col(f"__carry.{n}") for n in names}), F.lit(True).alias("__front"))
    both = rows.withColumn("__front", F.lit(False)).unionByName(front)
    w = Window.partitionBy("__range", *by).orderBy(F.desc("__front"), *order)
    out = both.withColumns({name: F.lag(n).over(w) for name, n in zip(values, names, strict=True)}).where("NOT __front")
    return out.select(*[c for c in df.columns if c not in values], *values)


def numbered(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Adds each row's number, from 1, in the order within its key; rows that are equal in all of the order get theirs in any order."""
    rows, _ = placed(df, [*by, *order])
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    carry = _carried(rows, by, F.count(F.lit(1)), F.sum("__own").over(before))
    front = carry.select(*_same_type(rows, {"__range": F.col("__range")} | {c: F.col(c) for c in by}), F.lit(True).alias("__front"), F.col("__carry").alias("__n"))
    both = rows.withColumns({"__front": F.lit(False), "__n": F.lit(1).cast("long")}).unionByName(front)
    w = Window.partitionBy("__range", *by).orderBy(F.desc("__front"), *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn("__n", F.sum("__n").over(w)).where("NOT __front").select(*[c for c in df.columns if c != name], F.col("__n").alias(name))


def neighbours(df: DataFrame, order: list[str], mark: str, before: str, after: str, like: DataFrame | None = None) -> DataFrame:
    """Adds the last value of mark that isn't null up to each row, and the first one after it, in the order of all rows.

    order must tell any two rows with a mark apart; mark is of any type. What a range hears of the others is a row from either side.
    """
    rows, ranges, count = _placed(df, order, like)
    own = rows.where(F.col(mark).isNotNull()).groupBy("__range").agg(F.max_by(mark, F.struct(*order)).alias("__last"), F.min_by(mark, F.struct(*order)).alias("__first"))
    every = df.sparkSession.range(ranges).select(F.col("id").cast("int").alias("__range")).join(F.broadcast(own), "__range", "left")  # a row for each range
    # What follows is what comes before in the other direction: a frame that ends with the last row is summed up anew for each row.
    up, down = (Window.orderBy(c).rowsBetween(Window.unboundedPreceding, -1) for c in (F.asc("__range"), F.desc("__range")))
    heard = every.select("__range", F.last("__last", True).over(up).alias("__l"), F.last("__first", True).over(down).alias("__f"))
    ends = heard.select("__range", F.explode(F.array(F.struct(F.lit(0).alias("place"), F.col("__l").alias("m")), F.struct(F.lit(2).alias("place"), F.col("__f").alias("m")))).alias("e")).where("e.m IS NOT NULL")
    both = rows.withColumn("__place", F.lit(1)).unionByName(ends.select(*_same_type(rows, {"__range": F.col("__range"), mark: F.col("e.m")}), F.col("e.place").alias("__place")))
    # Ranges go to tasks by number: by hash, or in partitions as few as the session has, a task would hold the more ranges the larger the table.
    tasks, group = min(ranges, -(-count // ROWS_PER_TASK)), ["__range"]
    if tasks > 1:
        both, group = both.withColumn("__task", F.floor(F.col("__range") * tasks / ranges).cast("int")), ["__task", "__range"]
        both = both.repartitionById(tasks, "__task")
    w, back = Window.partitionBy(*group).orderBy("__place", *order), Window.partitionBy(*group).orderBy(F.desc("__place"), *[F.desc(c) for c in order])
    last = F.last(mark, True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first = F.last(mark, True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    return both.withColumns({before: last, after: first}).where("__place = 1").select(*df.columns, before, after)
