"""Running sums and exact percentiles over ordered rows of a group, without any group in one task.

All groups' rows go through one order that is cut into ranges (ordered.py), of a million rows at most on average. Sums run
inside each range, on from what the ranges before it add up to for the group, which comes in front of the range as a row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.storage import stored

from .ordered import placed


def _unused(df: DataFrame, name: str) -> str:
    """name, or one like it that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def _running(df: DataFrame, by: list[str], order: str, values: dict[str, str], fold, last: int, least: int = 1, total: str | None = None) -> DataFrame:
    """fold over a group's rows up to the last-th row from each one; with total, the first value's over the whole group as well."""
    rows, ranges = placed(df, [*by, order], least=least)
    if ranges == 1:  # so few rows, over all groups, that one task could hold them
        own = Window.partitionBy(*by)
        inside = own.orderBy(F.asc_nulls_first(order)).rowsBetween(Window.unboundedPreceding, last)
        made = {name: fold(c).over(inside) for name, c in values.items()} | ({total: fold(next(iter(values.values()))).over(own)} if total else {})
        return df.select(*[c for c in df.columns if c not in made], *[c.alias(n) for n, c in made.items()])
    names, place, whole = [_unused(df, f"__v{k}") for k in range(len(values))], _unused(df, "__place"), _unused(df, "__all")
    own = rows.groupBy("__range", *by).agg(*[fold(c).alias(n) for n, c in zip(names, values.values(), strict=True)])
    # A row for each range, and one more for each group.
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    heard = own.select("__range", *by, F.lit(0).alias(place), *[fold(n).over(before).alias(n) for n in names], fold(names[0]).over(Window.partitionBy(*by)).alias(whole))
    both = rows.select("*", F.lit(1).alias(place), *[F.col(c).alias(n) for n, c in zip(names, values.values(), strict=True)]).unionByName(heard, allowMissingColumns=True)
    inside = Window.partitionBy("__range", *by).orderBy(place, F.asc_nulls_first(order)).rowsBetween(Window.unboundedPreceding, last)
    made = {name: fold(n).over(inside) for name, n in zip(values, names, strict=True)} | ({total: F.first(whole).over(inside)} if total else {})
    return both.withColumns(made).where(F.col(place) == 1).select(*[c for c in df.columns if c not in made], *made)


def running_sum(df: DataFrame, by: list[str], order: str, values: dict[str, str], ranges: int = 1) -> DataFrame:
    """Adds, for each (name, column) of values, the sum of the column over the group's rows up to and with each row.

    order is a number; rows that share one take an order of their own. Null comes first, NaN last; null values add nothing.
    ranges is how many ranges even a small table is cut into.
    """
    made = _running(df, by, order, values, F.sum, Window.currentRow, ranges)
    return made.withColumns({name: F.coalesce(name, F.lit(0)) for name in values})


def running_max_before(df: DataFrame, by: list[str], order: str, values: dict[str, str], ranges: int = 1) -> DataFrame:
    """The same with the largest value of the rows before each row; null where there is none."""
    return _running(df, by, order, values, F.max, -1, ranges)


def _ranked_counts(df: DataFrame, by: list[str], value: str, ranges: int) -> DataFrame:
    """by, __v (distinct values), __upto (rows up to and with it), __total (rows of the group). Values are counted once and stored."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    return _running(stored(counts, "counts"), by, "__v", {"__upto": "__n"}, F.sum, Window.currentRow, ranges, "__total")


def _at(rank: Column) -> Column:
    """The value at a rank (from 0): the least one up to which more rows than that lie."""
    return F.min(F.when(F.col("__upto") > rank, F.col("__v")))


def nearest_ranks(df: DataFrame, by: list[str], value: str, ps: dict[str, float], ranges: int = 1) -> DataFrame:
    """by, and for each (name, p) the value (double) at rank round-half-even(p * (n - 1)); nulls don't count, groups may be of any size."""
    ranked = _ranked_counts(df, by, value, ranges)
    return ranked.groupBy(*by).agg(*[_at(F.bround(F.lit(p) * (F.col("__total") - 1))).alias(name) for name, p in ps.items()])


def inclusive_ranks(df: DataFrame, by: list[str], value: str, ps: dict[str, str], ranges: int = 1) -> DataFrame:
    """by, and for each (name, p as a decimal text) the value (double) at rank ceil(p * rows), from 1; nulls count as the last rows."""
    ranked, total = _ranked_counts(df, by, value, ranges), df.groupBy(*[F.col(c).alias(f"__by{k}") for k, c in enumerate(by)]).agg(F.count(F.lit(1)).alias("__rows"))
    same = [F.col(c).eqNullSafe(F.col(f"__by{k}")) for k, c in enumerate(by)]
    joined = ranked.join(total, same) if by else ranked.crossJoin(total)
    return joined.groupBy(*by).agg(*[_at(F.ceil(F.lit(Decimal(p)) * F.col("__rows")) - 1).alias(name) for name, p in ps.items()])


def percentiles(df: DataFrame, by: list[str], value: str, ps: dict[str, float], ranges: int = 1) -> DataFrame:
    """by, and for each (name, p) the exact percentile with interpolation, from counts of distinct values; nulls don't count.

    Rows meet their group only as counts with map-side combining, so a group may be of any size. Groups without a value
    have no row.
    """
    ranked, picked = _ranked_counts(df, by, value, ranges), []
    for name, p in ps.items():
        place = F.lit(p) * (F.col("__total") - 1)
        picked += [_at(F.floor(place)).alias(f"__lo_{name}"), _at(F.ceil(place)).alias(f"__hi_{name}"), F.max(place - F.floor(place)).alias(f"__share_{name}")]
    found = ranked.groupBy(*by).agg(*picked)
    between = lambda n: (F.col(f"__lo_{n}") + (F.col(f"__hi_{n}") - F.col(f"__lo_{n}")) * F.col(f"__share_{n}")).alias(n)
    return found.select(*by, *[between(n) for n in ps])
