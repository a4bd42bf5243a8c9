"""Interval join and nearest match: the same expressions serve tables and streams; tables have a linear way as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import neighbours


def prepare_left(df: DataFrame, id_col: str, ms_col: str, window_ms: int, watermark: str | None = None) -> DataFrame:
    """(aid, a_ms, a_time, bucket): each row goes to the one or two buckets of twice the window that its interval touches."""
    out = df.select(F.col(id_col).alias("aid"), F.col(ms_col).alias("a_ms"), F.timestamp_millis(F.col(ms_col)).alias("a_time"))
    if watermark:
        out = out.withWatermark("a_time", watermark)
    width = 2 * window_ms
    low, high = F.floor((F.col("a_ms") - window_ms) / width), F.floor((F.col("a_ms") + window_ms) / width)
    return out.withColumn("bucket", F.explode(F.sequence(low, high)))


def prepare_right(df: DataFrame, id_col: str, ms_col: str, kind, window_ms: int, watermark: str | None = None) -> DataFrame:
    """(sid, s_ms, s_time, sensor_type, s_bucket): one bucket each; kind is a column or a constant."""
    label = F.lit(kind) if isinstance(kind, str) else kind
    out = df.select(F.col(id_col).alias("sid"), F.col(ms_col).alias("s_ms"), F.timestamp_millis(F.col(ms_col)).alias("s_time"), label.alias("sensor_type"))
    if watermark:
        out = out.withWatermark("s_time", watermark)
    return out.withColumn("s_bucket", F.floor(F.col("s_ms") / (2 * window_ms)))


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for one in frames[1:]:
        out = out.unionByName(one)
    return out


def interval_join(left: DataFrame, right: DataFrame, window_ms: int, how: str = "inner") -> DataFrame:
    """All pairs at most window_ms apart, ends included, each once: an equi-join on buckets, so that it shuffles by key.

    With left_outer each of a left row's buckets without a partner gives a row of nulls; nearest_or_none puts them together.
    """
    reach = F.expr(f"INTERVAL {window_ms} MILLISECONDS")
    near = (F.col("s_time") >= F.col("a_time") - reach) & (F.col("s_time") <= F.col("a_time") + reach)
    return left.join(right, (F.col("bucket") == F.col("s_bucket")) & near, how)


#: Right rows of a task of near_pairs: each of them may have very many partners.
RIGHTS_PER_TASK = 20_000


def near_pairs(left: DataFrame, right: DataFrame, window_ms: int) -> DataFrame:
    """interval_join of tables, (aid, a_ms) and (sid, s_ms, sensor_type): the same pairs, each once, in as many tasks as the rows call for.

    Buckets are half a window wide, so four of five rows that a left row is compared with are its partners, and times are compared as numbers.
    Within a task pairs come in order of bucket and times, so that a file of them is a fraction of their size: a left row comes in runs, its partners' times in order.
    """
    width = max(1, window_ms // 2)
    at = lambda ms: F.floor(ms / width)
    tasks = max(1, -(-right.count() // RIGHTS_PER_TASK))
    a = left.select("aid", "a_ms", F.explode(F.sequence(at(F.col("a_ms") - window_ms), at(F.col("a_ms") + window_ms))).alias("bucket"))
    s = right.select("sid", "s_ms", "sensor_type", at(F.col("s_ms")).alias("bucket")).where("bucket IS NOT NULL")
    # A sort below a join is dropped as without use; the order that a row number asks for is kept, and the join takes it over.
    ordered = lambda df, *order: df.repartition(tasks, "bucket").withColumn("__n", F.row_number().over(Window.partitionBy("bucket").orderBy(*order))).where("__n > 0").drop("__n")
    both = ordered(a, "a_ms", "aid").join(ordered(s, "s_ms", "sid").hint("merge"), "bucket")
    return both.where(F.col("s_ms").between(F.col("a_ms") - window_ms, F.col("a_ms") + window_ms)).drop("bucket")


def nearest_match(pairs: DataFrame) -> DataFrame:
    """For each left row the right row of least distance, then the earlier, then the smaller id; others are left out."""
    order = F.struct(F.abs(F.col("s_ms") - F.col("a_ms")).alias("abs_dt"), F.col("s_ms"), F.col("sid"), F.col("sensor_type"))
    best = pairs.groupBy("aid", "a_ms", "a_time").agg(F.min(order).alias("best"))
    return best.select("aid", "a_ms", F.col("best.sid").alias("sid"), F.col("best.s_ms").alias("s_ms"), F.col("best.sensor_type").alias("sensor_type"), F.col("best.abs_dt").alias("abs_dt"))


def nearest_or_none(pairs: DataFrame) -> DataFrame:
    """nearest_match of an outer join: left rows without a partner stay, with nulls."""
    order = F.struct(F.abs(F.col("s_ms") - F.col("a_ms")).alias("abs_dt"), F.col("s_ms"), F.col("sid"), F.col("sensor_type"))
    best = pairs.groupBy("aid", "a_ms", "a_time").agg(F.min(F.when(F.col("sid").isNotNull(), order)).alias("best"))
    return best.select("aid", "a_ms", "best.sid", "best.s_ms", "best.sensor_type", "best.abs_dt")


def fuse(left: DataFrame, rights: list[DataFrame], window_ms: int) -> DataFrame:
    return nearest_match(interval_join(left, union_all(rights), window_ms))


def nearest_in_order(left: DataFrame, right: DataFrame, window_ms: int) -> DataFrame:
    """nearest_match of tables without pairs: (aid, a_ms, sid, s_ms, sensor_type, abs_dt) from left (aid, a_ms) and right (sid, s_ms, sensor_type).

    Of right rows of one time the smallest id stands for all, so the nearest is the last row at or before a left row or the
    first one after it. Both sides go through one order of times, split into ranges even within one time, so the work is
    linear in their rows however wide the window and however dense a burst. Left rows that repeat are answered each;
    null times have no partner.
    """
    left, right = left.where("a_ms IS NOT NULL"), right.where("s_ms IS NOT NULL")
    one = right.groupBy("s_ms").agg(F.min(F.struct("sid", "sensor_type")).alias("m"))
    mark = F.struct("s_ms", F.col("m.sid").alias("sid"), F.col("m.sensor_type").alias("sensor_type"))
    aid = F.lit(None).cast(left.schema["aid"].dataType).alias("aid")
    marks = one.select(F.col("s_ms").alias("t"), F.lit(0).alias("side"), aid, mark.alias("mark"))
    asked = left.select(F.col("a_ms").alias("t"), F.lit(1).alias("side"), "aid", F.lit(None).cast(marks.schema["mark"].dataType).alias("mark"))
    order = ["t", "side", "aid"]
    like = asked.select(*order).unionByName(right.select(F.col("s_ms").alias("t"), F.lit(0).alias("side"), aid))
    rows = neighbours(asked.unionByName(marks), order, "mark", "before", "after", like).where("side = 1")
    away = lambda m: F.abs(F.col("t") - F.col(f"{m}.s_ms"))
    best = rows.withColumn("best", F.when(F.col("after").isNull() | (away("before") <= away("after")), F.col("before")).otherwise(F.col("after")))
    found = best.select("aid", F.col("t").alias("a_ms"), "best.*", away("best").alias("abs_dt"))
    return found.where(F.col("abs_dt") <= window_ms).select("aid", "a_ms", "sid", "s_ms", "sensor_type", "abs_dt")


def match_rate(fused: DataFrame, left: DataFrame) -> DataFrame:
    """(matched, total, rate); rows without a partner are no loss, only no match."""
    return fused.agg(F.count(F.lit(1)).alias("matched")).crossJoin(left.agg(F.count(F.lit(1)).alias("total"))).withColumn("rate", F.try_divide("matched", "total"))


def payload_audit(fused: DataFrame, left_payload: DataFrame, right_payload: DataFrame, window_ms: int) -> DataFrame:
    """Pairs whose own times (aid, a_payload_ms; sid, s_payload_ms) are further apart than the window, though their arrival wasn't."""
    both = fused.join(left_payload, "aid").join(right_payload, "sid")
    return both.withColumn("payload_dt", F.abs(F.col("s_payload_ms") - F.col("a_payload_ms"))).where(F.col("payload_dt") > window_ms)
