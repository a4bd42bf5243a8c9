"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

A frequent-items sketch (Misra-Gries counters, merged across partitions) names the digests that may be
frequent. Their exact sizes and winners come from one map-side combined aggregation over these digests
alone; at most ``tracked`` such rows are broadcast and settle the rows of heavy groups where they are.
All other digests go through one ordinary shuffle, whose groups are bounded by the sketch's error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, chosen, cut, place_of, plain_names, text_or_empty, without

#: Digests that the sketch may report, and counters that it keeps; both bound the broadcast.
HEAVY_ITEMS = 1000
SKETCH_COUNTERS = 16384


def text_digest(text_col: str = "text") -> Column:
    """SHA-256 (binary) of the text with A-Z in lower case; null counts as empty."""
    return F.unhex(F.sha2(ascii_lower(text_or_empty(text_col)), 256))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy_items: int = HEAVY_ITEMS, counters: int = SKETCH_COUNTERS) -> DataFrame:
    """One row per input row: row_no, doc_id, digest, keep_id, group_size, kept.

    Of equal texts the row with the largest id stays; among rows that repeat that id one stays, and a null id
    is smaller than all others. Null text counts as empty; an empty table gives no rows; other columns of the
    input, whatever their names, are not read.
    """
    own = chosen(docs, doc_id=id_col, text=text_col)
    return settle(cut(own.select("doc_id", text_digest().alias("digest")).withColumn("row_no", F.monotonically_increasing_id()), "digests"), heavy_items, counters)


def settle(rows: DataFrame, heavy_items: int = HEAVY_ITEMS, counters: int = SKETCH_COUNTERS) -> DataFrame:
    """exact_dedup for rows (row_no, doc_id, digest) that are cheap to read again."""
    rows = rows.withColumn("key", F.xxhash64("digest"))
    listed = rows.agg(F.expr(f"approx_top_k(key, {int(heavy_items)}, {int(counters)})").alias("top"))
    suspects = listed.select(F.explode("top").alias("top")).select(F.col("top.item").alias("key"))
    best = F.max(F.struct("doc_id", "row_no"))
    heavy = (
        rows.join(F.broadcast(suspects), "key", "left_semi")
        .groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .where("group_size > 1")
    )
    # As many rows as the sketch reports at most (more only if two digests share a 64-bit key).
    heavy = cut(heavy, "heavy", heavy_items)
    settled = rows.join(F.broadcast(heavy), "digest")
    group = Window.partitionBy("digest")
    rest = (
        rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
        .withColumns({"group_size": F.count(F.lit(1)).over(group), "best": best.over(group)})
    )
    return settled.select(*rest.columns).unionByName(rest).select(
        "row_no", "doc_id", "digest", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row_no") == F.col("best.row_no")).alias("kept"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their own columns: one of each group of equal texts, that with the largest id.

    Nulls, ties and repeated rows as in exact_dedup; an empty table stays empty; columns may have any names. Rows are
    written once with a number; what goes is found by numbers, ids and digests alone, and texts stay where they lie
    unless the numbers of what goes are too many to broadcast.
    """
    names = plain_names(len(docs.columns))
    doc_id, text = names[place_of(docs, id_col)], names[place_of(docs, text_col)]
    rows = cut(docs.toDF(*names).withColumns({"row_no": F.monotonically_increasing_id(), "digest": text_digest(text)}), "numbered")
    found = settle(rows.select("row_no", F.col(doc_id).alias("doc_id"), "digest"))
    gone = cut(found.where("NOT kept").select("row_no"), "copies", rows.count())
    return without(rows, gone, "row_no").select(*names).toDF(*docs.columns)
