"""SimHash near-dedup: a grid over segment popcounts finds candidates, common one-bit neighbours verify them.

A 64-bit fingerprint maps to the counts of set bits in its 16 segments of 4 bits. The Manhattan distance of two
such vectors is at most the Hamming distance of the fingerprints. So fingerprints at Hamming distance 2 or less lie
at grid points at most two steps apart, and share a point that is at most one step from each. Every fingerprint goes
to the 33 points at most one step away; points with one visitor are dropped. Inside the shared points a link is
verified exactly: two fingerprints differ in at most 2 bits if and only if some value differs from each in at most
one bit, and that value has the shared grid point. No pairs are made: at most 65 fingerprints can share a value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from .common import chosen, cut, map_rows, place_of, plain_names, without
from .components import components

SHINGLE, SEED = 3, 42
#: Fingerprints that more than one row in HEAVY_SHARE has: this many at most, so their classes can be broadcast.
HEAVY_SHARE = 1000
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: str) -> int:
    """64 bits by majority over XXH64 of the word shingles, repeats included; 0 without words."""
    import xxhash

    words = text.encode().translate(_LOWER).split()  # bytes split at space and \t-\r only
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 1 << 15):  # bounded memory for very long texts
        hashes = np.array([digest(s, SEED) for s in shingles[at : at + (1 << 15)]], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(shingles), bitorder="little")
    return int.from_bytes(bits.tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (bigint, the 64 bits as they are) for every row; null text counts as empty, a null id stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t.as_py() or "") for t in batch.column(1)], pa.int64())], names=["doc_id", "fp"])

    own = chosen(docs, doc_id=id_col, text=text_col)
    return own.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, fp bigint")


def with_fingerprint(docs: DataFrame, place: int, name: str) -> DataFrame:
    """The rows of docs with one more column: the fingerprint of the text at this place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = pa.array([fingerprint(t.as_py() or "") for t in batch.column(place)], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, prints], names=[*batch.schema.names, f"c{len(batch.columns)}"])

    return map_rows(docs, run, StructField(name, LongType()))


def grid_point(fp: Column) -> Column:
    """Counts of set bits of the 16 nibbles, packed as nibbles in a bigint."""
    ones = F.lit(0x1111111111111111)
    return sum((F.shiftrightunsigned(fp, k).bitwiseAND(ones) for k in range(1, 4)), fp.bitwiseAND(ones))


def links(prints: DataFrame) -> DataFrame:
    """(a, b): linked fingerprints, from rows (fp) that are distinct; enough to connect all links."""
    bit = F.array(*[F.lit(1 << k if k < 63 else -(1 << 63)).cast("bigint") for k in range(64)])
    # Bits to flip, nibble by nibble; flipping one bit of a nibble moves its count one step up or down.
    point = grid_point(F.col("fp"))
    flips = prints.select("fp", point.alias("own"), F.explode(F.sequence(F.lit(-1), F.lit(31))).alias("step"))
    # step -1 stays; steps 0..15 go up and 16..31 down in that nibble, where it has a clear or a set bit.
    nibble = (F.col("step") % 16).cast("int")
    size = F.call_function("shiftrightunsigned", F.col("own"), 4 * nibble).bitwiseAND(F.lit(15))
    unit = F.call_function("shiftleft", F.lit(1).cast("bigint"), 4 * nibble)
    visits = flips.where((F.col("step") < 0) | ((F.col("step") < 16) & (size < 4)) | ((F.col("step") >= 16) & (size > 0))).select(
        "fp", "step", F.when(F.col("step") < 0, F.col("own")).when(F.col("step") < 16, F.col("own") + unit).otherwise(F.col("own") - unit).alias("point")
    )
    shared = visits.withColumn("visitors", F.count(F.lit(1)).over(Window.partitionBy("point"))).where("visitors > 1")
    mine = F.when(F.col("step") < 0, F.array(F.col("fp"))).otherwise(
        F.transform(
            F.filter(F.slice(bit, 4 * nibble + 1, 4), lambda b: (F.col("fp").bitwiseAND(b) == 0) == (F.col("step") < 16)),
            lambda b: F.col("fp").bitwiseXOR(b),
        )
    )
    values = shared.select("fp", F.explode(mine).alias("value"))
    near = values.groupBy("value").agg(F.count(F.lit(1)).alias("n"), F.collect_list("fp").alias("all")).where("n > 1")
    star = near.select(F.array_min("all").alias("least"), F.explode("all").alias("one"))
    checked = F.bit_count(F.col("one").bitwiseXOR(F.col("least"))) <= 2
    return star.where(checked & (F.col("one") != F.col("least"))).select(F.col("one").alias("a"), F.col("least").alias("b")).distinct()


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable over links of at most 2 bits) for every row of docs.

    Texts without words (null, empty) have fingerprint zero and link like any other. Rows may repeat an id: each row has
    its own fingerprint. A row with a null id links like any other and gets the smallest id of its component, null if
    all of its ids are null. An empty table gives no rows. Equal fingerprints count once in the search; their rows meet
    in one combined aggregation.
    """
    return classify(cut(fingerprints(docs, id_col, text_col), "fingerprints")).select("doc_id", "fp", "component_id")


def classify(rows: DataFrame) -> DataFrame:
    """rows (doc_id, fp, ...) that are cheap to read again, with label (least fingerprint of the component) and component_id."""
    prints = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "prints", rows.count())
    distinct = prints.count()
    linked = prints.join(components(links(prints.select("fp"))), F.col("fp") == F.col("node"), "left").select("fp", "rep", "n", "component")
    least = linked.where("component IS NOT NULL").groupBy("component").agg(F.min("rep").alias("least"))
    classes = cut(
        linked.join(least, "component", "left").select("fp", "rep", "n", F.coalesce("component", "fp").alias("label"), F.when(F.col("component").isNull(), F.col("rep")).otherwise(F.col("least")).alias("component_id")),
        "classes", distinct,
    )
    # Most fingerprints stand for one row and link to none: these rows need no class from elsewhere. Those of very many
    # rows would be hot keys of a join, and there are few of them.
    known = classes.where("n > 1 OR label != fp OR NOT rep <=> component_id")
    often = (classes.agg(F.sum("n")).first()[0] or 0) // HEAVY_SHARE
    heavy, light = (known.where(F.col("n") > often if big else F.col("n") <= often).select("fp", "label", "component_id") for big in (True, False))
    settled = rows.join(F.broadcast(heavy), "fp")
    rest = rows.join(F.broadcast(heavy.select("fp")), "fp", "left_anti").join(light, "fp", "left")
    both = settled.unionByName(rest.select(*settled.columns))
    return both.withColumns({"component_id": F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")), "label": F.coalesce("label", "fp")})


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their own columns: of each component the row with the smallest id, then fingerprint.

    Of rows that repeat both one stays; null ids come after all others; null and empty texts link like any other; an
    empty table stays empty; columns may have any names. Rows are written once with number and fingerprint; what goes
    is found by these and ids alone, and texts stay where they lie unless the numbers are too many to broadcast.
    """
    names = plain_names(len(docs.columns))
    numbered = with_fingerprint(docs.toDF(*names), place_of(docs, text_col), "fp").withColumn("row_no", F.monotonically_increasing_id())
    rows = cut(numbered, "marked")
    total = rows.count()
    found = cut(classify(rows.select("row_no", F.col(names[place_of(docs, id_col)]).cast("bigint").alias("doc_id"), "fp")), "classified", total)
    stays = found.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "row_no")).alias("best")).select(F.col("best.row_no").alias("row_no"))
    gone = cut(found.select("row_no").join(stays, "row_no", "left_anti"), "copies", total)
    return without(rows, gone, "row_no").select(*names).toDF(*docs.columns)
