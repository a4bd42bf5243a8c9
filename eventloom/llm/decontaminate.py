"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, one scan of each text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chosen, map_rows, place_of

WINDOW = 10
#: Characters of patterns in one automaton (about 50 bytes of memory each); more items take more passes.
PATTERN_CHARS = 3_000_000
#: Words are digits, a-z and everything beyond ASCII; A-Z are lower-cased; all other bytes separate.
_TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
RUN = pa.struct([("first_word", pa.int32()), ("end_word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
SCHEMA = pa.schema([("row_no", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("items", pa.list_(pa.string()))])
SQL_SCHEMA = "row_no bigint, doc_id bigint, n_words bigint, runs array<struct<first_word:int,end_word:int,start:int,end:int>>, items array<string>"


def item_windows(text: str | None) -> set[bytes]:
    """Every window of consecutive words; an item of fewer words is one window, one of none has none."""
    words = (text or "").encode().translate(_TABLE).split()
    return {b" ".join(words[i : i + WINDOW]) for i in range(max(1, len(words) - WINDOW + 1))} if words else set()


def pattern_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", limit: int = PATTERN_CHARS) -> Iterator[list[tuple[str, bytes]]]:
    """(item, window) pairs in blocks of bounded size, item by item; the driver never holds more than a block."""
    block, held = [], 0
    for row in chosen(benchmark, item=item_col, text=text_col).select(F.col("item").cast("string"), "text").toLocalIterator():
        for window in sorted(item_windows(row.text)):
            if block and held + len(window) > limit:
                yield block
                block, held = [], 0
            block.append((row.item or "", window))
            held += len(window) + 2
    if block:
        yield block


def digest(block: list[tuple[str, bytes]]) -> str:
    """Names a block by its content: workers outlive a call, and so must what their automaton is known by."""
    made = hashlib.sha256()
    for item, window in block:
        raw = item.encode()
        made.update(b"%d %d %b%b" % (len(raw), len(window), raw, window))
    return made.hexdigest()


_automata: dict = {}


def automaton(key: str, block: list[tuple[str, bytes]]):
    """Windows between spaces, bytes as characters; one at a time is kept in a worker, under its block's digest."""
    if key not in _automata:
        import ahocorasick

        found: dict[bytes, set[str]] = {}
        for item, window in block:
            found.setdefault(window, set()).add(item)
        made = ahocorasick.Automaton()
        for window, items in found.items():
            made.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(items)))
        made.make_automaton()
        _automata.clear()
        _automata[key] = made
    return _automata[key]


def scan(text: str, patterns) -> tuple[int, list[dict], list[str]]:
    """Words of the text, runs of words inside any occurrence with their places in the original, items found."""
    raw = text.encode()
    flat = raw.translate(_TABLE)
    words = flat.split()
    if not words:
        return 0, [], []
    joined = b" ".join(words)
    hits, items = [], set()
    for end, (n, of) in patterns.iter(f" {joined.decode('latin-1')} "):
        hits.append((end, n))
        items.update(of)
    if not hits:
        return len(words), [], []
    spaces = np.flatnonzero(np.frombuffer(b" " + joined + b" ", np.uint8) == 0x20)
    ends = np.array(hits)
    last = np.searchsorted(spaces, ends[:, 0])  # words up to and with the last one of the match
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, last - ends[:, 1], 1)
    np.add.at(change, last, -1)
    inside = np.concatenate(([0], np.cumsum(change[:-1]) > 0, [0])).astype(np.int8)
    edges = np.diff(inside)
    first, stop = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    spot = np.concatenate(([0], np.frombuffer(flat, np.uint8) != 0x20, [0])).astype(np.int8)
    at = np.diff(spot)
    begins, finishes = np.flatnonzero(at == 1), np.flatnonzero(at == -1)
    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)))
    runs = [{"first_word": int(a), "end_word": int(b), "start": int(points[begins[a]]), "end": int(points[finishes[b - 1]])} for a, b in zip(first, stop, strict=True)]
    return len(words), runs, sorted(items)


def merge_runs(runs: list[dict]) -> list[dict]:
    out: list[dict] = []
    for r in sorted(runs, key=lambda r: (r["first_word"], r["end_word"])):
        if out and r["first_word"] <= out[-1]["end_word"]:
            out[-1] |= {"end_word": max(out[-1]["end_word"], r["end_word"]), "end": max(out[-1]["end"], r["end"])}
        else:
            out.append(dict(r))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", pattern_chars: int = PATTERN_CHARS) -> DataFrame:
    """One row per row of docs: row_no, doc_id, n_words, runs (hit words and their code points), items (ids as sorted strings).

    Null or wordless text has no words and no hits; null items and items without words match nothing; an item id that
    is null reads as ''; items that repeat a text are all reported. The items are few against the documents: they are
    broadcast in blocks of at most pattern_chars, each block scans all texts, and only if there is more than one block
    do the (short) findings meet in a shuffle.
    """
    spark = docs.sparkSession
    rows = chosen(docs, doc_id=id_col, text=text_col).select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("bigint"), "text")
    passes = []
    for block in pattern_blocks(benchmark, item_col, item_text_col, pattern_chars):
        sent = spark.sparkContext.broadcast(block)
        passes.append(rows.mapInArrow(_scanner(sent, digest(block)), SQL_SCHEMA))
    if not passes:
        import ahocorasick  # noqa: F401  the same needs with and without items

        passes.append(rows.mapInArrow(_scanner(spark.sparkContext.broadcast([("", b"\x00")]), "none"), SQL_SCHEMA))
    if len(passes) == 1:
        return passes[0]
    every = passes[0]
    for one in passes[1:]:
        every = every.unionByName(one)
    met = every.groupBy("row_no", "doc_id", "n_words").agg(F.flatten(F.collect_list("runs")).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            merged = [merge_runs(r) for r in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(merged, pa.list_(RUN)), batch.column(4)], schema=SCHEMA)

    return met.mapInArrow(merge, SQL_SCHEMA)


def _scanner(sent, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = automaton(key, sent.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                found = [scan(t.as_py() or "", patterns) for t in batch.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(RUN)), pa.array([f[2] for f in found], pa.list_(pa.string()))], schema=SCHEMA
                )

    return run


def contamination_report(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated from the operator's rows."""
    hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r["end_word"] - r["first_word"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", pattern_chars: int = PATTERN_CHARS) -> DataFrame:
    """The rows whose text holds no window of any item, with their own columns, whatever these are called: a filter for each block, no shuffle.

    Null and wordless texts stay; null items and items without words drop nothing; rows that repeat share their fate; an
    empty table stays empty, and without items every row stays.
    """
    spark, place = docs.sparkSession, place_of(docs, text_col)

    def keeper(sent, key: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            patterns = automaton(key, sent.value)
            for batch in batches:
                yield batch.filter(pa.array([not scan(t.as_py() or "", patterns)[1] for t in batch.column(place)], pa.bool_()))

        return run

    for block in pattern_blocks(benchmark, item_col, item_text_col, pattern_chars):
        sent = spark.sparkContext.broadcast(block)
        docs = map_rows(docs, keeper(sent, digest(block)))
    return docs
