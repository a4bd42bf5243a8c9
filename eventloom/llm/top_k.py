"""Exact top-k by inner product over a bit-sliced index.

A block of rows is kept as bitmaps: for each component one bitmap for each bit of its integers, counted from the
component's least value in the block. A query's scores are never made row by row: its components' bits choose bitmaps
with weights, and full adders over whole bitmaps add these up to the bitmaps of the score. From the most significant one
downward, rows are taken or left until k remain; rows that tie at the border are taken in order of their ids, in which
a block's rows lie.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Rows of a block (their bitmaps are 8 kB each), and different queries that meet a block in one group at most.
BLOCK, CHUNK = 1 << 16, 1 << 14
#: Groups that even a small table is cut into, if each has so many queries.
LEAST_GROUPS, LEAST_CHUNK = 64, 128
BLOCK_ROW = "block long, no array<bigint>, vec_id array<bigint>, low array<bigint>, widths array<int>, slices binary"


@dataclass
class Block:
    #: Row numbers and ids by place; for each component its least value and its bits; bitmaps (and their complements below).
    no: np.ndarray
    vec_id: pa.Array
    low: list[int]
    widths: list[int]
    maps: np.ndarray

    def __post_init__(self):
        rows = len(self.no)
        self.every = np.packbits(np.arange(-(-rows // 64) * 64) < rows, bitorder="little").view(np.uint64)
        self.component = np.repeat(np.arange(len(self.widths)), self.widths)
        self.bit = np.concatenate([np.arange(w) for w in self.widths] or [np.zeros(0, int)]).astype(int)
        self.both = np.concatenate((self.maps, ~self.maps))
        self.by_no = np.argsort(self.no)

    def place(self, no: int) -> int | None:
        at = np.searchsorted(self.no, no, sorter=self.by_no)
        return int(self.by_no[at]) if at < len(self.no) and self.no[self.by_no[at]] == no else None

    def score_maps(self, q: list[int]) -> tuple[list[np.ndarray], int]:
        """Bitmaps of each row's score, least significant first, and what is to be added to their number."""
        q = (list(q) + [0] * len(self.low))[: len(self.low)]
        more = sum(x * low - (-x * ((1 << w) - 1) if x < 0 else 0) for x, low, w in zip(q, self.low, self.widths, strict=True))
        size, below = np.abs(np.array(q, np.int64)), np.array(q, np.int64) < 0
        chosen, weights = [], []
        for j in range(int(size.max(initial=0)).bit_length()):
            picked = np.flatnonzero(((size >> j) & 1)[self.component])
            # Minus u is the complement of u, less the largest number of its width.
            chosen.append(picked + below[self.component[picked]] * len(self.maps))
            weights.append(self.bit[picked] + j)
        rows, at = np.concatenate(chosen or [np.zeros(0, int)]).astype(int), np.concatenate(weights or [np.zeros(0, int)])
        out, carried, w = [], [], 0
        while w <= at.max(initial=-1) or carried:
            stack, carried = [self.both[rows[at == w]], *carried], []
            stack = np.concatenate(stack) if len(stack) > 1 else stack[0]
            while len(stack) > 2:
                third = len(stack) // 3
                a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                half = a ^ b
                carried.append((a & b) | (half & c))
                half ^= c
                stack = np.concatenate((half, stack[3 * third :])) if len(stack) > 3 * third else half
            if len(stack) == 2:
                carried.append(stack[:1] & stack[1:])
                stack = stack[:1] ^ stack[1:]
            out.append(stack[0] if len(stack) else np.zeros_like(self.every))
            w += 1
        return out, more

    def top(self, q: list[int], k: int, without: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k rows of largest score, then smallest place, but for the row at place without."""
        maps, more = self.score_maps(q)
        open_ = self.every.copy()
        if without is not None:
            open_[without >> 6] &= ~np.uint64(1 << (without & 63))
        taken, left = np.zeros_like(open_), k
        for m in reversed(maps):
            high = open_ & m
            n = int(np.bitwise_count(high).sum())
            if n > left:
                open_ = high
            else:
                taken |= high
                open_ &= ~m
                left -= n
        places = np.sort(np.concatenate((_places(taken), _places(open_)[:left])))
        score = np.full(len(places), more, np.int64)
        for w, m in enumerate(maps):
            score += ((m[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << w
        order = np.lexsort((places, -score))
        return places[order], score[order]


def _places(bits: np.ndarray) -> np.ndarray:
    """Where bits are set."""
    words = np.flatnonzero(bits)
    inside = np.unpackbits(bits[words].view(np.uint8), bitorder="little").reshape(len(words), 64)
    row, at = np.nonzero(inside)
    return words[row] * 64 + at


def _slices(no: np.ndarray, ids: pa.Array, vectors: pa.Array) -> dict:
    """A block's row: rows in order of ids (nulls last), then numbers; components that a vector lacks are 0."""
    known = ids.fill_null(0).to_numpy(zero_copy_only=False)
    order = np.lexsort((no, known, np.asarray(ids.is_null())))
    sizes = np.diff(vectors.offsets.to_numpy())
    flat, wide = vectors.flatten().to_numpy(zero_copy_only=False), int(sizes.max(initial=0))
    v = np.zeros((len(no), wide), np.int64)
    v[np.arange(wide) < sizes[:, None]] = flat
    v = v[order]
    low = v.min(0) if len(v) else np.zeros(wide, np.int64)
    widths = [int(x).bit_length() for x in (v.max(0) - low if len(v) else low)]
    full, maps = -(-len(no) // 64) * 64, []
    for d, w in enumerate(widths):
        u = np.zeros(full, np.int64)
        u[: len(v)] = v[:, d] - low[d]
        maps += [np.packbits((u >> b & 1).astype(bool), bitorder="little") for b in range(w)]
    return {"no": no[order], "vec_id": ids.take(pa.array(order)), "low": low.tolist(), "widths": widths, "slices": np.concatenate(maps).tobytes() if maps else b""}


def _index(rows: pa.Table) -> pa.Table:
    """Rows (block, no, vec_id, q) of a block as its one row of the index."""
    whole = rows.combine_chunks()
    made = _slices(whole["no"].to_numpy(), whole["vec_id"].combine_chunks(), whole["q"].combine_chunks())
    one = {"block": pa.array([whole["block"][0].as_py()], pa.int64()), "no": pa.array([made["no"]], pa.list_(pa.int64())), "vec_id": pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), made["vec_id"])}
    return pa.table(one | {"low": pa.array([made["low"]], pa.list_(pa.int64())), "widths": pa.array([made["widths"]], pa.list_(pa.int32())), "slices": pa.array([made["slices"]], pa.binary())})


def block_of(index: pa.Table) -> Block:
    """The block of a row of the index."""
    part = lambda name: index[name].combine_chunks()
    no, widths = part("no").flatten().to_numpy(), part("widths").flatten().to_pylist()
    maps = np.frombuffer(part("slices")[0].as_py(), np.uint64).reshape(sum(widths), -(-len(no) // 64))
    return Block(no, part("vec_id").flatten(), part("low").flatten().to_pylist(), widths, maps)


def _search(k: int):
    """Cogrouped by block and chunk: (query, no, vec_id, score), k rows at most for each query."""
    schema = pa.schema([("query", pa.int64()), ("no", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        if not index.num_rows or not queries.num_rows:
            return schema.empty_table()
        block, asked, places, scores = block_of(index), [], [], []
        for part in queries.select(["no", "q"]).to_batches(LEAST_CHUNK):
            for r in part.to_pylist():
                at, score = block.top(r["q"], k, None)
                asked.append(np.full(len(at), r["no"], np.int64))
                places.append(at)
                scores.append(score)
        where = np.concatenate(places)
        return pa.table([pa.array(np.concatenate(asked)), pa.array(block.no[where]), block.vec_id.take(pa.array(where)), pa.array(np.concatenate(scores))], schema=schema)

    return run


def top_k(vectors: DataFrame, every: int = 20, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose vec_id every divides, the k other rows of largest inner product.

    vectors has vec_id long and q array<bigint>. Ties go to the smaller vec_id, null ids come last. Rows that repeat an id are
    queries and candidates each; a query leaves out its own row only. Components that the shorter of two vectors lacks count
    as 0. No queries give no rows. A block of the index and a chunk of queries are what a task holds at once.

    Of equal vectors the first k + 1 by id are all that any query can be given, and equal queries find the same k + 1 rows, so
    the search is over different vectors, however many copies there are.
    """
    rows = cut(vectors.select(F.monotonically_increasing_id().alias("no"), "vec_id", "q"), "vectors")
    copy = F.row_number().over(Window.partitionBy("q").orderBy(F.asc_nulls_last("vec_id"), "no"))
    kept = cut(rows.withColumn("copy", copy).where(F.col("copy") <= k + 1).drop("copy"), "candidates")
    asked = cut(rows.where(F.col("vec_id") % every == 0).withColumn("query", F.min("no").over(Window.partitionBy("q"))), "queries")
    different = asked.where("no = query")
    n, n_asked = kept.count(), different.count()
    blocks = max(1, -(-n // BLOCK))
    chunks = max(1, -(-n_asked // CHUNK), min(-(-n_asked // LEAST_CHUNK), -(-LEAST_GROUPS // blocks)))
    dealt = lambda df, name, parts: df.withColumn(name, F.pmod(F.xxhash64("no"), F.lit(parts)))
    index = cut(dealt(kept, "block", blocks).groupBy("block").applyInArrow(_index, BLOCK_ROW), "index")
    # A block meets each chunk once: its bitmaps (some 4 MB) go to as many groups as there are chunks, queries to as many as there are blocks.
    left = index.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
    right = dealt(different.select("no", "q"), "chunk", chunks).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    found = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(_search(k + 1), "query long, no long, vec_id long, score long")
    best = lambda by: F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), F.asc_nulls_last("vec_id")))
    shared = found.withColumn("rank", best("query")).where(F.col("rank") <= k + 1).select("query", F.col("no").alias("other"), "vec_id", "score")
    answers = asked.select("query", "no", F.col("vec_id").alias("query_id")).join(shared, "query").where("other <> no")
    return answers.withColumn("rank", best("no")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
