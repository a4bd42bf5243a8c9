"""Token ids in binary files: one id array per file, document boundaries in Elias-Fano form.

A file holds, in this order (integers big-endian in the header, little-endian elsewhere):

    4 bytes "ELTK", 4 format version, 8 order of the file, 8 documents n, 8 ids u, 4 bytes per id, 4 low bits l,
    8 bytes of low part, 8 of high part, 8 of select samples, 8 of document ids
    low part     n numbers of l bits: the low bits of each document's end
    high part    one bit of 1 for each document, at place (end >> l) + its number
    samples      uint32 place of every 64th of these bits
    document ids zlib of int64; the null mask follows as bytes
    ids          u unsigned integers of 2 or 4 bytes

A task also writes how many ids each of its files has, so that places among all ids need no look into these.
A boundary takes l + 2 bits or so (plus half a bit of samples) instead of 64. Spark's own writer and committer
put the bytes into place, so that any store works and a repeated task leaves no second copy.
"""

from __future__ import annotations

import os
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.storage import fresh_path

from .bpe import SPLIT, byte_symbols
from .common import chosen
from .tokens import Memo, cut_pieces, is_word

MAGIC, HEADER = b"ELTK", struct.Struct(">4siqqqiiqqqq")
SAMPLE = 64
#: UTF-8 bytes of text for each writing task, and most of these tasks.
TEXT_PER_TASK, MOST_TASKS = 48 << 20, 50_000
#: Ids that may have rows enough for several tasks.
HOT_IDS = 100
#: Ids in a file (8 MB of them), most files, and ids that are given out at once when it is read.
IDS_PER_FILE, MOST_FILES, IDS_PER_BATCH = 4_000_000, 4_000_000, 500_000
#: A file of counts: magic, order of the first file counted, number of files, and the ids of each.
COUNTS_MAGIC, COUNTS, COUNTS_PER_FILE = b"ELTC", struct.Struct(">4sqi"), 4096


class EliasFano:
    """A rising sequence of n integers below or at u; select(i) finds the i-th without a table of all."""

    def __init__(self, n: int, bits: int, low: bytes, high: bytes, samples: np.ndarray):
        self.n, self.bits, self.low, self.high, self.samples = n, bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray, u: int) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        bits = max(0, (max(u, 1) // max(n, 1)).bit_length() - 1)
        low = b""
        if bits and n:
            spread = ((values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
            low = np.packbits(spread.reshape(-1), bitorder="little").tobytes()
        ones = ((values >> np.uint64(bits)) + np.arange(n, dtype=np.uint64)).astype(np.int64)
        marks = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        marks[ones] = 1
        return cls(n, bits, low, np.packbits(marks, bitorder="little").tobytes(), ones[::SAMPLE].astype("<u4"))

    def _low(self, i: int) -> int:
        if not self.bits:
            return 0
        at = i * self.bits
        word = int.from_bytes(self.low[at >> 3 : (at + self.bits + 7) >> 3], "little")
        return (word >> (at & 7)) & ((1 << self.bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: from the sample before it, bytes are skipped by their count of bits."""
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte, rest = place >> 3, self.high[place >> 3] >> (place & 7)
        while left >= (ones := rest.bit_count()):
            left -= ones
            byte += 1
            place, rest = byte << 3, self.high[byte]
        while True:
            if rest & 1:
                if not left:
                    return ((place - i) << self.bits) | self._low(i)
                left -= 1
            rest >>= 1
            place += 1


class TokenFile:
    """A file of this format, read from its bytes."""

    def __init__(self, raw: bytes):
        magic, version, self.order, self.n, self.n_ids, width, bits, low, high, samples, names = HEADER.unpack_from(raw)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token file")
        at = HEADER.size
        parts = []
        for k in (low, high, samples, names):
            parts.append(raw[at : at + k])
            at += k
        self.ends = EliasFano(self.n, bits, parts[0], parts[1], np.frombuffer(parts[2], "<u4"))
        named = zlib.decompress(parts[3])
        self.doc_ids = np.frombuffer(named[: 8 * self.n], "<i8")
        self.null = np.frombuffer(named[8 * self.n :], np.uint8).astype(bool)
        self.ids = np.frombuffer(raw, f"<u{width}", self.n_ids, at)

    def offset(self, i: int) -> int:
        """Where document i starts; n is the end of the last."""
        return self.ends.select(i - 1) if i else 0

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.offset(i) : self.offset(i + 1)]


def to_file(order: int, doc_ids: list, arrays: list[bytes], width: int) -> bytes:
    """The bytes of a file; arrays has each document's ids as little-endian integers of this width."""
    ends = np.cumsum([len(a) // width for a in arrays], dtype=np.int64)
    u = int(ends[-1]) if len(arrays) else 0
    coded = EliasFano.of(ends, u)
    names = zlib.compress(np.array([i or 0 for i in doc_ids], "<i8").tobytes() + np.array([i is None for i in doc_ids], np.uint8).tobytes(), 1)
    samples = coded.samples.tobytes()
    head = HEADER.pack(MAGIC, 1, order, len(arrays), u, width, coded.bits, len(coded.low), len(coded.high), len(samples), len(names))
    return b"".join([head, coded.low, coded.high, samples, names, *arrays])


def to_counts(first: int, counts: list[int]) -> bytes:
    """The bytes of a file of counts; first is the order of the first file counted."""
    return COUNTS.pack(COUNTS_MAGIC, first, len(counts)) + np.array(counts, ">i8").tobytes()


_encoders: dict = {}


def library_encoder(path: str, width: int):
    """text -> ids as bytes, by the tokenizers library; each piece of text is given to it once while it is remembered."""
    if (path, width) in _encoders:
        return _encoders[path, width]
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    whole, kind = Tokenizer.from_file(path), f"<u{width}"
    whole.no_truncation()
    whole.no_padding()
    tokenize, shown = whole.model.tokenize, str.maketrans({chr(b): c for c, b in byte_symbols().items()})
    # An array's bytes are the machine's; where these are not little-endian, numpy turns them.
    code = {2: "H", 4: "I"}[width] if sys.byteorder == "little" else None
    bytes_of = (lambda ids: array(code, ids).tobytes()) if code else (lambda ids: np.array(ids, kind).tobytes())
    added = [t.content for t in whole.get_added_tokens_decoder().values()]

    def piece(text: str) -> bytes:
        if not is_word(text) and len(words := SPLIT.findall(text)) != 1:
            return b"".join(map(memo.__getitem__, words))
        return bytes_of([t.id for t in tokenize(text.encode().decode("latin-1").translate(shown))])

    memo = Memo(piece)

    def encode(text: str) -> bytes:
        pieces = None if any(t in text for t in added) else cut_pieces(text)
        if pieces is None:
            return np.array(whole.encode(text, add_special_tokens=False).ids, kind).tobytes()
        return b"".join(map(memo.__getitem__, pieces))

    _encoders[path, width] = encode
    return encode


def forget_encoders() -> None:
    """Gives back a worker's vocabulary and memo, some 200 MB, when it goes on to steps that don't encode."""
    _encoders.clear()


@dataclass
class Places:
    """Which writing task gets an id: tasks are in the order of ids, and ids of very many rows (null too) have several."""

    #: First ids of all intervals but the first two, which are for null and for what is smaller than the first cut.
    cuts: np.ndarray
    #: The first task of each interval, and how many it has.
    first: np.ndarray
    tasks: np.ndarray

    @classmethod
    def of(cls, own: DataFrame, tasks: int, rows: int, nulls: int, often: list[tuple[int, int]]) -> Places:
        """Cuts from the ids alone, with a range of its own for every id of often (id, rows) that would fill one."""
        fair = max(1.0, rows / tasks)
        hot = {i: n for i, n in often if i is not None and n > 2 * fair}
        known = own.where(F.col("doc_id").isNotNull() & ~F.col("doc_id").isin(*hot)) if hot else own.where("doc_id IS NOT NULL")
        ranged = known.select("doc_id").repartitionByRange(tasks, "doc_id").groupBy(F.spark_partition_id()).agg(F.min("doc_id").alias("low"))
        lows = [r.low for r in ranged.collect()] if tasks > 1 else []  # one number for each task
        most = (1 << 63) - 1
        cuts = np.unique(np.array([*lows, *hot, *(i + 1 for i in hot if i < most)], np.int64))
        counts = np.ones(len(cuts) + 2, np.int64)
        counts[0] = -(-nulls // int(fair)) or 1
        for i, n in hot.items():
            counts[np.searchsorted(cuts, i) + 2] = -(-n // int(fair))
        return cls(cuts, np.concatenate(([0], np.cumsum(counts)[:-1])), counts)

    def place(self, ids: pa.Array, coded: list[bytes]) -> np.ndarray:
        """The task of each row; rows of an id with several tasks are spread by a hash of what they encode to."""
        at = np.searchsorted(self.cuts, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right") + 1
        at[ids.is_null().to_numpy(zero_copy_only=False)] = 0
        spread = np.array([zlib.crc32(c) if n > 1 else 0 for c, n in zip(coded, self.tasks[at].tolist(), strict=True)], np.int64)
        return self.first[at] + (spread * self.tasks[at] >> 32)

    def __len__(self) -> int:
        return int(self.tasks.sum())


def write_token_files(docs: DataFrame, folder: str, vocab_path: str, end_id: int, width: int = 2, id_col: str = "doc_id", text_col: str = "text", tasks: int | None = None) -> None:
    """Encodes every whole text, appends end_id, and writes the ids in ascending order of id.

    Texts are read and encoded once and only ids (width bytes each) are shuffled, by ranges whose bounds come from the id
    column alone. tasks is the number of ranges, by default one for TEXT_PER_TASK bytes and MOST_TASKS at most; beyond
    that a task writes more files, and sorts on disk. A file grows beyond IDS_PER_FILE only where there would be more than
    MOST_FILES of them. Nulls: an empty text, which keeps its end id; a null id, first in the order. Rows that repeat an
    id follow each other in the order of their ids' bytes, or of a hash of these and then of the bytes where they are so
    many that they fill several tasks. An empty table gives no file.
    """
    own = chosen(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint"), "text")
    facts = own.agg(F.sum(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("doc_id").isNull()).alias("nulls"), F.expr(f"approx_top_k(doc_id, {HOT_IDS}, {HOT_IDS * 100})").alias("often")).first()
    size = facts.size or 0
    tasks = tasks or int(min(max(1, -(-size // TEXT_PER_TASK)), MOST_TASKS))
    most_ids = max(IDS_PER_FILE, size // MOST_FILES)
    places = own.sparkSession.sparkContext.broadcast(Places.of(own, tasks, facts.n, facts.nulls, [(t["item"], t["count"]) for t in facts.often or []]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = library_encoder(vocab_path, width), end_id.to_bytes(width, "little")
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                coded = [code(t.as_py() or "") + end for t in batch.column(1)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(places.value.place(batch.column(0), coded), pa.int32()), pa.array(coded, pa.binary())], names=["doc_id", "place", "ids"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        place = TaskContext.get().partitionId()
        names, arrays, held, counts = [], [], 0, []
        row = lambda content: pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["content"])

        def made() -> pa.RecordBatch:
            counts.append(held)
            return row(to_file(place << 32 | len(counts) - 1, names, arrays, width))

        for batch in batches:
            for name, ids in zip(batch.column(0), batch.column(1), strict=True):
                if arrays and held >= most_ids:
                    yield made()
                    names, arrays, held = [], [], 0
                names.append(name.as_py())
                arrays.append(ids.as_py())
                held += len(arrays[-1]) // width
        if arrays:
            yield made()
        for at in range(0, len(counts), COUNTS_PER_FILE):
            yield row(to_counts(place << 32 | at, counts[at : at + COUNTS_PER_FILE]))

    rows = own.mapInArrow(encode, "doc_id bigint, place int, ids binary")
    placed = rows.repartitionById(len(places.value), F.col("place")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "ids").select("doc_id", "ids")
    files = placed.mapInArrow(pack, "content binary")
    # The text writer puts a string's bytes out as they are: this makes it a writer of binary files, one for each row.
    files.select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids (little-endian unsigned 32-bit) from all files.

    Counts of ids lie in small files beside the others, which their length tells apart before anything is read; only
    these are summed up. There are MOST_FILES sums and one for each writing task at most, so they are broadcast.
    """
    every = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    number = lambda at: F.conv(F.hex(F.substring("content", at, 8)), 16, 10).cast("bigint")
    magic = F.substring("content", 1, 4)
    listed = every.where(F.col("length") <= COUNTS.size + 8 * COUNTS_PER_FILE + 1).select("content").where(magic == F.lit(COUNTS_MAGIC))
    counts = listed.select(number(5).alias("first"), F.explode(F.sequence(F.lit(0), F.conv(F.hex(F.substring("content", 13, 4)), 16, 10).cast("int") - 1)).alias("k"), "content").select(
        (F.col("first") + F.col("k")).alias("order"), F.conv(F.hex(F.expr(f"substring(content, {COUNTS.size + 1} + 8 * k, 8)")), 16, 10).cast("bigint").alias("n_ids")
    ).withColumn("place", F.shiftright("order", 32))
    # Sums for each writing task first, so that the window without keys is over as many rows as there were tasks.
    places = counts.groupBy("place").agg(F.sum("n_ids").alias("n"))
    offsets = places.select("place", (F.sum("n").over(Window.orderBy("place")) - F.col("n")).alias("offset"))
    inside = F.sum("n_ids").over(Window.partitionBy("place").orderBy("order")) - F.col("n_ids")
    before = counts.withColumn("inside", inside).join(offsets, "place").select("order", (F.col("inside") + F.col("offset")).alias("first"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()
        for batch in batches:
            for first, raw in zip(batch.column(0), batch.column(1), strict=True):
                file = TokenFile(raw.as_buffer())
                at = begin = 0
                while begin < file.n:
                    starts, arrays, held = [], [], 0
                    for i in range(begin, file.n):
                        end = file.offset(i + 1)
                        starts.append(first.as_py() + at)
                        arrays.append(file.ids[at:end].astype("<u4").tobytes())
                        held += end - at
                        at = end
                        if held >= IDS_PER_BATCH:
                            break
                    some = slice(begin, begin + len(arrays))
                    begin = some.stop
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(file.doc_ids[some], mask=file.null[some]), pa.array(starts, pa.int64()), pa.array([len(a) // 4 for a in arrays], pa.int64()), pa.array(arrays, pa.binary())],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    content = every.where("length > 8").select("content").where(magic == F.lit(MAGIC))
    joined = content.withColumn("order", number(9)).join(F.broadcast(before), "order").select("first", "content")
    return joined.mapInArrow(unpack, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_file_round_trip(docs: DataFrame, vocab_path: str, end_id: int = 2, width: int = 2) -> DataFrame:
    """Writes the token files of docs to a new folder of the cluster's and reads them back."""
    folder = fresh_path(docs.sparkSession, "tokens")
    write_token_files(docs, folder, vocab_path, end_id, width)
    return read_token_files(docs.sparkSession, folder)
