"""Byte-level BPE: encoding by a priority queue of merge ranks over a doubly linked symbol list, and decoding."""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import place_of, plain_names
from .tokens import Memo, cut_pieces, is_word

#: How byte-level vocabularies split text before merging; white space is the Unicode property.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
OUTPUTS = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "decoded": pa.string(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
TYPES = {"n_tokens": LongType(), "ids": ArrayType(IntegerType()), "decoded": StringType(), "ids_sha256": StringType(), "decoded_sha256": StringType()}


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, with the byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class BytePairCodec:
    """A byte-level BPE vocabulary read from a JSON file (vocab, merges, added tokens)."""

    def __init__(self, spec: dict):
        of = byte_symbols()
        raw = {token: bytes(of[c] for c in token) for token in spec["model"]["vocab"] if all(c in of for c in token)}
        ids = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.text_of = [b""] * (1 + max([*ids.values(), *self.added.values()]))
        for token, i in ids.items():
            self.text_of[i] = raw.get(token, token.encode())
        for token, i in self.added.items():
            self.text_of[i] = token.encode()
        self.start = [0] * 256
        for c, b in of.items():
            self.start[b] = ids[c]
        #: Rank of each pair of ids, packed in one integer, and the id that each rank makes.
        self.rank, self.made = {}, []
        for r, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[ids[left] << 32 | ids[right]] = r
            self.made.append(ids[left + right])
        self.breaks = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.memo = Memo(self._piece)

    @classmethod
    def load(cls, path: str) -> BytePairCodec:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def merge(self, word: bytes) -> array:
        """Ids of one pre-token. The lowest rank goes first, the leftmost among equals.

        A queue entry is a rank and a place in one integer. A rank belongs to one pair of symbols, so an entry
        whose place no longer starts that pair is stale and skipped.
        """
        symbol = [self.start[b] for b in word]
        n, rank, made = len(symbol), self.rank, self.made
        if n < 2:
            return array("I", symbol)
        queue = [r * n + i for i in range(n - 1) if (r := rank.get(symbol[i] << 32 | symbol[i + 1])) is not None]
        if not queue:
            return array("I", symbol)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heapify(queue)
        while queue:
            r, i = divmod(heappop(queue), n)
            j = after[i]
            if j < 0 or rank.get(symbol[i] << 32 | symbol[j]) != r:
                continue
            symbol[i] = merged = made[r]
            symbol[j] = -1
            after[i] = k = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if (r := rank.get(merged << 32 | symbol[k])) is not None:
                    heappush(queue, r * n + i)
            if (h := before[i]) >= 0 and (r := rank.get(symbol[h] << 32 | merged)) is not None:
                heappush(queue, r * n + h)
        return array("I", [s for s in symbol if s >= 0])

    def _piece(self, piece: str) -> bytes:
        if is_word(piece) or len(words := SPLIT.findall(piece)) == 1:
            return self.merge(piece.encode()).tobytes()
        return b"".join(map(self.memo.__getitem__, words))

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, cut_pieces(text) or SPLIT.findall(text)))

    def encode(self, text: str) -> array:
        ids = array("I")
        for part in self.breaks.split(text) if self.breaks else [text]:
            if part in self.added:
                ids.append(self.added[part])
            elif part:
                ids.frombytes(self._plain(part))
        return ids

    def decode(self, ids) -> str:
        return b"".join(map(self.text_of.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[str, BytePairCodec] = {}


def codec(path: str) -> BytePairCodec:
    """One per worker and path."""
    if path not in _codecs:
        _codecs[path] = BytePairCodec.load(path)
    return _codecs[path]


def bpe_round_trip(docs: DataFrame, vocab_path: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"), id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Encodes every whole text and decodes the ids again; one row per row of docs, with doc_id and the outputs asked for.

    Columns of docs named in keep come along unchanged after doc_id, under their names even where an output is called alike. Outputs: n_tokens, ids, decoded, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the
    UTF-8 of the decoded text). Null text counts as empty and has no ids; a null id stays null; rows may
    repeat, an empty table gives no rows. Each row stands alone: no shuffle, memory bounded by one batch and the memo. vocab_path must be
    readable on each executor.
    """
    wanted = tuple(outputs)
    numbers: list[str] = []
    plain = plain_names(1 + len(keep) + len(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(vocab_path)
        if "ids_sha256" in wanted and not numbers:
            numbers.extend(map(str, range(len(own.text_of))))
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                out: dict[str, list] = {k: [] for k in wanted}
                for value in batch.column(1):
                    ids = own.encode(value.as_py() or "")
                    text = own.decode(ids)
                    made = {"n_tokens": len(ids), "ids": ids, "decoded": text}
                    if "ids_sha256" in out:
                        made["ids_sha256"] = hashlib.sha256(",".join(map(numbers.__getitem__, ids)).encode()).hexdigest()
                    if "decoded_sha256" in out:
                        made["decoded_sha256"] = hashlib.sha256(text.encode()).hexdigest()
                    for k, kept in out.items():
                        kept.append(made[k])
                kept_columns = [batch.column(0), *(batch.column(2 + i) for i in range(len(keep)))]
                yield pa.RecordBatch.from_arrays([*kept_columns, *(pa.array(out[k], OUTPUTS[k]) for k in wanted)], names=plain)

    names = plain_names(len(docs.columns))
    own = docs.toDF(*names)
    fields = [StructField("doc_id", LongType()), *(docs.schema.fields[place_of(docs, c)] for c in keep), *(StructField(k, TYPES[k]) for k in wanted)]
    kept_in = [F.col(names[place_of(docs, c)]).alias(f"k{i}") for i, c in enumerate(keep)]
    made = own.select(F.col(names[place_of(docs, id_col)]).cast("bigint").alias("doc_id"), F.col(names[place_of(docs, text_col)]).alias("text"), *kept_in)
    return made.mapInArrow(run, StructType([StructField(n, f.dataType) for n, f in zip(plain, fields, strict=True)])).toDF(*[f.name for f in fields])
