"""Repeated byte strings across documents, by a distributed merge sort of front-coded suffix runs.

Every LENGTH-byte string of a text holds a sampled place, or anchor: the K-gram of least hash in it. Equal strings
have equal anchors at equal offsets, so it is enough to sort suffixes that start at anchors, and of these only the
ones whose K-gram occurs in more than one document.

1. Each run (documents of some megabytes) sends its distinct anchor hashes, sorted and in buckets; a bucket answers
   each run with the hashes that other documents have as well. A frequent K-gram counts once for each run.
2. Each run sorts the suffixes at its surviving anchors (K-gram, bytes to its right, bytes to its left reversed),
   keeps each once with the least and largest document id, and sends front-coded pieces of the sorted run to range
   buckets. Who holds them stays with the run, so a passage in a third of all documents is one entry for each run.
   Through a K-gram that very many runs have, whole LENGTH-byte strings are sorted instead of suffixes: these need no
   company of others with the same K-gram, so the contexts of a frequent K-gram are no group of one task.
3. A bucket merges its runs with a loser tree that carries common-prefix lengths: of two candidates the one that
   shares more with the last winner is smaller, and only if they share as much are bytes compared, from there on.
   Suffixes of one K-gram come out side by side; each of the strings through the anchor gets the least document id.
   Beyond MOST_RANGES ranges, merging has two levels: pieces that runs send would hold a suffix or two if they were cut
   finer, so groups of runs are first merged within each range, and their joint runs are cut.
4. The answers go back to the runs (by way of joint runs, if there are any), which mark bytes and cut them out.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator
from itertools import repeat
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.storage import fresh_path

from .common import chosen, cut, text_or_empty

LENGTH, K = 50, 24
#: Places of a text that are hashed, and anchors that are looked at or marked, at once.
PIECE, STEP = 1 << 20, 1 << 16
#: Bytes beside the K-gram that strings through it can reach, on either side; also K-grams in a string, less one.
REACH = LENGTH - K
#: Bytes of text in a run and documents in it, anchor hashes in a bucket, bytes of text for each range bucket.
RUN_BYTES, RUN_ROWS, HASHES_PER_BUCKET, TEXT_PER_RANGE = 12 << 20, 1 << 16, 1_000_000, 24 << 20
#: Most buckets of the table of texts; a bucket may hold any number of runs.
MOST_BUCKETS = 20_000
#: Runs that have a K-gram from which on whole strings through it are sorted.
HOT_RUNS = 4096
#: Most ranges, suffixes sampled for their bounds, and bytes of a bound; bounds decide balance, never results.
#: Beyond MOST_RANGES each range has several buckets, by a hash of K-grams, and as many groups of runs.
MOST_RANGES, HEADS, HEAD = 4096, 200_000, 16

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_U29, _U32, _U16 = np.uint64(29), np.uint64(32), np.uint64(16)
NO_ID = -(1 << 63)
#: First bytes of what is sorted, and bytes that elements share which are settled together.
SUFFIX, WHOLE = b"\0", b"\1"
TOGETHER = {SUFFIX: 1 + K, WHOLE: 1 + LENGTH}


def _sliding(a: np.ndarray, width: int, take) -> np.ndarray:
    """take (minimum or maximum) over each width neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        a = take(a[:-done], a[done:])
        done *= 2
    rest = width - done
    return take(a[:-rest], a[rest:]) if rest else a


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors in a text and 48 bits of their K-grams' hashes; every LENGTH-byte string holds one.

    A text is looked at in pieces that reach as far beside their own places as a string through them does.
    """
    n = len(raw)
    if n < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    word = np.ndarray((n - 7,), "<u8", raw, 0, (1,))  # the 8 bytes at each place
    count = n - K + 1
    found = [_anchors(word, max(0, at - REACH), min(count, at + PIECE + REACH), at, min(count, at + PIECE)) for at in range(0, count, PIECE)]
    return np.concatenate([places for places, _ in found]), np.concatenate([hashes for _, hashes in found])


def _anchors(word: np.ndarray, low: int, high: int, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchors from begin to before end, from the K-grams from low to before high."""
    h = word[low:high] * _C[0]
    h += word[low + 8 : high + 8] * _C[1]
    h ^= h >> _U29
    h += word[low + 16 : high + 16] * _C[2]
    h ^= h >> _U32
    h *= _C[3]
    h ^= h >> _U29
    least = _sliding(h, REACH + 1, np.minimum)
    padded = np.zeros(len(least) + 2 * REACH, np.uint64)
    padded[REACH : REACH + len(least)] = least
    places = np.flatnonzero(_sliding(padded, REACH + 1, np.maximum) == h)
    own = places[(places >= begin - low) & (places < end - low)]
    return own + low, h[own] >> _U16


def suffix(raw: bytes, a: int) -> tuple[bytes, int]:
    """SUFFIX, K-gram at a, up to REACH bytes to its right, those to its left reversed, and one byte with the count to the right; first string's place."""
    low = max(0, a - REACH)
    right = raw[a : a + LENGTH]
    return SUFFIX + right + raw[low:a][::-1] + bytes((len(right) - K,)), low


def whole_strings(raw: bytes, a: int) -> list[tuple[bytes, int]]:
    """Each string through the K-gram at a, after WHOLE, with its place."""
    return [(WHOLE + raw[i : i + LENGTH], i) for i in range(max(0, a - REACH), min(a, len(raw) - LENGTH) + 1)]


def strings(element: bytes) -> list[bytes]:
    """All LENGTH-byte strings through the K-gram of a suffix, from left to right; a whole string is its only one."""
    if element[:1] == WHOLE:
        return [element[1:]]
    right = K + element[-1]
    left = element[1 + right : -1]
    whole = left[::-1] + element[1 : 1 + right]
    return [whole[i : i + LENGTH] for i in range(max(0, len(whole) - LENGTH + 1))]


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix; the first known bytes are not looked at."""
    n = min(len(a), len(b)) - known
    if n <= 0:
        return known
    x = int.from_bytes(a[known : known + n], "big") ^ int.from_bytes(b[known : known + n], "big")
    return known + n if not x else known + n - (x.bit_length() + 7) // 8


def front_code(elements: list[bytes]) -> tuple[bytes, bytes, bytes]:
    """Sorted strings as common-prefix lengths, tail lengths and tails, each compressed."""
    shared, tails, last = bytearray(), [], b""
    for e in elements:
        k = common_prefix(last, e)
        shared.append(k)
        tails.append(e[k:])
        last = e
    return zstandard.compress(bytes(shared), 3), zstandard.compress(bytes(map(len, tails)), 3), zstandard.compress(b"".join(tails), 3)


def front_decode(shared: bytes, lengths: bytes, tails: bytes) -> Iterator[tuple[bytes, int]]:
    """The strings again, each with its common prefix with the one before."""
    last, at = b"", 0
    shared, lengths, tails = map(zstandard.decompress, (shared, lengths, tails))
    for k, n in zip(shared, lengths, strict=True):
        last = last[:k] + tails[at : at + n]
        at += n
        yield last, k


class LoserTree:
    """Merges sorted streams of (string, common prefix with the one before in its stream)."""

    def __init__(self, streams: list[Iterator[tuple[bytes, int]]]):
        self.streams, n = streams, 1
        while n < len(streams):
            n *= 2
        self.size = n
        #: Each stream's head, None at its end, and the head's common prefix with the last winner.
        self.head: list[bytes | None] = [None] * n
        self.shared = [0] * n
        for s, stream in enumerate(streams):
            if first := next(stream, None):
                self.head[s] = first[0]
        self.loser = [0] * n
        winner = list(range(n)) if n == 1 else [0] * n + list(range(n))
        for node in range(n - 1, 0, -1):
            winner[node], self.loser[node] = self._play(winner[2 * node], winner[2 * node + 1])
        self.top = winner[1] if n > 1 else 0

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's known prefix becomes that with the winner."""
        x, y = self.head[a], self.head[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        p, q = self.shared[a], self.shared[b]
        if p != q:
            return (a, b) if p > q else (b, a)
        k = common_prefix(x, y, p)
        first = k == len(x) or (k < len(y) and x[k] < y[k])
        if k == len(x) == len(y):
            first = a < b
        if first:
            self.shared[b] = k
            return a, b
        self.shared[a] = k
        return b, a

    def __iter__(self) -> Iterator[tuple[bytes, int, int]]:
        """(string, common prefix with the one before, stream) in order."""
        head, shared, loser = self.head, self.shared, self.loser
        while (one := head[s := self.top]) is not None:
            yield one, shared[s], s
            following = next(self.streams[s], None)
            head[s], shared[s] = following if following else (None, 0)
            node = (s + self.size) >> 1
            while node:
                s, loser[node] = self._play(s, loser[node])
                node >>= 1
            self.top = s


def _batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def pack(a: np.ndarray) -> bytes:
    """An array's bytes, first all first bytes, then all second ones and so on, compressed."""
    return zstandard.compress(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes(), 3) if len(a) else b""


def unpack(raw: bytes, kind: np.dtype) -> np.ndarray:
    if not raw:
        return np.empty(0, kind)
    planes = np.frombuffer(zstandard.decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


HASHED = pa.schema([("run", pa.int64()), ("bucket", pa.int64()), ("hashes", pa.binary()), ("shared", pa.binary())])
ANSWERED = pa.schema([("run", pa.int64()), ("hashes", pa.binary()), ("hot", pa.binary())])
SORTED = pa.schema([
    ("run", pa.int64()), ("bucket", pa.int64()), ("first", pa.int64()), ("prefixes", pa.binary()), ("lengths", pa.binary()), ("tails", pa.binary()), ("ids", pa.binary()),
    ("row_no", pa.int64()), ("holders", pa.binary()),
])
#: run is a joint run here; entries has the number in it of each entry that origin sent to its range, from first on.
COMBINED = pa.schema([
    ("run", pa.int64()), ("bucket", pa.int64()), ("first", pa.int64()), ("prefixes", pa.binary()), ("lengths", pa.binary()), ("tails", pa.binary()), ("ids", pa.binary()),
    ("origin", pa.int64()), ("entries", pa.binary()),
])
MARKED = pa.schema([("run", pa.int64()), ("marks", pa.binary())])
MARK = np.dtype([("entry", "<u4"), ("from", "<i2"), ("to", "<i2"), ("least", "<i8")])
HOLDER = np.dtype([("entry", "<u4"), ("place", "<u4")])
#: Least and largest id of the documents of a run that hold a suffix.
IDS = np.dtype([("least", "<i8"), ("most", "<i8")])
CUT = pa.schema([("row_no", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.string()), ("kept_sha256", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "bigint", pa.binary(): "binary", pa.string(): "string", pa.list_(pa.int64()): "array<bigint>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _hash_runs(buckets: int):
    def flush(run: int, found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not found:
            return
        every, times = np.unique(np.concatenate(found), return_counts=True)  # found holds each document's hashes once
        bucket = ((every >> _U16) * np.uint64(buckets)) >> _U32
        edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        rows = [(b, i, j) for b, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if j > i]
        # 6 of 8 bytes hold the hash; apart in planes they compress better.
        planes = lambda i, j: every[i:j].view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()
        yield _batch({"run": [run] * len(rows), "bucket": [r[0] for r in rows], "hashes": [planes(i, j) for _, i, j in rows], "shared": [np.packbits(times[i:j] > 1).tobytes() for _, i, j in rows]}, HASHED)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, found = None, []
        for batch in batches:
            for r, text in zip(batch.column(0), batch.column(1), strict=True):
                if r.as_py() != run:
                    yield from flush(run, found)
                    run, found = r.as_py(), []
                hashes = anchors(text.as_buffer().to_pybytes())[1]
                if len(hashes):
                    found.append(np.unique(hashes))
        yield from flush(run, found)

    return work


def unplane(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(6, n).T
    return wide.view("<u8").reshape(-1)


def plane(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)[:, :6].T.tobytes()


def _answer(group: pa.Table) -> pa.Table:
    """To each run the hashes of this bucket that more than one document has, and those of them that very many runs have."""
    parts = [unplane(h.as_py()) for h in group.column("hashes")]
    own = [np.unpackbits(np.frombuffer(s.as_py(), np.uint8), count=len(p)).astype(bool) for s, p in zip(group.column("shared"), parts, strict=True)]
    every = np.concatenate(parts)
    values, times = np.unique(every, return_counts=True)
    twice = np.union1d(values[times > 1], every[np.concatenate(own)])
    often = values[times >= HOT_RUNS]
    hot = lambda both: plane(both[np.isin(both, often, assume_unique=True)]) if len(often) else b""
    out = []
    for run, part in zip(group.column("run"), parts, strict=True):
        both = part[np.isin(part, twice, assume_unique=True)]
        if len(both):
            out.append((run.as_py(), plane(both), hot(both)))
    return pa.table({"run": pa.array([o[0] for o in out], pa.int64()), "hashes": pa.array([o[1] for o in out], pa.binary()), "hot": pa.array([o[2] for o in out], pa.binary())})


def _joined(column) -> np.ndarray:
    return np.sort(np.concatenate([np.empty(0, np.uint64), *(unplane(h.as_py()) for h in column)]))


def _among(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(hashes), bool)
    at = np.searchsorted(known, hashes)
    at[at == len(known)] = 0
    return known[at] == hashes


def _pieces(order: list[bytes], buckets: np.ndarray, ids) -> Iterator[dict]:
    """Front-coded pieces of elements that lie in the order of their buckets and are sorted in each."""
    edges = np.flatnonzero(np.diff(buckets, prepend=-1, append=-1)).tolist()
    for i, j in zip(edges[:-1], edges[1:], strict=True):
        prefixes, lengths, tails = front_code(order[i:j])
        yield {"bucket": int(buckets[i]), "first": i, "prefixes": prefixes, "lengths": lengths, "tails": tails, "ids": pack(np.array(ids[i:j], "<i8").reshape(-1).view(IDS))}


def _streams(group: pa.Table) -> list[Iterator[tuple[bytes, int]]]:
    return [front_decode(*(group.column(c)[k].as_py() for c in ("prefixes", "lengths", "tails"))) for k in range(group.num_rows)]


def _combine(parts: int):
    """Merges a group of runs within a range into one joint run, and cuts it into the range's buckets."""

    def work(group: pa.Table) -> pa.Table:
        joint, range_ = group.column("joint")[0].as_py(), group.column("bucket")[0].as_py()
        ids = [unpack(i.as_py(), IDS).tolist() for i in group.column("ids")]
        order: list[bytes] = []
        owners: list[list] = []
        places: list[list[int]] = [[] for _ in ids]
        for element, known, s in LoserTree(_streams(group)):
            low, high = ids[s][len(places[s])]
            if order and known == len(element) == len(order[-1]):
                owners[-1] = [min(owners[-1][0], low), max(owners[-1][1], high)]
            else:
                order.append(element)
                owners.append([low, high])
            places[s].append(len(order) - 1)
        buckets = range_ * parts + np.array([zlib.crc32(e[: TOGETHER[e[:1]]]) % parts for e in order], np.int64)
        by_bucket = np.argsort(buckets, kind="stable")
        number = np.empty(len(order), "<u4")
        number[by_bucket] = np.arange(len(order))
        rows = [{"run": joint, **piece} for piece in _pieces([order[k] for k in by_bucket.tolist()], buckets[by_bucket], [owners[k] for k in by_bucket.tolist()])]
        rows += [{"run": joint, "origin": run.as_py(), "first": first.as_py(), "entries": pack(number[mine])} for run, first, mine in zip(group.column("run"), group.column("first"), places, strict=True)]
        return pa.Table.from_pylist(rows, schema=COMBINED)

    return work


def _marks_of(column) -> np.ndarray:
    marks = np.concatenate([np.empty(0, MARK), *(unpack(m.as_py(), MARK) for m in column if m.is_valid)])
    return marks[np.argsort(marks["entry"], kind="stable")]


def _matches(marks: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (mark, entry) by place, for every mark of every entry."""
    low, high = np.searchsorted(marks["entry"], entries, "left"), np.searchsorted(marks["entry"], entries, "right")
    times = high - low
    return np.repeat(low - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum()), np.repeat(np.arange(len(entries)), times)


def _spread(maps: pa.Table, found: pa.Table) -> pa.Table:
    """Marks of a joint run as marks of the runs that it is made of."""
    marks, out = _marks_of(found.column("marks")), []
    for origin, first, entries in zip(maps.column("origin"), maps.column("first"), maps.column("entries"), strict=True) if len(marks) else ():
        which, place = _matches(marks, unpack(entries.as_py(), np.dtype("<u4")))
        if len(which):
            own = marks[which]
            own["entry"] = first.as_py() + place
            out.append((origin.as_py(), pack(own)))
    return pa.table({"run": pa.array([r for r, _ in out], pa.int64()), "marks": pa.array([m for _, m in out], pa.binary())})


def _sort_run(sent):
    def work(docs: pa.Table, answers: pa.Table) -> pa.Table:
        wanted, often, bounds = _joined(answers.column("hashes")), _joined(answers.column("hot")), sent.value
        rows: list[dict] = []
        # Elements are numbered as they come; a holder is two numbers, however often its element comes again.
        entry: dict[bytes, int] = {}
        least, most = array("q"), array("q")
        held: dict[int, tuple[array, array]] = {}
        run = docs.column("run")[0].as_py() if docs.num_rows else None
        for row_no, doc_id, text in zip(docs.column("row_no"), docs.column("doc_id"), docs.column("text"), strict=True) if len(wanted) else ():
            raw = text.as_buffer().to_pybytes()
            places, hashes = anchors(raw)
            if not len(places):
                continue
            chosen_ = _among(wanted, hashes)
            places, hot = places[chosen_], _among(often, hashes[chosen_])
            if len(places):
                own = doc_id.as_py() if doc_id.is_valid else NO_ID
                held[row_no.as_py()] = numbers, lows = array("I"), array("I")
                for at in range(0, len(places), STEP):
                    for a, whole in zip(places[at : at + STEP].tolist(), hot[at : at + STEP].tolist(), strict=True):
                        for element, low in whole_strings(raw, a) if whole else (suffix(raw, a),):
                            number = entry.setdefault(element, len(least))
                            if number == len(least):
                                least.append(own)
                                most.append(own)
                            elif own < least[number]:
                                least[number] = own
                            elif own > most[number]:
                                most[number] = own
                            numbers.append(number)
                            lows.append(low)
        order = sorted(entry)
        came = np.array([entry[e] for e in order], np.int64)
        place_of = np.empty(len(order), "<u4")
        place_of[came] = np.arange(len(order))
        for row_no, (numbers, lows) in held.items():
            holders = np.empty(len(numbers), HOLDER)
            holders["entry"], holders["place"] = place_of[np.frombuffer(numbers, "<u4")], np.frombuffer(lows, "<u4")
            rows.append({"run": run, "row_no": row_no, "holders": pack(holders)})
        ids = np.stack((np.array(least, np.int64)[came], np.array(most, np.int64)[came]), 1)
        # A bound is as long as the first bytes of an element, which are within its K-gram: what is settled together shares a range.
        ranges = np.searchsorted(bounds, np.array([e[:HEAD] for e in order], f"S{HEAD}"), side="right")
        rows.extend({"run": run, **piece} for piece in _pieces(order, ranges, ids))
        return pa.Table.from_pylist(rows, schema=SORTED)

    return work


def _merge(group: pa.Table) -> pa.Table:
    """Of one range bucket: for each run, entries and strings through them that a document with a smaller id has."""
    runs = [r.as_py() for r in group.column("run")]
    firsts = [f.as_py() for f in group.column("first")]
    ids = [unpack(i.as_py(), IDS).tolist() for i in group.column("ids")]
    place = [0] * len(runs)
    marks: list[list[tuple]] = [[] for _ in runs]

    def settle(same: list[tuple[bytes, list[tuple[int, int]]]]) -> None:
        """Suffixes of one K-gram, each with its holders (stream, entry)."""
        owners = [ids[s][e] for _, holders in same for s, e in holders]
        if min(o[0] for o in owners) == max(o[1] for o in owners):
            return
        if len(same) == 1:  # one suffix, so all strings through it have its holders
            (element, holders), low = same[0], min(o[0] for o in owners)
            last = 0 if element[:1] == WHOLE else len(element) - 2 - LENGTH
            if last >= 0:
                for s, e in holders:
                    if low < ids[s][e][1]:
                        marks[s].append((firsts[s] + e, 0, last, low))
            return
        # In the order of ids, whoever has a string first has it for good.
        first = {}.setdefault
        for own, element, holders in sorted(((min(ids[s][e][0] for s, e in holders), element, holders) for element, holders in same), key=itemgetter(0)):
            lows, spans, begin = list(map(first, strings(element), repeat(own))), [], 0
            if lows and lows.count(lows[0]) == len(lows):
                spans.append((0, len(lows) - 1, lows[0]))
            else:
                for i in range(1, len(lows) + 1):
                    if i == len(lows) or lows[i] != lows[begin]:
                        spans.append((begin, i - 1, lows[begin]))
                        begin = i
            for s, e in holders:
                most = ids[s][e][1]
                marks[s].extend((firsts[s] + e, i, j, low) for i, j, low in spans if low < most)

    same: list[tuple[bytes, list[tuple[int, int]]]] = []
    for element, known, s in LoserTree(_streams(group)):
        if same and known < TOGETHER[element[:1]]:
            settle(same)
            same = []
        if same and known == len(element) == len(same[-1][0]):
            same[-1][1].append((s, place[s]))
        else:
            same.append((element, [(s, place[s])]))
        place[s] += 1
    if same:
        settle(same)
    got = [(r, pack(np.array(m, MARK))) for r, m in zip(runs, marks, strict=True) if m]
    return pa.table({"run": pa.array([r for r, _ in got], pa.int64()), "marks": pa.array([m for _, m in got], pa.binary())})


def _cut_run(with_text: bool):
    def work(docs: pa.Table, found: pa.Table) -> pa.Table:
        marks = _marks_of(found.column("marks"))
        held = {r.as_py(): h for r, h in zip(found.column("row_no"), found.column("holders"), strict=True) if h.is_valid}
        out = {f.name: [] for f in CUT}
        for doc in docs.to_batches():
            for row_no, doc_id, text in zip(*(doc.column(doc.schema.get_field_index(c)) for c in ("row_no", "doc_id", "text")), strict=True):
                raw = np.frombuffer(text.as_buffer(), np.uint8) if len(text.as_buffer()) else np.empty(0, np.uint8)
                starts, ends, kept, left, holders = [], [], None, raw, held.get(row_no.as_py())
                if holders is not None and len(marks):
                    own = NO_ID if not doc_id.is_valid else doc_id.as_py()
                    mine = unpack(holders.as_py(), HOLDER)
                    change = None
                    for begin in range(0, len(mine), STEP):
                        part = mine[begin : begin + STEP]
                        which, at = _matches(marks, part["entry"])
                        hit = marks["least"][which] < own
                        if hit.any():
                            which, place = which[hit], part["place"].astype(np.int64)[at[hit]]
                            change = np.zeros(len(raw) + 1, np.int32) if change is None else change
                            np.add.at(change, place + marks["from"][which], 1)
                            np.add.at(change, place + marks["to"][which] + LENGTH, -1)
                    if change is not None:
                        gone = np.cumsum(change[:-1], dtype=np.int32) > 0
                        edge = np.diff(np.concatenate(([0], gone, [0])).astype(np.int8))
                        starts, ends = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
                        left = raw[~gone]
                if with_text:
                    kept = left.tobytes().decode("utf-8", "ignore")
                for name, value in zip(out, (row_no.as_py(), doc_id.as_py(), len(raw), starts, ends, kept, hashlib.sha256(left.tobytes()).hexdigest()), strict=True):
                    out[name].append(value)
        return pa.table({f.name: pa.array(out[f.name], f.type) for f in CUT}, schema=CUT)

    return work


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of docs: row_no, doc_id, n_bytes, starts, ends (byte spans removed), kept (with_text), kept_sha256.

    A byte goes if a LENGTH-byte string over it also starts in a document with a smaller id; strings are judged on the
    input. Null text counts as empty; a null id is smaller than every other; rows with the same id remove nothing from
    each other; an empty table gives no rows. kept is the rest as text, without the bytes of characters that a span has
    cut in two; kept_sha256 is of the remaining bytes as they are.
    """
    own = chosen(docs, doc_id=id_col, text=text_col).select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id").cast("bigint"), text_or_empty("text").alias("text"))
    size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = _bucketed(own.select(_run().alias("run"), "row_no", "doc_id", "text"), size)
    hash_buckets = max(1, -(-2 * size // ((REACH + 2) * HASHES_PER_BUCKET)))
    hashed = rows.select("run", "text").mapInArrow(_hash_runs(hash_buckets), _ddl(HASHED))
    answers = hashed.groupBy("bucket").applyInArrow(_answer, _ddl(ANSWERED))
    buckets = max(1, -(-size // TEXT_PER_RANGE))
    parts = -(-buckets // MOST_RANGES)
    bounds = docs.sparkSession.sparkContext.broadcast(_range_bounds(rows, min(buckets, MOST_RANGES), size))
    made = cut(rows.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_sort_run(bounds), _ddl(SORTED)), "suffixes")
    pieces = made.where("bucket IS NOT NULL").select("run", "bucket", "first", "prefixes", "lengths", "tails", "ids")
    if parts > 1:
        grouped = pieces.withColumn("joint", F.col("bucket") * parts + F.pmod(F.xxhash64("run"), F.lit(parts)))
        joint = cut(grouped.groupBy("joint").applyInArrow(_combine(parts), _ddl(COMBINED)), "joint")
        marks = joint.where("prefixes IS NOT NULL").select("run", "bucket", "first", "prefixes", "lengths", "tails", "ids").groupBy("bucket").applyInArrow(_merge, _ddl(MARKED))
        maps = joint.where("entries IS NOT NULL").select("run", "origin", "first", "entries")
        marks = maps.groupBy("run").cogroup(marks.groupBy("run")).applyInArrow(_spread, _ddl(MARKED))
    else:
        marks = pieces.groupBy("bucket").applyInArrow(_merge, _ddl(MARKED))
    held = made.where("holders IS NOT NULL").select("run", "row_no", "holders", F.lit(None).cast("binary").alias("marks"))
    found = held.unionByName(marks.select("run", F.lit(None).cast("bigint").alias("row_no"), F.lit(None).cast("binary").alias("holders"), "marks"))
    return rows.groupBy("run").cogroup(found.groupBy("run")).applyInArrow(_cut_run(with_text), _ddl(CUT))


def _run() -> Column:
    """Neighbours share a run of RUN_BYTES and RUN_ROWS at most; a longer document is a run of its own. Its number is that of its first row.

    Only row numbers and lengths go to Python; a task's rows come in the order of the scan, again if it is repeated.
    """

    @F.pandas_udf("bigint")
    def number(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        run, held, rows = -1, 0, RUN_ROWS
        for row_nos, lengths in batches:
            out = []
            for row_no, length in zip(row_nos.tolist(), lengths.tolist(), strict=True):
                if held + length > RUN_BYTES or rows >= RUN_ROWS:
                    run, held, rows = row_no, 0, 0
                held, rows = held + length, rows + 1
                out.append(run)
            yield pd.Series(out, dtype="int64")

    return number("row_no", F.octet_length("text"))


def _bucketed(rows: DataFrame, size: int) -> DataFrame:
    """The texts as a table bucketed by run in the shared folder: they meet what other tasks say of them without a shuffle of their own."""
    spark = rows.sparkSession
    buckets = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TEXT_PER_RANGE)), MOST_BUCKETS)
    path = fresh_path(spark, "texts")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    rows.write.option("path", path).option("compression", "zstd").bucketBy(buckets, "run").sortBy("run").saveAsTable(name)
    made = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # an external table: its files stay, and the plan knows where they are
    return made


def _range_bounds(rows: DataFrame, ranges: int, size: int) -> np.ndarray:
    """First bytes of suffixes that part the sorted order into ranges of like size, from a sample of bounded size."""
    if ranges < 2:
        return np.empty(0, f"S{HEAD}")

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            for text in batch.column(0):
                raw = text.as_buffer().to_pybytes()
                places = anchors(raw)[0]
                found.extend(SUFFIX + raw[a : a + HEAD - 1] for a in places[:: max(8, len(places) // 1000)].tolist())
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(found)], pa.binary())], names=["heads"])

    share = min(1.0, 8 * (REACH + 2) / 2 * HEADS / max(size, 1))
    joined = b"".join(r.heads for r in rows.select("text").sample(share, 1).mapInArrow(heads, "heads binary").toLocalIterator())
    found = np.sort(np.frombuffer(joined, f"S{HEAD}"))
    return np.unique(found[[len(found) * k // ranges for k in range(1, ranges)]]) if len(found) else found


def suffix_report(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    removed = F.aggregate(F.arrays_zip("starts", "ends"), F.lit(0).cast("bigint"), lambda n, s: n + s["ends"] - s["starts"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("bigint").alias("n_spans"), "kept_sha256")
