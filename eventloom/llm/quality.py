"""Quality classifier: random Fourier features over document statistics, ridge by normal equations, isotonic scores.

Statistics come from whole texts, never from ids, language or source. Each partition sums its share of the normal
equations; a tree of tasks, each with a few sums, adds these up until some small matrices are left for the driver,
whatever the number of rows. All labelled training rows take part; none are sampled.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chosen, cut, map_rows, place_of

#: Random features, their seed, the kernel's width in standard deviations, and the ridge penalty for each row.
FEATURES, SEED, WIDTH, RIDGE = 256, 7, 3.0, 1e-4
#: Places where raw scores are counted before calibration.
SCORE_BINS = 4096
THRESHOLD = 0.3
#: Sums that one task adds up, and that reach the driver at most.
FAN_IN = 16

_UPPER, _DIGIT = string.ascii_uppercase.encode(), string.digits.encode()
_LETTER = string.ascii_letters.encode() + bytes(range(0x80, 0x100))
_STOPS, _MARKS = b".,;:?", b"!#$%&*|@^~<>=+_/\\{}[]"
STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digits", "letters", "stops", "marks", "line_ends", "space",
    "distinct_words", "top_word", "same_as_before", "plain_words", "title_words", "upper_words", "distinct_lines", "log_line", "long_words",
)


def statistics(text: str) -> list[float]:
    """One number for each of STATISTICS; 0 throughout for an empty text."""
    raw = text.encode()
    n = len(raw)
    if not n:
        return [0.0] * len(STATISTICS)
    share = lambda of: (n - len(raw.translate(None, of))) / n
    words, lines = text.split(), text.split("\n")
    w = max(1, len(words))
    counts = Counter(words)
    often = len(words)
    return [
        math.log1p(n), math.log1p(len(words)), min(40.0, sum(map(len, words)) / w), share(_UPPER), share(_DIGIT), share(_LETTER), share(_STOPS), share(_MARKS),
        raw.count(b"\n") / w, raw.count(b" ") / n,
        # The share of distinct words falls with length; its logarithm against that of the length does so much less.
        math.log1p(len(counts)) / math.log1p(often) if often else 0.0,
        max(counts.values()) / w if counts else 0.0,
        sum(map(str.__eq__, words, words[1:])) / w,
        sum(map(str.isalpha, counts)) / max(1, len(counts)), sum(map(str.istitle, counts)) / max(1, len(counts)), sum(map(str.isupper, counts)) / max(1, len(counts)),
        len(set(lines)) / len(lines), math.log1p(n / len(lines)), sum(len(x) > 20 for x in counts) / max(1, len(counts)),
    ]


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return lift((x - self.mean) / self.scale) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.knots, self.levels) if len(self.knots) else np.full(len(x), 0.5)


def lift(x: np.ndarray) -> np.ndarray:
    """Standardised statistics, cosines of random projections (a Gaussian kernel's features), the statistics, and 1."""
    x = np.clip(x, -6.0, 6.0)
    rng = np.random.default_rng(SEED)
    turn = rng.normal(size=(x.shape[1], FEATURES)) / WIDTH
    phase = rng.uniform(0, 2 * np.pi, FEATURES)
    return np.hstack([np.sqrt(2.0 / FEATURES) * np.cos(x @ turn + phase), x / 10.0, np.ones((len(x), 1))])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and x (array of STATISTICS) for every row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [statistics(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return chosen(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, x array<double>")


def held_out(id_col: str = "doc_id"):
    """Rows that are never learnt from: crc32 of the id as text is a multiple of 5. A null id counts as ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def fit(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> QualityModel:
    """A model from rows (doc_id, x) and labels 0 or 1; rows held out, and labels that are null or neither, teach nothing.

    Repeated labels of a row each count. Without labels of both kinds every score is the share of 1 (0.5 without labels).
    """
    width = len(STATISTICS)
    known = chosen(labels, doc_id=id_col, y=label_col).where(F.col("y").isin(0, 1)).select(F.col("doc_id").cast("bigint"), F.col("y").cast("double"))
    train = cut(rows.join(known.where(~held_out()), "doc_id").select("x", "y"), "train")
    sums = train.agg(F.count(F.lit(1)), F.avg("y"), *[F.avg(F.col("x")[k]) for k in range(width)], *[F.stddev_pop(F.col("x")[k]) for k in range(width)]).first()
    n, share = sums[0], sums[1]
    if not n or share in (0.0, 1.0):
        level = 0.5 if not n else share
        return QualityModel(np.zeros(width), np.ones(width), np.zeros(FEATURES + width + 1), np.array([0.0]), np.array([level]))
    mean, scale = np.array(sums[2 : 2 + width]), np.array(sums[2 + width :])
    scale[scale < 1e-9] = 1.0
    size = FEATURES + width + 1

    def sums(place: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["place", "sums"])

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                total = np.zeros((size, size + 1)) if total is None else total
                part = batch.slice(at, 4096)
                z = lift((_matrix(part.column(0), width) - mean) / scale)
                y = part.column(1).to_numpy(zero_copy_only=False)
                total += z.T @ np.column_stack([z, y])
        if total is not None:
            yield sums(TaskContext.get().partitionId() // FAN_IN, total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            for one in batch.column(1):
                total += np.frombuffer(one.as_buffer()).reshape(size, size + 1)
        yield sums(TaskContext.get().partitionId() // FAN_IN, total)

    shape = "place int, sums binary"
    made, tasks = train.mapInArrow(equations, shape), train.rdd.getNumPartitions()
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        made = made.repartitionById(tasks, F.col("place")).mapInArrow(add, shape)
    parts = made.collect()
    total = sum(np.frombuffer(r.sums).reshape(size, size + 1) for r in parts)
    penalty = np.full(size, RIDGE * n)
    penalty[-1] = 0.0
    beta = np.linalg.solve(total[:, :size] + np.diag(penalty + 1e-9 * n), total[:, size])
    model = QualityModel(mean, scale, beta, np.array([]), np.array([]))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((SCORE_BINS, 2))
        for batch in batches:
            at = score_bin(model.raw(_matrix(batch.column(0), width)))
            np.add.at(count, at, np.column_stack([np.ones(len(at)), batch.column(1).to_numpy(zero_copy_only=False)]))
        here = np.flatnonzero(count[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(here, pa.int32()), pa.array(count[here, 0]), pa.array(count[here, 1])], names=["bin", "n", "good"])

    counted = train.mapInArrow(binned, "bin int, n double, good double").groupBy("bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).orderBy("bin").collect()
    model.knots, model.levels = isotonic([(r.bin + 0.5) / SCORE_BINS * 2 - 0.5 for r in counted], [r.n for r in counted], [r.good for r in counted])
    return model


def score_bin(raw: np.ndarray) -> np.ndarray:
    return np.clip((raw + 0.5) / 2 * SCORE_BINS, 0, SCORE_BINS - 1).astype(np.int64)


def isotonic(at: list[float], n: list[float], good: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """Pools neighbours until their shares rise; one knot for each pool, at its mean place, each share drawn in by one row of either kind."""
    pools: list[list[float]] = []
    for x, w, g in zip(at, n, good, strict=True):
        pools.append([x * w, w, g])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] >= pools[-1][2] / pools[-1][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    knots = np.array([p[0] / p[1] for p in pools])
    levels = np.maximum.accumulate(np.array([(p[2] + 0.5) / (p[1] + 1.0) for p in pools]))
    return knots, levels


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs, nulls, empty texts and repeated rows included.

    A null or empty text has statistics of zero and gets the score that these have; rows with a null id are scored and
    never teach; an empty table gives no rows, and one without labels a score of 0.5 throughout.
    """
    rows = cut(document_statistics(docs, id_col, text_col), "statistics")
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, id_col, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.value.score(_matrix(batch.column(1), len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_rejected(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows whose score reaches the threshold, with their own columns, whatever these are called; texts are not shuffled.

    Null and empty texts are scored like all others, rows that repeat share their fate, null ids never teach; an empty
    table stays empty, and without labels every row stays (its score is 0.5).
    """
    rows = document_statistics(docs, id_col, text_col)
    # Fitting joins statistics, a few numbers a row, with labels; texts are read again to be scored where they are.
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, id_col, label_col))
    place = place_of(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([statistics(t.as_py() or "") for t in batch.column(place)])
                yield batch.filter(pa.array(model.value.score(x) >= threshold))

    return map_rows(docs, run)
