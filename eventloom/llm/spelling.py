"""Spelling variants by a symmetric-delete join: words at distance one meet in a string that a deletion leaves of both.

Every word gives itself and its distinct single deletions as keys. Two words at distance one share a key: the shorter one
itself, or what is left of both without the replaced letter. Keys are 64-bit hashes of the strings, so a word of
a million letters gives a million numbers and not a million strings; whatever meets in a key is verified on the words,
in time linear in their length: the places that were deleted tell where two words may differ.
At most one word more than there are letters to put in and places to put them shares a key, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, chosen, cut

RUN = "[A-Za-zÀ-ÿ]+"
#: A word counts from so many letters and occurrences on; its form has so many times its occurrences at least.
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
#: Letters that are hashed at once, and an odd factor with its inverse modulo 2^64.
LETTERS, FACTOR = 1 << 20, 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)


def word_counts(docs: DataFrame, typo_every: int | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z lower-cased, that are long and frequent enough.

    With typo_every, a run loses a letter where that number divides the CRC-32 of '<doc_id>:<run>'; the place is the CRC modulo
    the run's length. Null texts have no words, a null doc_id is written as nothing; rows that repeat count each time.
    """
    rows = chosen(docs, doc_id="doc_id", text="text")
    runs = rows.select("doc_id", F.explode(F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(RUN), F.lit(0))).alias("word"))
    # Nothing makes a run longer, so the short ones go before anything is computed for them.
    long = runs.where(F.length("word") >= least_length)
    if typo_every:
        crc, size = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word"))), F.length("word")
        at = (F.col("crc") % size).cast("int")
        typo = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, size))
        long = long.withColumn("crc", crc).select(F.when(F.col("crc") % typo_every == 0, typo).otherwise(F.col("word")).alias("word")).where(F.length("word") >= least_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _hashes(points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of words laid end to end: their own hashes, the hashes of their distinct single deletions, and whose and where each of these is."""
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(points)) - starts[owner]
    powers = np.ones(int(sizes.max(initial=0)) + 1, np.uint64)
    powers[1:] = np.uint64(FACTOR)
    powers = np.cumprod(powers)  # uint64 arithmetic is modulo 2^64 throughout
    terms = (points.astype(np.uint64) + np.uint64(1)) * powers[at]
    upto = np.cumsum(terms, dtype=np.uint64)
    before = upto - terms
    head = before - before[starts][owner]
    whole = upto[starts + sizes - 1] - before[starts]
    left = head + (whole[owner] - head - terms) * np.uint64(INVERSE)
    # Of equal letters in a row, all deletions leave the same string; the first stands for them.
    first = (at == 0) | (points != np.concatenate(([0], points[:-1])))
    return whole, left[first], owner[first], at[first]


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        numbers, words = batch.column(0).to_numpy(), batch.column(1)
        sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(sizes) // LETTERS
        for k in np.unique(piece):
            lo, hi = np.searchsorted(piece, k), np.searchsorted(piece, k, "right")
            points = np.frombuffer("".join(words.slice(lo, hi - lo).to_pylist()).encode("utf-32-le"), np.uint32)
            whole, left, owner, at = _hashes(points, sizes[lo:hi])
            own = numbers[lo:hi]
            columns = [np.concatenate((whole, left)).view(np.int64), np.concatenate((own, own[owner])), np.concatenate((np.full(len(own), -1), at)).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "no", "at"])


def near_words(words: DataFrame) -> DataFrame:
    """(a, b): numbers of the words (no, word; a table that is cheap to read) at distance one, each pair once with a < b.

    Two words that differ in one letter differ at the later of the two places (the first one of a row of equal letters
    stands for all), so a pair is verified through one of its keys only and needs no distinct.
    """
    keys = words.select("no", "word").mapInArrow(_keys, "key long, no long, at int")
    met = keys.toDF("key", "a", "i").join(keys.toDF("key", "b", "j"), "key").where("a < b AND i + j > -2").drop("key")
    left, right = words.select(F.col("no").alias("a"), F.col("word").alias("x")), words.select(F.col("no").alias("b"), F.col("word").alias("y"))
    without = lambda word, at: F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))
    p = F.greatest("i", "j")
    replaced = (F.length("x") == F.length("y")) & (without(F.col("x"), p) == without(F.col("y"), p)) & (F.col("x") != F.col("y"))
    one_more = F.when(F.col("j") < 0, without(F.col("x"), F.col("i")) == F.col("y")).when(F.col("i") < 0, without(F.col("y"), F.col("j")) == F.col("x")).otherwise(replaced)
    return met.join(left, "a").join(right, "b").where(one_more).select("a", "b")


def spelling_variants(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a table of distinct words (word, n).

    n_near counts the words at distance one. form is the one of these with largest n (then the smallest in code-point order)
    if that is ratio times the word's n at least, else null; root follows forms to the last. No words give no rows.
    """
    words = cut(counts.select(F.monotonically_increasing_id().alias("no"), "word", F.col("n").cast("long").alias("n")), "words")
    pairs = cut(near_words(words), "near")
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("no").alias("b"), F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"), F.col("no").alias("no")).alias("at"))
    best = ends.join(other, "b").groupBy(F.col("a").alias("no")).agg(F.count(F.lit(1)).alias("n_near"), F.min("at").alias("best"))
    fit = -F.col("best.less") >= ratio * F.col("n")
    judged = words.join(best, "no", "left").select(
        "no", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fit, F.col("best.word")).alias("form"), F.when(fit, -F.col("best.less")).alias("form_n"), F.when(fit, F.col("best.no")).alias("form_no")
    )
    judged = cut(judged, "forms")
    ends_at = roots(judged.where("form_no IS NOT NULL").select("no", F.col("form_no").alias("to")))
    named = ends_at.join(words.select(F.col("no").alias("to"), F.col("word").alias("root")), "to").select("no", "root")
    return judged.join(named, "no", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def roots(links: DataFrame) -> DataFrame:
    """(no, to): where a chain of links (no, to; at most one from each no, no circles) ends. Each round doubles the steps that all have made.

    A step multiplies n by the ratio, so chains have some ten links at most and rounds are few, whatever the size.
    """
    now = cut(links, "roots")
    while True:
        further = now.select(F.col("no").alias("to"), F.col("to").alias("__to"))
        following = cut(now.join(further, "to", "left").select("no", F.coalesce("__to", "to").alias("to"), F.col("__to").isNotNull().alias("moved")), "roots")
        now = following.select("no", "to")
        if following.where("moved").isEmpty():
            return now
