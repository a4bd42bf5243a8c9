"""Spelling variants against all pairs of words, and the counts behind them against a plain loop."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import SF, same
from eventloom.llm import spelling as s
from eventloom.llm.queries import ORACLES, QUERIES
from helpers import LOW, docs, empty
from pyspark.sql import functions as F


def counted(texts, ids, typo_every=199):
    found = Counter()
    for i, text in zip(ids, texts, strict=True):
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if typo_every and h % typo_every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts):
    others = {w: [x for x in counts if near(w, x)] for w in counts}
    best = {w: min(o, key=lambda x: (-counts[x], x), default=None) for w, o in others.items()}
    form = {w: b if b and counts[b] >= 5 * counts[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), counts[w], len(others[w]), counts[form[w]] if form[w] else -1) for w in counts)


def rows(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


def of(spark, counts):
    return s.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3))


def test_counts_with_odd_rows(spark):
    texts = ["Grüßen GRÜSSEN grüßen-grüßen éclair×÷ çedille", None, "", " 12 ", "naïveté NAÏVETé " * 700, "word words " * 900, "x" * 5000, "ab", "Grüßen " * 40]
    ids = [5, 1, 2, 3, None, 7, 7, 9, -4]
    texts, ids = texts + texts[:1] * 6, ids + ids[:1] * 6
    for every in (None, 1, 3, 199):
        got = {r.word: r.n for r in s.word_counts(docs(spark, texts, ids), every).collect()}
        assert got == counted(texts, ids, every)
    assert s.word_counts(empty(spark)).count() == 0


def test_all_pairs_ties_and_chains(spark):
    rng = np.random.default_rng(3)
    words = {"".join(rng.choice(list("abé"), rng.integers(4, 9))) for _ in range(400)}
    counts = {w: int(5 ** rng.integers(1, 6)) for w in words}
    counts |= {"chainaa": 5, "chainab": 25, "chainbb": 125, "chainbbb": 625, "tieaaa": 100, "tieaab": 500, "tieaac": 500, "aaaaaaaa": 9, "aaaaaaa": 45}
    want = brute(counts)
    assert rows(of(spark, counts)) == want
    by = {r[0]: r for r in want}
    assert by["chainaa"][2] == "chainbbb" and by["tieaaa"][1] == "tieaab"


def test_empty(spark):
    assert of(spark, {"alone": 7}).collect()[0].root == "alone"
    assert s.spelling_variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_very_long_words(spark):
    rng = np.random.default_rng(5)
    long = "".join(rng.choice(list("abcdefghij"), 200_000))
    counts = {long: 50, long[:77] + long[78:]: 5, long[:99] + "z" + long[100:]: 10, long[:-2]: 7, "x" * 300_000: 6, "x" * 299_999: 60}
    got = {r.word: r for r in of(spark, counts).collect()}
    assert got[long].n_near == 2 and got[long[:77] + long[78:]].form == long and got[long[:-2]].n_near == 0
    assert got["x" * 300_000].form == "x" * 299_999 and got[long[:99] + "z" + long[100:]].root == long


def test_hashes_of_deletions():
    words = ["abca", "aab", "b", "ééa"]
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    whole, left, owner, at = s._hashes(points, np.array([len(w) for w in words]))
    plain = lambda w: sum((ord(c) + 1) * pow(s.FACTOR, i, 1 << 64) for i, c in enumerate(w)) % (1 << 64)
    assert whole.tolist() == [plain(w) for w in words]
    for k, w in enumerate(words):
        assert set(left[owner == k].tolist()) == {plain(w[:i] + w[i + 1 :]) for i in range(len(w))}
        assert all(plain(w[:i] + w[i + 1 :]) == h for i, h in zip(at[owner == k].tolist(), left[owner == k].tolist(), strict=True))
        assert (owner == k).sum() == len({w[:i] + w[i + 1 :] for i in range(len(w))})


def test_roots_double(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)], "no long, to long")
    assert {tuple(r) for r in s.roots(links).collect()} == {(i, 20) for i in range(20)}


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_op11(spark, sf):
    same(spark, QUERIES["op11_spelling"], ORACLES["op11_spelling"], sf)


def test_op11_counts(spark):
    got = QUERIES["op11_spelling"](spark, SF).select("word", "n")
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where(F.lit(True)).collect()
    assert {r.word: r.n for r in got.collect()} == counted([r.text for r in texts], [r.doc_id for r in texts])
