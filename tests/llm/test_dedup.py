import hashlib
import random
import re
from pathlib import Path

import eventloom.llm.suffix_dedup as sd
import pytest
import xxhash
from compare import SF, same
from eventloom.llm.components import components
from eventloom.llm.exact_dedup import drop_exact_copies, exact_dedup
from eventloom.llm.queries import ORACLES, QUERIES
from eventloom.llm.simhash import drop_near_copies, fingerprint, near_copies
from helpers import LOW, TEXTS, docs, empty
from pyspark.sql import functions as F


# Exact copies.
def test_exact_copies(spark):
    texts, ids = ["A", "a", "b", None, "", "É", "é", "b"], [1, 9, 3, 4, 5, 6, 7, None]
    got = {(r.doc_id, r.digest.hex()): (r.keep_id, r.group_size, r.kept) for r in exact_dedup(docs(spark, texts, ids)).collect()}
    d = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {
        (1, d("a")): (9, 2, False), (9, d("a")): (9, 2, True), (3, d("b")): (3, 2, True), (None, d("b")): (3, 2, False), (4, d("")): (5, 2, False), (5, d("")): (5, 2, True), (6, d("É")): (6, 1, True), (7, d("é")): (7, 1, True),
    }


@pytest.mark.parametrize("heavy_items", [1, 1000])
def test_exact_copies_with_ties_and_hot_groups(spark, heavy_items):
    texts = ["hot"] * 200 + [f"t{i % 50}" for i in range(200)]
    df = docs(spark, texts, [i % 120 for i in range(400)])
    rows = exact_dedup(df, heavy_items=heavy_items, counters=max(2, heavy_items)).collect()
    assert len(rows) == 400 and sum(r.kept for r in rows) == 51 and {r.group_size for r in rows} == {200, 4}
    kept = drop_exact_copies(df)
    assert kept.count() == 51 and kept.columns == df.columns
    assert exact_dedup(empty(spark)).count() == 0 and drop_exact_copies(empty(spark)).count() == 0


def test_exact_query(spark):
    same(spark, QUERIES["op6_exact_dedup"], ORACLES["op6_exact_dedup"])


# Near copies.
def print_of(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints):
    """Smallest id reachable, by all pairs."""
    low = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a, x in prints.items():
            for b, y in prints.items():
                if (x ^ y).bit_count() <= 2 and low[b] < low[a]:
                    low[a], changed = low[b], True
    return low


def test_fingerprints():
    for t in TEXTS:
        assert fingerprint(t or "") % (1 << 64) == print_of(t)


def test_near_copies_against_all_pairs(spark, monkeypatch):
    import eventloom.llm.simhash as sh

    r = random.Random(4)
    prints = {}
    for i in range(400):
        f = r.choice(list(prints.values())) if prints and r.random() < 0.6 else r.getrandbits(64)
        for _ in range(r.randint(0, 3)):
            f ^= 1 << r.randrange(64)
        prints[i] = f
    prints |= {400: 0, 401: 0, 402: 3, 403: (1 << 64) - 1, 404: (1 << 63) - 1, 405: 7}
    rows = spark.createDataFrame([(i, f - (1 << 64) if f >> 63 else f) for i, f in prints.items()], "doc_id long, fp long").repartition(3)
    got = {x.doc_id: x.component_id for x in sh.classify(rows).collect()}
    assert got == classes(prints)


def test_near_copies_of_odd_rows(spark):
    base = " ".join(f"w{i}" for i in range(300))
    texts = [*TEXTS, base, base + " end", base.upper(), base]
    got = {r.doc_id: r for r in near_copies(docs(spark, texts)).collect()}
    prints = {i: print_of(t) for i, t in enumerate(texts)}
    assert {i: r.fp % (1 << 64) for i, r in got.items()} == prints and {i: r.component_id for i, r in got.items()} == classes(prints)
    df = docs(spark, ["a b c", "a b c", "a b c", base], [None, None, 5, 5])
    assert {(r.doc_id, r.component_id) for r in near_copies(df).collect()} == {(None, 5), (5, 5)}
    kept = drop_near_copies(docs(spark, texts))
    assert kept.columns == docs(spark).columns and kept.count() == len(set(classes(prints).values()))
    assert near_copies(empty(spark)).count() == 0 and drop_near_copies(empty(spark)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 205), (205, 203)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and got[101] == 100 and got[205] == got[203] == 200
    star = components(spark.createDataFrame([(i, 1000) for i in range(300)], "a long, b long"))
    assert {r.component for r in star.collect()} == {0}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# Repeated strings.
def brute(rows):
    first, out = {}, []
    key = lambda i: sd.NO_ID if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            w = b[p : p + 50]
            first[w] = min(first.get(w, key(i)), key(i))
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < key(i):
                gone[p : p + 50] = b"\1" * 50
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(x for x, y in zip(b, gone, strict=True) if not y)).hexdigest()))
    return sorted(out, key=str)


def spans(df, **how):
    return sorted((tuple(r) for r in sd.suffix_report(sd.repeated_spans(df, **how)).collect()), key=str)


@pytest.fixture()
def small(monkeypatch):
    for name, value in (("RUN_ROWS", 32), ("RUN_BYTES", 6000), ("TEXT_PER_RANGE", 3000), ("HASHES_PER_BUCKET", 500), ("MOST_RANGES", 3), ("HOT_RUNS", 6)):
        monkeypatch.setattr(sd, name, value)


def test_repeats_against_brute_force(spark, small):
    r = random.Random(2)
    base = ["".join(r.choice("abé ") for _ in range(r.randint(0, 200))) for _ in range(12)]
    rows = []
    for i in range(250):
        t = "".join(r.choice(base)[r.randint(0, 30) :][: r.randint(0, 160)] for _ in range(r.randint(0, 4)))
        rows.append((r.choice([i, i, i, None, 7]), r.choice([t, t, t, t, None, "x" * r.randint(40, 200)])))
    assert spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == brute(rows)


def test_runs_are_bounded_by_bytes(spark, small):
    rows = [(i, "é" * r) for i, r in enumerate([0, 10, 90, 100, 1500, 1600, 2999, 3001, 50_000] * 40)]
    df = spark.createDataFrame(rows, "row_no long, text string").coalesce(2).select(sd._run().alias("run"), "text").groupBy("run").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    runs = df.collect()
    assert all(r.bytes <= sd.RUN_BYTES and r.n <= sd.RUN_ROWS or r.n == 1 for r in runs) and len(runs) < 250


def test_repeats_in_few_very_long_texts(spark):
    long = "".join(random.Random(3).choices("abcdefgh ", k=3_000_000))
    rows = [(1, long), (2, "x" + long[:2_000_000]), (3, "short " + long[5:80])]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in sd.suffix_report(sd.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got == {1: (0, 0), 2: (2_000_000, 1), 3: (75, 1)}


REPETITIVE = {"one": "x", "two": "ab", "thirty": "a line of thirty bytes, again\n", "seventy": "a line that is longer than the strings that are looked for, again.\n!!"}


@pytest.mark.parametrize("unit", REPETITIVE.values(), ids=REPETITIVE)
def test_repeats_in_long_repetitive_texts(spark, unit):
    text = (unit * (1_200_000 // len(unit)))[:1_200_000]
    rows = [(2, text), (1, "before " + text[:900_000]), (5, text[17:400_017]), (4, None), (9, unit)]
    assert spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)) == brute(rows)


@pytest.mark.parametrize("unit", REPETITIVE.values(), ids=REPETITIVE)
def test_memory_of_repetitive_runs(unit):
    """Two documents of 12 MB in one run, through each step that sees whole texts, within 1 GB."""
    import subprocess
    import sys

    code = f"""
import resource, types, numpy as np, pyarrow as pa
from eventloom.llm import suffix_dedup as sd
unit = {unit!r}
texts = [(unit * (12_000_000 // len(unit) + 1))[:12_000_000] for _ in range(2)]
docs = pa.table({{"run": pa.array([0, 0], pa.int64()), "row_no": pa.array([0, 1], pa.int64()), "doc_id": pa.array([5, 6], pa.int64()), "text": pa.array(texts)}})
del texts
hashed = pa.Table.from_batches(sd._hash_runs(1)(docs.select(["run", "text"]).to_batches()))
answers = sd._answer(hashed)
made = sd._sort_run(types.SimpleNamespace(value=np.empty(0, f"S{{sd.HEAD}}")))(docs, answers)
pieces = made.filter(made.column("bucket").is_valid())
marks = sd._merge(pieces).append_column("row_no", pa.nulls(1, pa.int64())).append_column("holders", pa.nulls(1, pa.binary()))
held = made.filter(made.column("holders").is_valid()).select(["run", "row_no", "holders"]).append_column("marks", pa.nulls(2, pa.binary()))
found = pa.concat_tables([held, marks.select(held.column_names)])
out = sd._cut_run(False)(docs, found).to_pylist()
assert [sum(r["ends"]) - sum(r["starts"]) for r in out] == [0, 12_000_000], out
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).resolve().parents[2], timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout) < 1000


def test_anchors_in_pieces(monkeypatch):
    r = random.Random(8)
    texts = [bytes(r.choice(b"abc ") for _ in range(r.randint(50, 900))) for _ in range(20)] + [b"x" * 333]
    whole = [sd.anchors(t) for t in texts]
    for piece in (1, 7, 26, 100):
        monkeypatch.setattr(sd, "PIECE", piece)
        for t, (places, hashes) in zip(texts, whole, strict=True):
            got = sd.anchors(t)
            assert got[0].tolist() == places.tolist() and got[1].tolist() == hashes.tolist()


def test_repeats_of_odd_rows(spark, small):
    texts = [*TEXTS, TEXTS[0] + " and more", "y" * 49, "y" * 50, "y" * 51]
    assert spans(docs(spark, texts)) == brute(list(enumerate(texts)))
    assert spans(empty(spark)) == []
    kept = {r.doc_id: r.kept for r in sd.repeated_spans(docs(spark, ["p" * 60, "q" + "p" * 60 + "é"]), with_text=True).collect()}
    assert kept == {0: "p" * 60, 1: "qé"}


def test_loser_tree():
    r = random.Random(9)
    for k in (1, 2, 3, 7, 16):
        runs = [sorted(bytes(r.choice(b"ab") for _ in range(r.randint(1, 6))) for _ in range(r.randint(0, 30))) for _ in range(k)]
        out = list(sd.LoserTree([sd.front_decode(*sd.front_code(run)) for run in runs]))
        assert [e for e, _, _ in out] == sorted(x for run in runs for x in run)
        for (a, _, _), (b, known, _) in zip(out, out[1:], strict=False):
            assert known == sd.common_prefix(a, b)


def test_every_string_has_its_anchor():
    r = random.Random(6)
    for _ in range(20):
        raw = bytes(r.choice(b"abc ") for _ in range(r.randint(50, 400)))
        places = set(sd.anchors(raw)[0].tolist())
        assert all(any(p in places for p in range(s, s + sd.REACH + 1)) for s in range(len(raw) - 49))


@pytest.mark.parametrize("name", ["op3_suffix_dedup", "op8_simhash"])
def test_queries(spark, name):
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
