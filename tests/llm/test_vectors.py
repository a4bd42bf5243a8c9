"""Clustering and top-k search against plain numpy over all vectors."""

import hashlib

import numpy as np
import pytest
from compare import SF, same
from eventloom.llm import top_k as t
from eventloom.llm.clustering import clustering_report, delta_lloyd, seeds
from eventloom.llm.queries import ORACLES, QUERIES
from eventloom.llm.vectors import whole_vectors
from pyspark.sql import functions as F

NAN, INF = float("nan"), float("inf")


def vectors(spark, rows):
    """Rows (vec_id, embedding) with columns named like the operators' own."""
    return spark.createDataFrame([(i, v, 1, "x", 2.0, None) for i, v in rows], "vec_id long, embedding array<float>, no int, q string, score double, cluster int").repartition(3)


def whole(spark, rows):
    return whole_vectors(vectors(spark, rows), "vec_id", "embedding")


def random_rows(n, size=6, seed=0, ids=None):
    rng = np.random.default_rng(seed)
    out = rng.normal(0, 0.2, (n, size)).astype(np.float32)
    return [(i if ids is None else ids[i], [float(x) for x in v]) for i, v in enumerate(out)]


def plain_lloyd(rows, k, rounds):
    kept = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v in rows]
    order = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v.tolist()) for i, v in kept if i is not None)
    c = np.array([v for _, v in order[:k]])
    assign = lambda: [min((int(((v - m) ** 2).sum()), n) for n, m in enumerate(c)) for _, v in kept]
    for _ in range(rounds):
        own = [n for _, n in assign()]
        for n in range(len(c)):
            of = [v for (_, v), o in zip(kept, own, strict=True) if o == n]
            if of:
                c[n] = [int(x) // len(of) for x in np.sum(of, 0)]
    last = assign()
    total = sum(d for d, _ in last)
    return sorted((-1 if i is None else i, n, d, sum(e for e, m in last if m == n), total, hashlib.sha256(",".join(map(str, c[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, last, strict=True))


def plain_top(rows, k=20, every=20):
    v = [(i, [int(np.floor(64 * float(x))) for x in q]) for i, q in rows]
    out = []
    for a, (i, q) in enumerate(v):
        if i is not None and i % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(q, p, strict=False)), j is None, j or 0, j) for b, (j, p) in enumerate(v) if a != b)
            out += [(i, r + 1, -1 if s[3] is None else s[3], -s[0]) for r, s in enumerate(scored[:k])]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, -1 if r.vec_id is None else r.vec_id, r.score) for r in df.collect())


def clustered(df):
    return sorted(tuple(-1 if x is None else x for x in r) for r in df.collect())


ODD = [(1, None), (2, []), (3, [1.0, NAN]), (4, [1.0, None]), (5, [INF, 0.0]), (6, [-INF]), (None, [0.5, 0.25]), (40, [0.5, -0.25]), (8, [-0.0, 0.999])]


def test_integers(spark):
    got = {r.vec_id: r.q for r in whole(spark, [*ODD, (9, [-0.01, 0.51])]).collect()}
    assert got == {2: [], None: [32, 16], 40: [32, -16], 8: [0, 63], 9: [-1, 32]}
    with pytest.raises(Exception, match="2\\^20"):
        whole(spark, [(1, [float(1 << 20)])]).collect()


@pytest.mark.parametrize("seed", [0, 1])
def test_rounds_equal_plain_lloyd(spark, seed):
    rows = random_rows(300, seed=seed) + [(7, [0.1] * 6)] * 150 + [(None, [0.3] * 6)] * 2 + random_rows(5, seed=seed)
    for rounds in (0, 1, 6):
        made = delta_lloyd(whole(spark, rows), 6, 5, rounds)
        assert clustered(clustering_report(made)) == plain_lloyd(rows, 5, rounds)
    assert made.compared[0] == 5 and len(made.compared) == len(made.moved) == 7


def test_only_moved_centroids_are_compared(spark):
    # Two far groups: one has settled from the beginning, the other goes on moving.
    ids = sorted(range(200), key=lambda i: hashlib.sha256(f"1:{i}".encode()).hexdigest())
    rows = [(ids[0], [9.0, 9.0])] + [(ids[k], [x, 0.0]) for k, x in enumerate(np.linspace(0, 3, 60).tolist(), 1)]
    made = delta_lloyd(whole(spark, rows), 2, 4, 5)
    assert clustered(clustering_report(made)) == plain_lloyd(rows, 4, 5)
    assert made.compared[0] == 4 and max(made.compared[1:]) <= 3 and made.moved[0] == 61 and max(made.moved[1:]) < 61


def test_few_and_no_vectors(spark):
    assert clustered(clustering_report(delta_lloyd(whole(spark, random_rows(3)), 6))) == plain_lloyd(random_rows(3), 16, 3)
    for rows in ([], [(None, [0.5] * 6)]):
        assert clustering_report(delta_lloyd(whole(spark, rows).where("vec_id IS NOT NULL OR true"), 6)).count() == 0


def test_seeds_take_equal_rows(spark):
    assert seeds(whole(spark, [(3, [0.5]), (3, [0.25]), (None, [0.1])]), 4, "1") == [[16], [32]]


@pytest.mark.parametrize(("block", "chunk"), [(1 << 16, 128), (64, 3), (7, 2)])
def test_top_k(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(t, "BLOCK", block)
    monkeypatch.setattr(t, "CHUNK", chunk)
    kept = [r for r in ODD if r[0] in (2, 40, 8, None)]
    # A third are copies; ids repeat, among them a query's.
    rows = random_rows(150) + [(1000 + i, [0.25] * 6) for i in range(70)] + [(20, [0.1, -0.9])] * 2 + [(None, [0.25] * 6)] * 2 + kept
    assert found(t.top_k(whole(spark, rows + [r for r in ODD if r not in kept]))) == plain_top(rows)


def test_top_k_of_few_and_none(spark):
    assert found(t.top_k(whole(spark, [(0, [1.0]), (1, [1.0])]))) == [(0, 1, 1, 4096)]
    assert found(t.top_k(whole(spark, [(0, []), (20, []), (3, [])]))) == [(0, 1, 3, 0), (0, 2, 20, 0), (20, 1, 0, 0), (20, 2, 3, 0)]
    for rows in ([], [(1, [1.0])], [(0, [1.0])]):
        assert t.top_k(whole(spark, rows)).count() == 0


def test_bitmaps_add_up():
    rng = np.random.default_rng(2)
    for high in (1, 3, 1000, 1 << 26):
        v = rng.integers(-high, high + 1, (130, 9))
        import pyarrow as pa

        index = t._index(pa.table({"block": pa.array([0] * 130, pa.int64()), "no": pa.array(range(130), pa.int64()), "vec_id": pa.array(range(130), pa.int64()), "q": pa.array(list(v), pa.list_(pa.int64()))}))
        block = t.block_of(index)
        for q in (v[0].tolist(), [0] * 9, [-high] * 9, v[1, :4].tolist()):
            places, scores = block.top(q, 130, None)
            wide = np.array(q + [0] * (9 - len(q)))
            want = [int(sum(int(a) * int(b) for a, b in zip(wide, x, strict=True))) for x in v]
            assert [(int(s), int(p)) for p, s in zip(places, scores, strict=True)] == sorted(((w, p) for p, w in enumerate(want)), key=lambda x: (-x[0], x[1]))


@pytest.mark.parametrize("name", ["op12_clustering", "op13_top_k"])
@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_registered(spark, name, sf):
    same(spark, QUERIES[name], ORACLES[name], sf)


def test_op12_leaves_out_other_sizes(spark, tmp_path):
    folder = str(tmp_path)
    rows = random_rows(40, 64) + [(100, [0.5] * 63), (101, None), (102, [0.1] * 63 + [NAN])]
    vectors(spark, rows).write.parquet(f"{folder}/embeddings.parquet")
    assert clustered(QUERIES["op12_clustering"](spark, folder)) == plain_lloyd(rows[:40], 16, 3)
    assert found(QUERIES["op13_top_k"](spark, folder).where(F.col("query_id") == 0)) == [r for r in plain_top(rows[:41]) if r[0] == 0]


def test_top_k_searches_copies_once(spark, monkeypatch):
    kept, cut = {}, t.cut
    monkeypatch.setattr(t, "cut", lambda df, name, *more: kept.setdefault(name, cut(df, name, *more)))
    rows = [(i, v) for i, (_, v) in enumerate(random_rows(10) * 60)]
    assert found(t.top_k(whole(spark, rows))) == plain_top(rows)
    assert kept["index"].agg(F.sum(F.size("no"))).first()[0] <= 10 * 21
