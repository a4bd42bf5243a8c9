import hashlib
import random
import zlib

import numpy as np
import pytest
from eventloom.llm.bpe import BytePairCodec, bpe_round_trip
from eventloom.llm.queries import QUERIES, tokenizer_path
from eventloom.llm.token_file import EliasFano, TokenFile, to_file, token_file_round_trip
from helpers import TEXTS, docs, empty

PIECES = ["a", "b", " ", "  ", "\n", "\t", "\x00", "\xa0", "é", "'s", "'", "<|endoftext|>", "<|end", "12", "½", "。", "　", "\U0001f600", "​", "!!", "\x1c", "\x85", "The", "ll", "\r\n", "٣", "﻿"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_codec_equals_the_library(library):
    own, r = BytePairCodec.load(tokenizer_path()), random.Random(5)
    for _ in range(4000):
        text = "".join(r.choice(PIECES) for _ in range(r.randint(0, 14)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(own.encode(text)) == ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
    for ids in ([50256, 7], [161, 162], [220, 50256], []):
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_round_trip_of_odd_rows(spark, library):
    got = {r.doc_id: r for r in bpe_round_trip(docs(spark), tokenizer_path(), ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"), keep=("source",)).collect()}
    assert len(got) == len(TEXTS)
    for k, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[k].ids == ids and got[k].n_tokens == len(ids) and got[k].decoded == (text or "") and got[k].source == "src0"
        assert got[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert bpe_round_trip(empty(spark), tokenizer_path()).count() == 0
    assert bpe_round_trip(docs(spark, ["a", "a"], [None, 1]), tokenizer_path()).where("doc_id IS NULL").count() == 1


def test_elias_fano():
    r = random.Random(1)
    for n, top in ((0, 0), (1, 0), (1, 9), (64, 64), (65, 10_000), (500, 3), (1000, 1 << 33)):
        values = np.array(sorted(r.randint(0, top) for _ in range(n)), np.int64)
        coded = EliasFano.of(values, top)
        assert [coded.select(i) for i in range(n)] == values.tolist()
        assert len(coded.low) + len(coded.high) <= n * (max(1, top // max(1, n)).bit_length() + 2) / 8 + 2


def test_file_bytes():
    arrays = [np.array(x, "<u2").tobytes() for x in ([1, 2], [], [65535])]
    f = TokenFile(to_file(7, [5, None, -3], arrays, 2))
    assert (f.order, f.n, f.n_ids, f.doc_ids.tolist(), f.null.tolist()) == (7, 3, 3, [5, 0, -3], [False, True, False])
    assert [f.document(i).tolist() for i in range(3)] == [[1, 2], [], [65535]] and f.offset(3) == 3
    with pytest.raises(ValueError, match="not a token file"):
        TokenFile(b"x" * 100)


def check_files(rows, library, want):
    start, got = 0, sorted(((r.start, r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in rows), key=lambda r: r[0])
    assert len(got) == len(want)
    for (doc_id, text), row in zip(want, got, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        assert row == (start, doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_files_of_odd_rows(spark, library, monkeypatch):
    import eventloom.llm.token_file as tf

    monkeypatch.setattr(tf, "TEXT_PER_TASK", 3000)  # several ranges
    monkeypatch.setattr(tf, "IDS_PER_FILE", 500)  # and several files in some
    check_files(token_file_round_trip(docs(spark), tokenizer_path()).collect(), library, list(enumerate(TEXTS)))
    check_files(token_file_round_trip(docs(spark, ["z", None, "q", "q"], [4, None, 4, -1]), tokenizer_path()).collect(), library, [(None, None), (-1, "q"), *sorted([(4, "q"), (4, "z")], key=lambda x: np.array(library.encode(x[1]).ids, "<u2").tobytes())])
    assert token_file_round_trip(empty(spark), tokenizer_path()).count() == 0


def test_files_of_hot_ids(spark, library, monkeypatch):
    """Ids of very many rows, null among them, are spread over tasks, and the order is still that of ids."""
    import eventloom.llm.token_file as tf

    monkeypatch.setattr(tf, "TEXT_PER_TASK", 300)
    texts = [f"text {i} of it" for i in range(400)]
    ids = [None if i % 3 == 0 else 7 if i % 3 == 1 else i for i in range(400)]
    df = docs(spark, texts, ids)
    own = df.select("doc_id", "text")
    places = tf.Places.of(own, 20, 400, sum(i is None for i in ids), [(7, ids.count(7))])
    assert places.tasks[0] > 3 and len(places) > 20 and max(places.tasks[1:]) > 3
    rows = token_file_round_trip(df, tokenizer_path()).collect()
    rows.sort(key=lambda r: r.start)
    order = [float("-inf") if r.doc_id is None else r.doc_id for r in rows]
    assert order == sorted(order) and len(rows) == 400 and [r.start for r in rows[1:]] == np.cumsum([r.n_tokens for r in rows])[:-1].tolist() and rows[0].start == 0
    want = sorted((str(i), np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in zip(ids, texts, strict=True))
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in rows) == want


@pytest.mark.parametrize("name", ["op1_bpe", "op2_token_file"])
def test_queries(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert df.count() == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()


def test_the_text_writer_puts_bytes_out_as_they_are(spark, tmp_path):
    """Token files go through it as strings that are no UTF-8: every byte value, in any company, must come back."""
    from pyspark.sql import functions as F

    rows = [bytes(range(256)), bytes(reversed(range(256))) * 3, b"", b"\n", b"\xff\xfe\x00\n\r\xc3", bytes(b for i in range(256) for b in (i, 0x80, i ^ 0xFF))]
    spark.createDataFrame([(bytearray(r),) for r in rows], "content binary").select(F.col("content").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(f"file://{tmp_path}/raw")
    back = [bytes(r.content) for r in spark.read.format("binaryFile").load(f"file://{tmp_path}/raw").select("content").collect()]
    assert sorted(b[:-1] for b in back) == sorted(rows) and all(b.endswith(b"\n") for b in back)
