"""The registered queries over whole tables, each held to a plain version or to the library it must equal."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from compare import SF
from eventloom.llm.queries import QUERIES, tokenizer_path
from test_dedup import brute, classes, print_of
from test_scans import names


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def rows(spark, name):
    got = {r.doc_id: r for r in QUERIES[name](spark, SF).collect()}
    return got


def test_op1(spark, documents, library):
    got = rows(spark, "op1_bpe")
    assert got.keys() == documents.keys()
    for i, text in documents.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert tuple(got[i])[1:4] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest())


def test_op2(spark, documents, library):
    got, start = rows(spark, "op2_token_file"), 0
    for i in sorted(documents):
        ids = [*library.encode(documents[i] or "", add_special_tokens=False).ids, 2]
        assert tuple(got[i])[:4] == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op3(spark, documents):
    assert sorted((tuple(r) for r in rows(spark, "op3_suffix_dedup").values()), key=str) == brute(list(documents.items()))


def test_op4_base(spark, documents):
    kinds = {
        "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""".replace("((?i:", "(?:(?i:", 1), re.A), lambda m: len(m.group(1)) >= 12),
        "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 18),
        "hex": (re.compile("[0-9a-f]+"), lambda m: len(m.group()) >= 16),
    }
    for i, r in rows(spark, "op4_secrets").items():
        spans, counts = [], []
        for k, (name, (pattern, keep)) in enumerate(kinds.items()):
            found = [m for m in pattern.finditer(documents[i] or "") if keep(m)]
            counts.append(len(found))
            spans += [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for m in found]
        text = ",".join(s for _, _, s in sorted(spans))
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == (*counts, hashlib.sha256(text.encode()).hexdigest())
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_op7(spark, documents):
    got = rows(spark, "op7_quality")
    assert got.keys() == documents.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())


def test_op8(spark, documents):
    prints = {i: print_of(t) for i, t in documents.items()}
    low = classes(prints)
    assert {i: (r.fingerprint, r.component_id) for i, r in rows(spark, "op8_simhash").items()} == {i: (f"{p:016x}", low[i]) for i, p in prints.items()}


def test_op10(spark, documents):
    assert {i: r.licenses for i, r in rows(spark, "op10_licenses").items()} == {i: names(t) for i, t in documents.items()}
