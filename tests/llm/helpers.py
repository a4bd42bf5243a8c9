"""Small tables with every odd case: nulls, empty and long texts, repeated rows, columns whose names clash."""

import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")

TEXTS = [
    "The quick brown fox jumps over the lazy dog and runs away from it, again and again.",
    "the QUICK brown fox jumps over the lazy dog and runs away from it, again and again.",
    None, "", " ", "\n\n \t", "a", "ÀÉ İ ſ K ß 中文 \U0001f600 é", "x" * 5000, "word " * 3000, "line one\nline two\r\nline three\n\n", "0123456789abcdef" * 4, "tab\tand\x00null and nbsp", "  leading and trailing  ",
]


def docs(spark, texts=None, ids=None):
    """Documents with extra columns named like the operators' own."""
    texts = TEXTS if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "src0", len(t or ""), "x", k, "y", None) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `row.no` string, row_no long, digest string, fp long").repartition(3)


def empty(spark):
    return docs(spark, [], [])
