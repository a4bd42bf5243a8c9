"""A training corpus from documents, in stages that each read what the one before has written.

Documents that the quality classifier rejects go; of equal texts one stays; of each group of near copies one stays;
documents with a passage of the benchmark go; what is left is encoded, and decoded again as a check.

Every stage takes nulls in any column, empty and very long texts, ties, repeated rows and empty tables; columns beyond
those of documents come along unchanged, whatever they are called, through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.bpe import bpe_round_trip
from eventloom.llm.common import cut, table
from eventloom.llm.decontaminate import drop_contaminated
from eventloom.llm.exact_dedup import drop_exact_copies
from eventloom.llm.quality import drop_rejected
from eventloom.llm.queries import tokenizer_path
from eventloom.llm.simhash import drop_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 7: the documents that the classifier doesn't reject. Null and empty texts are scored like others; without labels all stay."""
    return drop_rejected(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 6: of equal texts the row with the largest doc_id; null ids are smallest, of rows that repeat an id one stays, null counts as empty."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 8: of each group of near copies the row with the smallest doc_id; null ids come last, of rows that repeat an id and a text one stays."""
    return drop_near_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 5: the documents without a passage of any test item. Null and empty texts stay, as does all without items; rows that repeat share their fate."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Op 1: token ids of each document, and whether they decode to its text; null counts as empty and has no ids."""
    made = bpe_round_trip(docs, tokenizer_path(), ("n_tokens", "ids", "decoded_sha256"), keep=("text",))
    return made.select("doc_id", "n_tokens", "ids", (F.col("decoded_sha256") == F.sha2(F.coalesce("text", F.lit("")), 256)).alias("round_trip"))


STAGES = [("quality_classifier", quality), ("exact_dedup", exact), ("simhash_near_dedup", near), ("decontamination", decontaminated), ("bpe_encoding", encoded)]
#: SQL can't express the classifier, the fingerprints' components or the encoding; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
