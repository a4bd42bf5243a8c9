"""Queries of the driver's contract over the operators of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_round_trip
from .clustering import clustering_report, delta_lloyd
from .common import table
from .decontaminate import contamination, contamination_report
from .exact_dedup import exact_dedup
from .html import extract
from .licenses import licenses_report, scan_licenses
from .quality import quality_scores
from .secrets import scan_secrets, secrets_report
from .simhash import near_copies
from .spelling import spelling_variants, word_counts
from .suffix_dedup import repeated_spans, suffix_report
from .token_file import token_file_round_trip
from .top_k import top_k
from .vectors import whole_vectors


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary lies: the installed module knows, else EVENTLOOM_TOKENIZERS names the folder."""
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join(os.environ.get("EVENTLOOM_TOKENIZERS", "/opt/tokenizers"), name)
    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op2_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_file_round_trip(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_report(repeated_spans(table(spark, sf_dir, "documents")))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_report(scan_secrets(table(spark, sf_dir, "documents")))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses_report(scan_licenses(table(spark, sf_dir, "documents")))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), typo_every=199))


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding").where(F.size("q") == 64)
    return clustering_report(delta_lloyd(vectors, 64))


def op13_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_token_file": op2_token_file,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_secrets": op4_secrets,
    "op5_decontaminate": op5_decontaminate,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality": op7_quality,
    "op8_simhash": op8_simhash,
    "op9_html": op9_html,
    "op10_licenses": op10_licenses,
    "op11_spelling": op11_spelling,
    "op12_clustering": op12_clustering,
    "op13_top_k": op13_top_k,
}

def _clustering_sql(rounds: int = 3) -> str:
    """The rounds one after the other, each as an assignment of all vectors to all centroids."""
    parts = ["""v AS (
            SELECT row_number() OVER () AS no, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(64 * x) AS BIGINT)) AS q FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        "c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id), q) - 1 AS INTEGER) AS c, q FROM v WHERE vec_id IS NOT NULL QUALIFY c < 16)",
    ]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
            SELECT no, any_value(vec_id) AS vec_id, arg_min(c, (d, c)) AS cluster, min(d) AS distance FROM (
                SELECT v.no, v.vec_id, c, CAST(list_sum(list_transform(list_zip(v.q, k.q), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{n} k) GROUP BY no)""")
        if n < rounds:
            parts.append(f"""m{n} AS (
                SELECT cluster, list(x ORDER BY i) AS q FROM (
                    SELECT cluster, i, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x FROM (
                        SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(q) AS x, unnest(range(len(q))) AS i FROM a{n} JOIN v USING (no)) GROUP BY 1, 2)) GROUP BY 1)""")
            parts.append(f"c{n + 1} AS MATERIALIZED (SELECT c, coalesce(m.q, k.q) AS q FROM c{n} k LEFT JOIN m{n} m ON c = cluster)")
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(q, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} ON cluster = c"""


ORACLES: dict[str, str] = {
    "op5_decontaminate": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        items AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        patterns AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS pattern
            FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM patterns),
        grams AS (
            SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n)),
        hits AS (SELECT doc_id, item_id, g.n, i FROM grams g JOIN patterns p ON g.n = p.n AND g.gram = p.pattern),
        hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY 1),
        hit_items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS found
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY 1)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(found, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
    """,
    "op6_exact_dedup": """
        WITH n AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
            FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM n WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op11_spelling": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list(c ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i))),
        runs AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS w FROM documents),
        long AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS s, w FROM runs WHERE length(w) >= 6),
        bytes AS (
            SELECT w, list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(s, ''),
                lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(192 + (unicode(c) >> 6) AS BIGINT), 128 + (unicode(c) & 63)] END))) AS b FROM long),
        hashed AS (SELECT w, xor(list_reduce(b, lambda h, x: xor(h >> 8, t[(xor(h, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc_table),
        spelled AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM hashed),
        words AS (SELECT word, count(*) AS n FROM spelled WHERE length(word) >= 6 GROUP BY 1 HAVING count(*) >= 5),
        left_of AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS key FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        replaced AS (
            SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM left_of a JOIN left_of b ON a.key = b.key AND a.word <> b.word
            WHERE list_sum(list_transform(range(1, length(a.word) + 1), lambda i: CASE WHEN a.word[i] = b.word[i] THEN 0 ELSE 1 END)) = 1),
        near AS (
            SELECT word, other, other_n FROM replaced
            UNION ALL SELECT l.word, w.word, w.n FROM left_of l JOIN words w ON l.key = w.word
            UNION ALL SELECT w.word, l.word, l.n FROM left_of l JOIN words w ON l.key = w.word),
        best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY 1),
        judged AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * n THEN other END AS form, CASE WHEN other_n >= 5 * n THEN other_n END AS form_n
            FROM words w LEFT JOIN best b ON w.word = b.word),
        steps AS (
            SELECT word, word AS here, 0 AS step FROM judged
            UNION ALL SELECT s.word, j.form, step + 1 FROM steps s JOIN judged j ON s.here = j.word WHERE j.form IS NOT NULL),
        ends AS (SELECT word, arg_max(here, step) AS root FROM steps GROUP BY 1)
        SELECT j.word, form, root, n, n_near, form_n FROM judged j JOIN ends e ON j.word = e.word
    """,
    "op12_clustering": _clustering_sql(),
    "op13_top_k": """
        WITH v AS (
            SELECT row_number() OVER () AS no, CAST(vec_id AS BIGINT) AS vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(64 * x)) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        pairs AS (
            SELECT a.no, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.no <> b.no WHERE a.vec_id % 20 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY no ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM pairs QUALIFY rank <= 20
    """,
}
