"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embeddings, importance, lm_scoring, packing, perplexity, pii, simhash, sstable, substrings, tandem, warc, weak_labels
from .common import read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


def op3_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.token_table(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.quality(read_table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(read_table(spark, sf_dir, "pages"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise_documents(docs, pii.session_key(spark), count_col="n_replaced")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.classify(read_table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op10_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(read_table(spark, sf_dir, "documents"))


def periodic_part(name: str, n: int) -> np.ndarray | None:
    """Of one document in ten, by its id, the words from some place on become copies of the first few from there."""
    h = zlib.crc32(name.encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tandem.digests(tandem.mark_runs(read_table(spark, sf_dir, "documents"), rewrite=periodic_part))


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


#: CRC-32 with the reflected polynomial 0xEDB88320, eight steps a byte, as DuckDB has no such function.
_IMPORTANCE = rf"""
    WITH texts AS (
      SELECT doc_id, 0 AS side, text FROM documents UNION ALL SELECT NULL, 1, text FROM benchmark
    ), numbered AS (
      SELECT row_number() OVER () AS k, doc_id, side,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
      FROM texts
    ), tokens AS (
      SELECT k, side, unnest(words) AS w FROM numbered
    ), kinds AS (
      SELECT DISTINCT w FROM tokens
    ), crcs AS (
      SELECT w, list_reduce(
        list_transform(range(1, CAST(length(hex(encode(w))) AS BIGINT), 2), lambda i: ('0x' || substr(hex(encode(w)), i, 2))::UBIGINT),
        lambda c, b: list_reduce(range(0, 8)::UBIGINT[], lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)),
        4294967295::UBIGINT) AS c FROM kinds
    ), hashed AS (
      SELECT w, CAST(xor(c, 4294967295::UBIGINT) % 10000 AS BIGINT) AS bucket FROM crcs
    ), cells AS (
      SELECT k, side, bucket, count(*) AS n FROM tokens JOIN hashed USING (w) GROUP BY ALL
    ), sums AS (
      SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t FROM cells GROUP BY 1
    ), totals AS (
      SELECT sum(s) AS here, sum(t) AS there FROM sums
    ), gain AS (
      SELECT bucket, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(here + 10000 AS DOUBLE)) / (CAST(s + 1 AS DOUBLE) * CAST(there + 10000 AS DOUBLE)))) AS BIGINT) AS g
      FROM sums, totals
    ), weights AS (
      SELECT k, CAST(sum(n * g) AS BIGINT) AS total, CAST(sum(n) AS BIGINT) AS n FROM cells JOIN gain USING (bucket) WHERE side = 0 GROUP BY 1
    ), scored AS (
      SELECT doc_id, len(words) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
        CASE WHEN n IS NULL THEN 0 ELSE total // n - CASE WHEN total % n < 0 THEN 1 ELSE 0 END END AS weight,
        CAST(('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::UBIGINT AS DOUBLE) AS h
      FROM numbered LEFT JOIN weights USING (k) WHERE side = 0
    ), noisy AS (
      SELECT *, CAST(weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM scored
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS many FROM noisy
    )
    SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, score,
      CASE WHEN n_words >= 20 AND place <= 10 * many // 100 THEN CAST(place AS BIGINT) END AS rank
    FROM ranked
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_simhash, op2_embeddings, op3_token_table, op4_perplexity, op5_warc, op6_pii, op7_packing, op8_weak_labels, op9_bpe, op10_interpolation,
        op11_runs, op12_substrings, op13_importance,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_embeddings": """
            WITH RECURSIVE vectors AS (
              SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            ), usable AS (
              SELECT vec_id, e FROM vectors
              WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(e, lambda x: x <> 0)) > 0
            ), links AS (
              SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y
              ON x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.9
            ), reach AS (
              SELECT vec_id, vec_id AS r FROM vectors
              UNION
              SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.r
            ), least AS (
              SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id
            ), counted AS (
              SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
            )
            SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
            FROM least LEFT JOIN counted USING (vec_id)
        """,
        "op5_warc": """
            WITH payloads AS (
              SELECT page_id, coalesce(html, '') AS p FROM pages
            ), stored AS (
              SELECT page_id, p, CASE WHEN strlen(p) >= 1000 THEN max(page_id) OVER (PARTITION BY p) ELSE page_id END AS holder
              FROM payloads
            )
            SELECT page_id, CAST(strlen(p) AS BIGINT) AS payload_bytes, sha1(p) AS payload_digest,
                   CASE WHEN holder = page_id THEN 'response' ELSE 'revisit' END AS record_type,
                   CASE WHEN holder <> page_id THEN holder END AS refers_to
            FROM stored
        """,
        "op13_importance": _IMPORTANCE,
    }
