"""The registered queries of this folder: each applies an operator to its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import imatch, langid, license_scan, mixing, near_dedup, pieces, suffix_dedup, token_output, topk, url_filter

#: The url rules of the contract: verdict, host and path prefix.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op2_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), span=100).drop("kept_text")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"), keep=())


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"), weight=F.col("ord") % 3 + 1, max_epochs=3.0)
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"),
        (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"),
    )


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(_table(spark, sf_dir, "documents"))


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards, dictionary = token_output.write_shards(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), end_id=2)
    return token_output.read_documents(shards, dictionary)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


QUERIES = {f.__name__: f for f in (op1_language_id, op2_imatch, op3_url_filter, op4_suffix_dedup, op5_sentencepiece, op6_mixing, op7_license_scan, op8_exact_top_k, op9_token_output, op10_minhash)}
TOP_K_SQL = """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS t FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_sum(list_transform(list_zip(q.t, c.t), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s QUALIFY rank <= 5"""

NEAR_SQL = r"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
    s AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_transform(generate_series(1, len(words) - 3), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    pair AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
    link AS (SELECT u, v FROM pair JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
    sym AS (SELECT u, v FROM link UNION SELECT v, u FROM link),
    reach AS (SELECT u AS a, u AS b FROM sym UNION SELECT r.a, sym.v FROM reach r JOIN sym ON r.b = sym.u),
    component AS (SELECT a, min(b) AS c FROM reach GROUP BY 1)
    SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(c, w.doc_id) AS component_id, w.doc_id = coalesce(c, w.doc_id) AS kept
    FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN component ON a = w.doc_id"""

ORACLE_SQL: dict[str, str] = {"op7_license_scan": license_scan.scan_sql(), "op8_exact_top_k": TOP_K_SQL, "op10_minhash": NEAR_SQL}
