"""Queries of this subpackage, bound to the given tables, and their DuckDB SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import (alignment, bitplanes, debruijn, decontaminate, duplicate_sql, jaccard, lexical, packing, secrets,
                             spm, suffix_dedup, topk, toxicity, url_filter)
from ledgerlight.llm.common import read_table


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(decontaminate.overlaps(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.encode_and_digest(read_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.drop_repeats(read_table(spark, sf_dir, "documents"), with_text=False).drop("kept")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.drop_repeats(read_table(spark, sf_dir, "documents")).drop("spans")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.digest(spm.encode_documents(read_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model")))


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read_table(spark, sf_dir, "documents"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where(F.col("vec_id") % 20 == 0))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json")).drop("uid")


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(read_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"),
                                     _tokenizer("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_toxicity, op2_decontamination, op3_token_ids, op4_url_filters, op5_substring_dedup, op6_suffix_array_dedup,
        op7_sentencepiece, op8_secret_scans, op9_exact_top_k, op10_ngram_jaccard_join, op11_best_fit_packing,
        op12_ranked_lexical_search, op13_cross_tokenizer_alignment)
}

TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64.0::DOUBLE * x::DOUBLE)::BIGINT::DOUBLE) AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.w, c.w)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20"""

ORACLE_SQL: dict[str, str] = {
    "op4_url_filters": url_filter.oracle_sql(),
    "op5_substring_dedup": duplicate_sql.substring_sql(),
    "op6_suffix_array_dedup": duplicate_sql.bytes_sql(),
    "op9_exact_top_k": TOP_K_SQL,
    "op10_ngram_jaccard_join": duplicate_sql.jaccard_sql(),
    "op12_ranked_lexical_search": lexical.oracle_sql(),
}
