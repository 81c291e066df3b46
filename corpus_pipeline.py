"""From raw documents to token ids: drop toxic documents, keep one of each group of near
duplicates, drop documents that leak benchmark items, mask secrets, encode.

Each stage works on what its predecessor kept, written as Parquet and read again. All but the
last return the columns of the documents. Null texts and ids pass through: a null text is
judged like an empty one, and rows without an id are never duplicates. Rows that repeat an id with
other texts are documents of their own; of rows that repeat id and text the second stage keeps one.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm import decontaminate, jaccard, secrets, spm, toxicity
from ledgerlight.llm.common import read_table, store

MODEL = "piece_bpe_32k.model"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.keep_accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component the document with the smallest doc_id stays. Rows that repeat a doc_id are
    documents of their own, known to the join by a hash of id and text above all ids."""
    known = docs.where(F.col("doc_id").isNotNull())
    repeated = store(known.groupBy("doc_id").count().where("count > 1").select("doc_id"), "pipeline-repeated")
    keyed = known.withColumn("_key", F.col("doc_id"))
    if not repeated.isEmpty():
        others = [c for c in docs.columns if c not in ("doc_id", "text")]
        odd = known.join(repeated, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*others)).alias("_o"))
        odd = odd.select("doc_id", "text", *[F.col("_o")[c].alias(c) for c in others]).select(docs.columns)
        key = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
        keyed = keyed.join(repeated, "doc_id", "left_anti").select(keyed.columns).unionByName(odd.withColumn("_key", key))
    found = jaccard.near_duplicates(keyed, id_col="_key")
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_key"))
    kept = keyed.join(gone, "_key", "left_anti").select(docs.columns)
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; the text without secrets, and its new length."""
    masked = secrets.redact_column(docs)
    return masked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, chunk, n_tokens, ids, round_trip)."""
    import public_tokenizers

    return spm.encode_documents(docs, public_tokenizers.path(MODEL)).select(
        "doc_id", "chunk", "n_tokens", "ids", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", mask_secrets),
    ("SentencePiece encoding and decoding", encode),
]

ORACLE_SQL = None  # classifier, sketches and encoder are beyond SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
