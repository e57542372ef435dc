"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embed_dedup, jaccard_join, langid, lexical, lm_score, mixing, nearest, quality, sharding, suffix_dedup, toxicity, vector_codes
from .bpe import encode_documents, read_ranks
from .frames import fold, table
from .oracles import ORACLES


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), text=None).drop("key")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, ranks, public_tokenizers.PATTERN, digest=True).drop("text")


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 5) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score_documents(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    net = langid.train(docs, ~held_out)
    return langid.predict(docs.select("doc_id", "text"), net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 4) == 2
    chain = quality.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality.score_documents(docs, chain).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.search(vectors, F.col("vec_id") % 20 == 0, k=20)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=200)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 7) == 2
    return lm_score.score_documents(docs, ~held_out).withColumn("held_out", held_out)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), n=4, percent=85)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = sharding.assign(table(spark, sf_dir, "documents"), shards=40)
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.encode(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4)
    return coded.withColumn("codebooks_sha256", F.lit(vector_codes.digest(books)))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_byte_bpe, op3_embedding_dedup, op4_toxicity, op5_language_id, op6_quality, op7_nearest, op8_suffix_dedup, op9_lm_score, op10_jaccard_join, op11_lexical_search, op12_kd_shards, op13_vector_codes)}


def oracle_texts() -> dict[str, str]:
    """SQL for those that it can express."""
    return dict(ORACLES)
