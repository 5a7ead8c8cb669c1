"""Queries of the operators here, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm import pii, secrets
from lexispark.llm.chat import format_chats
from lexispark.llm.embedding_dedup import near_vectors
from lexispark.llm.fingerprints import compare_with_next
from lexispark.llm.langid import identify
from lexispark.llm.line_dedup import line_dedup
from lexispark.llm.mixing import entropy_mix
from lexispark.llm.ngram_join import ngram_join
from lexispark.llm.sentencepiece import encode


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether decoding gave the text back."""
    coded = encode(_documents(spark, sf_dir).select("doc_id", "text"), check_col="round_trip")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


def op2_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of whole texts, of their edited texts, and how alike they are."""
    return compare_with_next(_documents(spark, sf_dir))


def op3_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in whole texts: base spans and those that bootstrapped patterns add."""
    return pii.digest(pii.find(_documents(spark, sf_dir)))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learnt from those that aren't held out."""
    return identify(_documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at a Jaccard similarity of 0.85 of distinct 4-word shingles."""
    return ngram_join(_documents(spark, sf_dir), threshold=85, width=4).select("doc_id", "n_shingles", "component_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document has in an aligned block."""
    return line_dedup(_documents(spark, sf_dir)).select("doc_id", "text", "n_lines", "n_removed")


def op7_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between vectors of one label with a cosine of 0.93 or more, and their components."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in whole texts: base spans and those that the network adds."""
    return secrets.digest(secrets.find(_documents(spark, sf_dir)))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with repaired roles, rendered."""
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op9_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from each document."""
    rows = entropy_mix(_documents(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_weighted_fingerprints": op2_weighted_fingerprints,
    "op3_bootstrapped_pii": op3_bootstrapped_pii,
    "op4_language_id": op4_language_id,
    "op5_ngram_join": op5_ngram_join,
    "op6_line_dedup": op6_line_dedup,
    "op7_cover_tree": op7_cover_tree,
    "op8_secret_scan": op8_secret_scan,
    "op10_chat_format": op10_chat_format,
    "op9_entropy_mixing": op9_entropy_mixing,
}

ORACLE_SQL: dict[str, str] = {}
