"""Documents to token ids: language ID, line dedup, near-duplicate join, mixing, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet to the shared folder and
reads again for the next one; the tables that a stage made for itself go when the next one starts.  All but the last
return the columns of documents, other columns of the table included.

Defined results: a document without text or letters is `und` and goes at the first stage.  Rows that repeat a doc_id, or
have none, are documents of their own, except that of rows with one doc_id and different texts the line dedup leaves all
as they are.  Very long texts are taken whole; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.llm.common import Scratch
from lexispark.llm.langid import fit, is_held_out, predict, sample
from lexispark.llm.line_dedup import line_dedup
from lexispark.llm.mixing import mixed
from lexispark.llm.ngram_join import ngram_join
from lexispark.llm.sentencepiece import encode

#: A posterior below this rejects a document: no language stands out.
LEAST_SCORE = 0.5

_HELD: dict[str, list[Scratch]] = {}


def _scratch(spark: SparkSession, docs: DataFrame, name: str) -> Scratch:
    """Tables for a stage; those of earlier stages go, unless docs still reads them as the result wasn't written."""
    held, files = _HELD.setdefault(spark.sparkContext.applicationId, []), None
    for old in list(held):
        files = docs.inputFiles() if files is None else files
        if not any(old.name in f for f in files):
            held.remove(old)
            old.close()
    held.append(Scratch(spark, name))
    return held[-1]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, those whose best language has a posterior below LEAST_SCORE, and those whose
    letters are less likely in it than any text it was learnt from, by a margin (see `langid.Model.least`)."""
    model = fit(sample(docs.where(~is_held_out(F.col("doc_id")))))
    known = predict(docs, model).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE) & F.col("likely"))
    return known.select(*_columns(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of aligned lines go; so do documents that had text and have none left."""
    less = line_dedup(docs, scratch=_scratch(spark, docs, "lines")).where(~((F.col("n_removed") > 0) & (F.col("text") == "")))
    return less.withColumn("n_chars", F.length("text").cast("long")).select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at a similarity of 0.8 on 5-word shingles, the smallest id stays."""
    found = ngram_join(docs, threshold=80, width=5, scratch=_scratch(spark, docs, "near"))
    extra = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__near_id")).distinct()
    return docs.join(extra.hint("merge"), docs["doc_id"] == F.col("__near_id"), "left_anti").select(*_columns(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed(docs, scratch=_scratch(spark, docs, "mixture")).select(*_columns(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as ids."""
    _scratch(spark, docs, "tokens")
    return encode(docs.select("doc_id", "source", "text")).select("doc_id", "source", F.size("ids").cast("long").alias("n_ids"), "ids")


def _columns(docs: DataFrame) -> list[str]:
    return [f"`{c}`" for c in docs.columns]


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: Language models, alignments and segmentations are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs, before = scratch.table(stage(spark, docs, sf_dir)), docs
        scratch.drop(before)
    return docs
