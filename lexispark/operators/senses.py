"""Checks of a reviewer's lane: senses in one gloss, dangling references, conflicts between books, the kind of a flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions.text import key, rx, strip


def split_senses(entries: DataFrame) -> DataFrame:
    """One row a sense, cut at "(1)", "1." or ";"; the confidence is shared."""
    parts = F.filter(F.transform(F.split("gloss_pivot", rx(r";|\(\d+\)|(?<!\S)\d+\.(?=\s)")), strip), lambda x: x != "")
    rows = entries.withColumn("_n", F.size(parts)).select("*", F.posexplode(parts).alias("sense_no", "sense"))
    return rows.withColumn("confidence", F.col("confidence") / F.col("_n")).withColumn("sense_no", F.col("sense_no") + 1).drop("_n")


def dangling_references(entries: DataFrame, marker: str = r"(?:KS|lht\s+jg|cf|see(?:\s+also)?)\s*:?\s+") -> DataFrame:
    """References in glosses to words that are no headword."""
    refs = F.regexp_extract_all("gloss_pivot", F.lit(rx(rf"\b{marker}([A-Za-zÀ-ÿ'’\-]+)", "i")), F.lit(1))
    rows = entries.select("id", "headword", F.explode(F.array_distinct(refs)).alias("reference"))
    known = entries.select(key(F.col("headword")).alias("_k")).distinct()
    return rows.join(known, key(F.col("reference")) == F.col("_k"), "left_anti")


def cross_book_conflicts(entries: DataFrame) -> DataFrame:
    """Headwords with several glosses in several books."""
    rows = entries.groupBy(key(F.col("headword")).alias("key")).agg(
        F.count_distinct(key(F.col("gloss_pivot"))).alias("n_glosses"), F.count_distinct("book").alias("n_books")
    )
    return rows.where("n_glosses > 1 and n_books > 1")


def review_kind() -> Column:
    """Who should look at a flag."""
    return (
        F.when(F.col("note").contains("example"), "example_review")
        .when(F.col("issue_type") == "duplicate_headword", "multi_sense")
        .when(F.col("issue_type") == "meaning_conflict", "translation_accuracy")
        .when(F.col("note").contains("reference"), "cross_ref")
        .when(F.col("issue_type") == "ocr_typo", "morphology_fix")
        .otherwise("homonym_variant")
    )


def unresolved_only(prior: DataFrame, new: DataFrame) -> DataFrame:
    """Prior corpus rows stay; new rows come in for headwords that aren't there."""
    known = prior.select(key(F.col("headword")).alias("_k")).distinct()
    return prior.unionByName(new.join(known, key(F.col("headword")) == F.col("_k"), "left_anti"), allowMissingColumns=True)
