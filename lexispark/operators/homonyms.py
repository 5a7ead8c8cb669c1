"""Homonyms: one headword with several glosses, similar headwords, known pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.functions import constants as K
from lexispark.functions.text import key, tokens
from lexispark.operators.similarity import similar_pairs
from lexispark.plans.state import saved

PLACE = ("book", "page_number", "idx")


def groups(entries: DataFrame) -> DataFrame:
    """By lower-cased headword: ids in order, distinct glosses, distinct raw glosses, first place."""
    gloss = F.coalesce("gloss_pivot", F.lit(""))
    rows = entries.select(F.lower("headword").alias("key"), "id", gloss.alias("raw"), key(gloss).alias("gloss"), *PLACE)
    return rows.groupBy("key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*PLACE, "id"))), lambda x: x["id"]).alias("ids"),
        F.array_sort(F.collect_set("gloss")).alias("glosses"),
        F.array_sort(F.collect_set("raw")).alias("raw_glosses"),
        F.min(F.struct(*PLACE)).alias("first"),
    )


def exact_homonyms(entries: DataFrame) -> DataFrame:
    """Headwords with several glosses: polysemy if all glosses share two words or more, else homonyms."""
    rows = groups(entries).where((F.size("ids") > 1) & (F.size("glosses") > 1))
    words = F.transform("glosses", lambda g: F.array_distinct(tokens(g)))
    shared = F.aggregate(F.slice(words, 2, 1 << 20), F.get(words, F.lit(0)), lambda a, b: F.array_intersect(a, b))
    rows = rows.withColumn("shared", F.array_sort(shared))
    same = F.size("shared") >= K.SHARED_WORDS
    return rows.select(
        F.when(same, "polysemy").otherwise("homonym").alias("type"),
        F.col("key").alias("headword"),
        "ids",
        F.array_join("shared", ", ").alias("evidence"),
        F.when(same, "merge_with_senses").otherwise("keep_separate").alias("action"),
    )


def classify_variants(entries: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs(left, right) of headword keys: equal gloss sets, sets that meet, or sets apart."""
    # Glosses are only compared here, so their digests do.
    gloss = F.md5(key(F.coalesce("gloss_pivot", F.lit(""))).cast("binary"))
    own = groups(entries.withColumn("gloss_pivot", gloss)).select("key", "glosses", "ids")
    a = own.select(F.col("key").alias("left"), F.col("glosses").alias("_a"), F.col("ids").alias("_ia"))
    b = own.select(F.col("key").alias("right"), F.col("glosses").alias("_b"), F.col("ids").alias("_ib"))
    rows = pairs.join(a, "left").join(b, "right")
    equal, meet = F.col("_a") == F.col("_b"), F.arrays_overlap("_a", "_b")
    return rows.select(
        F.when(equal, "ocr_variant").when(meet, "dialect_variant").otherwise("homonym").alias("type"),
        "left",
        "right",
        F.concat("_ia", "_ib").alias("ids"),
        F.when(equal, "merge_as_variant").otherwise("keep_separate").alias("action"),
    )


def similar_headwords(entries: DataFrame, threshold: float = K.HEADWORD_RATIO) -> DataFrame:
    words = entries.groupBy(F.lower("headword").alias("word")).agg(F.min(F.struct(*PLACE)).alias("first"))
    return similar_pairs(saved(words, "words"), threshold)


def analyze_homonyms(entries: DataFrame, threshold: float = K.HEADWORD_RATIO) -> DataFrame:
    """Exact ones, then variants."""
    exact = exact_homonyms(entries).select("type", "headword", F.lit(None).cast("string").alias("variant"), "ids", "action")
    other = classify_variants(entries, similar_headwords(entries, threshold).select("left", "right"))
    return exact.unionByName(other.select("type", F.col("left").alias("headword"), F.col("right").alias("variant"), "ids", "action"))


def check_known_homonyms(entries: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs(word1, word2) that should differ but have the same raw glosses: a flag for every member."""
    # Glosses are only compared here, so their digests do.
    gloss = F.md5(F.coalesce("gloss_pivot", F.lit("")).cast("binary"))
    own = groups(entries.withColumn("gloss_pivot", gloss)).select("key", "raw_glosses", "ids")
    a = own.select(F.col("key").alias("_k1"), F.col("raw_glosses").alias("_a"), F.col("ids").alias("_ia"))
    b = own.select(F.col("key").alias("_k2"), F.col("raw_glosses").alias("_b"), F.col("ids").alias("_ib"))
    rows = pairs.select("word1", "word2", F.lower("word1").alias("_k1"), F.lower("word2").alias("_k2")).join(a, "_k1").join(b, "_k2")
    rows = rows.where(F.col("_a") == F.col("_b"))
    return rows.select(
        F.explode(F.concat("_ia", "_ib")).alias("entry_id"), F.lit("meaning_conflict").alias("issue_type"), "word1", "word2", F.lit(0).alias("raised_at_pass")
    )


def conventions_section(results: DataFrame) -> DataFrame:
    """Markdown lines by type, sorted."""
    line = F.concat(F.lit("- "), "headword", F.coalesce(F.concat(F.lit(" / "), "variant"), F.lit("")), F.lit(": "), "action")
    return results.groupBy("type").agg(F.array_sort(F.collect_set(line)).alias("lines"))
