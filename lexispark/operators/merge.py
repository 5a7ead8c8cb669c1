"""Merging the entries of many books into one corpus.

Two levels of aggregation (headword and gloss, then headword) keep a hot headword from being gathered row by row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.functions import constants as K
from lexispark.functions.text import entry_id, key
from lexispark.operators.similarity import ratio

PLACE = ("book", "page_number", "idx")


def senses(entries: DataFrame) -> DataFrame:
    """One row for each headword key and gloss: its best entry, its first place, its books."""
    rows = entries.withColumn("key", key(F.col("headword"))).withColumn("gloss", key(F.coalesce("gloss_pivot", F.lit(""))))
    best = F.struct("id", "headword", "part_of_speech", "gloss_pivot", "page_ref", "confidence", "source_language", "source_page", "source_book", "examples")
    return rows.groupBy("key", "gloss").agg(
        F.count("*").alias("n"),
        F.min_by(best, F.struct(-F.col("confidence"), *PLACE)).alias("best"),
        F.min(F.struct(*PLACE)).alias("first"),
        F.min_by(F.struct(*PLACE), F.struct(-F.col("confidence"), *PLACE)).alias("best_at"),
        F.collect_set(F.when(F.col("source_book") != "", F.col("source_book"))).alias("books"),
    )


def grouped(entries: DataFrame) -> DataFrame:
    """One row a headword key, its senses in order of first place."""
    sense = F.struct("first", "gloss", "n", "best", "best_at", "books")
    return senses(entries).groupBy("key").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(sense)).alias("senses"))


def merge_books(entries: DataFrame, gloss_ratio: float = K.GLOSS_RATIO, conflicts: bool = False) -> DataFrame:
    """entries -> corpus rows with how they came about: single, same, similar, senses (or conflict, if asked for).

    A lone entry passes as it is.  Equal glosses: the best entry (highest confidence, first on ties), its books joined.
    Two glosses of a ratio of 0.9: the best entry with the longer normalised gloss.  Else numbered senses in order of first
    place, up to ten examples of the senses' best entries, and the senses' best confidences over the number of entries.  In
    the other cases the examples are the best entry's.  conflicts marks groups of two or more books whose glosses share no
    word; a gloss_ratio above 1 merges no different glosses.
    """
    rows = grouped(entries)
    first, second = F.get("senses", F.lit(0)), F.get("senses", F.lit(1))
    two = F.size("senses") == 2
    # The ratio runs on groups of two glosses only; the others never reach Python with more than empty strings.
    a, b = F.when(two, first["gloss"]).otherwise(""), F.when(two, second["gloss"]).otherwise("x")
    pairs = rows.where(two).withColumn("_ratio", ratio(a, b))
    rest = rows.where(~two).withColumn("_ratio", F.lit(0.0))
    rows = pairs.unionByName(rest)
    bests = F.transform("senses", lambda s: F.struct((-s["best"]["confidence"]).alias("c"), s["best_at"].alias("at"), s["best"].alias("b")))
    rows = rows.withColumn("_best", F.array_min(bests)["b"])
    books = F.array_join(F.array_sort(F.array_distinct(F.flatten(F.transform("senses", lambda s: s["books"])))), ",")
    examples = F.slice(F.flatten(F.transform("senses", lambda s: F.coalesce(s["best"]["examples"], F.array().cast("array<string>")))), 1, K.MAX_EXAMPLES)
    numbered = F.array_join(F.transform("senses", lambda s, i: F.concat(F.lit("("), (i + 1).cast("string"), F.lit(") "), s["best"]["gloss_pivot"])), "; ")
    how = F.when(F.col("n") == 1, "single").when(F.size("senses") == 1, "same").when(two & (F.col("_ratio") >= gloss_ratio), "similar")
    if conflicts:
        words = F.transform("senses", lambda s: F.split(s["gloss"], " "))
        apart = F.size(F.aggregate(F.slice(words, 2, 1 << 20), F.get(words, F.lit(0)), lambda x, y: F.array_intersect(x, y))) == 0
        several = F.size(F.array_distinct(F.flatten(F.transform("senses", lambda s: s["books"])))) > 1
        how = how.when(apart & several, "conflict")
    rows = rows.withColumn("how", how.otherwise("senses"))
    longer = F.when(F.length(second["gloss"]) > F.length(first["gloss"]), second["gloss"]).otherwise(first["gloss"])
    total = F.aggregate("senses", F.lit(0.0), lambda x, s: x + s["best"]["confidence"])
    sensed, single = F.col("how") == "senses", F.col("how") == "single"
    return rows.select(
        F.when(sensed, entry_id(F.lit("merged"), F.col("key"))).otherwise(F.col("_best.id")).alias("id"),
        F.col("_best.headword").alias("headword"),
        F.col("_best.part_of_speech").alias("pos"),
        F.when(sensed, numbered).when(F.col("how") == "similar", longer).otherwise(F.col("_best.gloss_pivot")).alias("gloss_pivot"),
        F.when(sensed, examples).otherwise(F.col("_best.examples")).alias("examples"),
        F.col("_best.page_ref").alias("page_ref"),
        F.round(F.when(sensed, total / F.col("n")).otherwise(F.col("_best.confidence")), 3).alias("confidence"),
        F.col("_best.source_language").alias("source_language"),
        F.when(single, F.col("_best.source_book")).otherwise(books).alias("source_book"),
        F.col("_best.source_page").alias("source_page"),
        "how",
        F.col("n").alias("n_entries"),
    )


def merge_summary(entries: DataFrame, corpus: DataFrame) -> DataFrame:
    """Books, entries in and out, conflicts; zeros without books."""
    one = entries.agg(F.count_distinct("book").alias("books"), F.count("*").alias("entries_in"))
    two = corpus.agg(F.count("*").alias("entries_out"), F.count_if(F.col("how") == "conflict").alias("conflicts"))
    both = one.unionByName(two, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("books", "entries_in", "entries_out", "conflicts")])
