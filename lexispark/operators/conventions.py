"""Layout conventions, from the first pages of each book."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispark.functions import constants as K
from lexispark.functions.text import count, lines, rx, tokens

HEADWORD_LIKE = r"(?:^|\s)[a-z][a-z'\-]+(?:\s+[a-z][a-z'\-]+)?\s+[a-z(]"
LINE_HEADWORD = r"^(?:a\s+)?[•·.]{0,3}\s*([a-zà-ÿ'\-]+)"
POS_TOKEN = rf"(?<![A-Za-z])(?:{'|'.join(K.POS_CODES)})\.?\s"


def first_pages(pages: DataFrame, n: int = K.FIRST_PAGES) -> DataFrame:
    order = Window.partitionBy("book").orderBy("page_number")
    return pages.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= n).drop("_k")


def split_mode(first: DataFrame) -> DataFrame:
    """marker, hybrid or line, by the share of lines with several headword-like places."""
    rows = first.select("book", F.explode(lines(F.col("text"))).alias("line"))
    many = (count(F.col("line"), HEADWORD_LIKE) > 1).cast("int")
    ratio = rows.groupBy("book").agg(F.count("*").alias("n_lines"), F.sum(many).alias("n_multi"))
    share = F.col("n_multi") / F.col("n_lines")
    return ratio.withColumn("split_mode", F.when(share > 0.3, "marker").when(share > 0.1, "hybrid").otherwise("line"))


def headword_shape(first: DataFrame) -> DataFrame:
    rows = first.select("book", F.explode(lines(F.col("text"))).alias("line"))
    word = F.regexp_extract("line", rx(LINE_HEADWORD, "i"), 1)
    rows = rows.withColumn("hw", word).where("hw <> ''")
    return rows.groupBy("book").agg(
        F.mode(F.size(tokens(F.col("hw")))).alias("most_common_word_count"),
        F.bool_or(F.col("hw").contains("-")).alias("has_hyphen"),
        F.bool_or(F.col("hw").contains("'")).alias("has_apostrophe"),
        F.max(F.length("hw")).alias("max_headword_length"),
    )


def gloss_languages(first: DataFrame) -> DataFrame:
    """(book, language, hits), more than 5 hits, the three most frequent."""
    bare = F.transform(tokens(F.lower("text")), lambda t: F.regexp_replace(F.regexp_replace(t, "^[.,;:()'\"]+", ""), "[.,;:()'\"]+$", ""))
    known = F.array_compact(F.array(*[F.when(F.array_contains(F.array(*map(F.lit, ws)), F.col("w")), F.lit(lang)) for lang, ws in K.FUNCTION_WORDS.items()]))
    rows = first.select("book", F.explode(bare).alias("w")).select("book", F.explode(known).alias("language"))
    hits = rows.groupBy("book", "language").agg(F.count("*").alias("hits")).where("hits > 5")
    best = Window.partitionBy("book").orderBy(F.col("hits").desc(), F.when(F.col("language") == "indonesian", 0).otherwise(1))
    return hits.withColumn("_k", F.row_number().over(best)).where("_k <= 3").drop("_k")


def cross_refs(first: DataFrame) -> DataFrame:
    """(book, marker, n), zeros included."""
    sums = first.groupBy("book").agg(*[F.sum(count(F.col("text"), p, "i")).alias(name) for name, p in K.CROSS_REFS.items()])
    return sums.unpivot("book", list(K.CROSS_REFS), "marker", "n")


def pos_codes(first: DataFrame, most: int = 10) -> DataFrame:
    """(book, code, n): the most frequent codes, ties by first place."""
    codes = F.regexp_extract_all("text", F.lit(rx(POS_TOKEN, "i")), F.lit(0))
    rows = first.select("book", "page_number", F.posexplode(codes).alias("k", "code"))
    rows = rows.withColumn("code", F.regexp_replace(F.regexp_replace("code", rx(r"\s+$"), ""), r"\.+$", ""))
    counts = rows.groupBy("book", "code").agg(F.count("*").alias("n"), F.min(F.struct("page_number", "k")).alias("_first"))
    best = Window.partitionBy("book").orderBy(F.col("n").desc(), "_first")
    return counts.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= most).select("book", "code", "n")


def layout_flags(first: DataFrame) -> DataFrame:
    """Has some page many dots, or many numbered senses?"""
    return first.groupBy("book").agg(
        F.bool_or(count(F.col("text"), K.ANY_DOTS) > 5).alias("dotted_markers"),
        F.bool_or(count(F.col("text"), K.SENSE, "m") > 3).alias("multi_sense"),
    )


def morphology_hints(first: DataFrame) -> DataFrame:
    """(book, hint, n): reduplication in more than 3 places, affixes in more than 5."""
    t = F.col("text")
    doubled = count(t, r"\b([a-z]+)-\1\b", "i") + count(t, r"\b([a-z]+)\s+\1\b", "i")
    sums = first.groupBy("book").agg(
        F.sum(doubled).alias("reduplication"), *[F.sum(count(t, p, "i")).alias(name) for name, p in K.AFFIX_HINTS.items()]
    )
    rows = sums.unpivot("book", ["reduplication", *(f"`{x}`" for x in K.AFFIX_HINTS)], "hint", "n")
    return rows.where((F.col("n") > 5) | ((F.col("hint") == "reduplication") & (F.col("n") > 3)))


def extract_conventions(pages: DataFrame) -> DataFrame:
    """One row a book with all of the above."""
    first = first_pages(pages)
    gathered = lambda df, cols, name: df.groupBy("book").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    return (
        first.select("book").distinct()
        .join(split_mode(first).select("book", "split_mode"), "book", "left")
        .withColumn("split_mode", F.coalesce("split_mode", F.lit("line")))
        .join(headword_shape(first), "book", "left")
        .join(gathered(gloss_languages(first), ["hits", "language"], "gloss_languages"), "book", "left")
        .join(gathered(cross_refs(first), ["marker", "n"], "cross_refs"), "book", "left")
        .join(gathered(pos_codes(first), ["n", "code"], "pos_codes"), "book", "left")
        .join(layout_flags(first), "book", "left")
        .join(gathered(morphology_hints(first), ["hint", "n"], "morphology_hints"), "book", "left")
    )


def suggest_split_pattern(row: dict) -> str | None:
    """A split_before pattern for one book's conventions: before dotted markers and before the names of the cross-reference
    markers found, in their fixed order.  None where lines serve or neither was found."""
    if (row.get("split_mode") or "line") == "line":
        return None
    found = {x["marker"] for x in row.get("cross_refs") or [] if x["n"]}
    names = "|".join(re.escape(name) for name in K.CROSS_REFS if name in found)
    choices = [K.SPLIT_AT_DOTS] if row.get("dotted_markers") else []
    return "|".join([*choices, *([K.SPLIT_AT_NAMES.format(names=names)] if names else [])]) or None


def suggest_entry_pattern(row: dict) -> str | None:
    """A permissive entry pattern where headwords have hyphens or dots; else the default serves."""
    if not (row.get("has_hyphen") or row.get("dotted_markers")):
        return None
    dots = K.ENTRY_DOTS if row.get("dotted_markers") else ""
    compound = K.ENTRY_COMPOUND if row.get("has_hyphen") else ""
    return K.ENTRY_SUGGESTED.format(dots=dots, compound=compound)
