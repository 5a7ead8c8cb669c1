"""Book profiles: page statistics, zones, kinds and layout figures, for all books in one job.

Pages have (book, page_number, text, was_ocr, ocr_confidence).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.functions import constants as K
from lexispark.functions.text import count, tokens

POS_RUN = rf"(?<![A-Za-z])(?:{'|'.join(K.POS)})(?![A-Za-z])\.?"


def page_sample(pages: DataFrame, budget: int = K.SAMPLE) -> DataFrame:
    """Evenly spaced pages of each book, all of them if they are within the budget."""
    order = Window.partitionBy("book").orderBy("page_number")
    rows = pages.withColumn("_i", F.row_number().over(order) - 1).withColumn("_n", F.count("*").over(Window.partitionBy("book")))
    wanted = F.transform(F.sequence(F.lit(0), F.lit(budget - 1)), lambda i: F.least(F.floor(i * (F.col("_n") / F.lit(float(budget)))), F.col("_n") - 1))
    return rows.where((F.col("_n") <= budget) | F.array_contains(wanted, F.col("_i").cast("long"))).drop("_i", "_n")


def _hits(words: list[str]) -> Column:
    bare = F.transform(tokens(F.lower("text")), lambda t: F.regexp_replace(F.regexp_replace(t, "^[.,;:()'’]+", ""), "[.,;:()'’]+$", ""))
    vocabulary = F.array(*map(F.lit, words))
    return F.size(F.filter(bare, lambda t: F.array_contains(vocabulary, t)))


def average_sentence(text: Column) -> Column:
    parts = F.filter(F.transform(F.split(text, "[.!?]"), lambda s: F.size(tokens(s))), lambda n: n > 0)
    total = F.aggregate(parts, F.lit(0), lambda a, n: a + n)
    return F.when(F.size(parts) > 0, total / F.size(parts)).otherwise(0.0)


def page_stats(pages: DataFrame) -> DataFrame:
    """Words, markers, prose hints, sentence length, headers, numbered items and function words of each page."""
    t = F.col("text")
    markers = count(t, K.DOTTED) + count(t, K.CROSS_REF, "i") + count(t, K.PAREN_VARIANT) + count(t, POS_RUN)
    return pages.select(
        "book",
        "page_number",
        "was_ocr",
        "ocr_confidence",
        F.size(tokens(t)).alias("words"),
        markers.alias("markers"),
        (count(t, K.PROSE_HINT, "i") + count(t, K.NUMBERED)).alias("prose_hints"),
        average_sentence(t).alias("avg_sentence_len"),
        count(t, K.SECTION, "im").alias("section_headers"),
        count(t, K.NUMBERED_ITEM, "m").alias("numbered_items"),
        *[_hits(words).alias(f"{lang}_hits") for lang, words in K.FUNCTION_WORDS.items()],
    )


def is_like(marker_floor: int = K.MARKER_FLOOR) -> Column:
    """Does a page with statistics look like dictionary body?"""
    return (F.col("words") >= K.MIN_WORDS) & (F.col("markers") >= marker_floor) & (F.col("avg_sentence_len") <= K.SENTENCE_CEILING)


def unreadable(stats: DataFrame) -> DataFrame:
    return stats.where(F.col("was_ocr") & (F.coalesce("ocr_confidence", F.lit(0.0)) < K.BAD_PAGE)).select("book", "page_number")


def zone_split(likes: DataFrame) -> DataFrame:
    """likes(book, page_number, like) -> adds zone: front, body or back.

    The body runs from the first liked page with a liked neighbour after it (else from the book's start) to the last one
    with a liked neighbour before it (else to the end), padded by the mean distance of liked pages; no liked page: all front.
    """
    own, order = Window.partitionBy("book"), Window.partitionBy("book").orderBy("page_number")
    rows = likes.withColumn("_i", F.row_number().over(order) - 1).withColumn("_n", F.count("*").over(own))
    rows = rows.withColumn("_after", F.coalesce(F.lead("like").over(order), F.lit(False))).withColumn("_before", F.coalesce(F.lag("like").over(order), F.lit(False)))
    first = F.min(F.when(F.col("like"), F.struct(F.col("_i").alias("i"), F.col("_after").alias("near")))).over(own)
    last = F.max(F.when(F.col("like"), F.struct(F.col("_i").alias("i"), F.col("_before").alias("near")))).over(own)
    rows = rows.withColumn("_f", first).withColumn("_l", last).withColumn("_m", F.count_if("like").over(own))
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / F.col("_m")))
    start = F.greatest(F.lit(0), F.when(F.col("_f.near"), F.col("_f.i")).otherwise(0) - step)
    end = F.least(F.col("_n") - 1, F.when(F.col("_l.near"), F.col("_l.i")).otherwise(F.col("_n") - 1) + step)
    zone = F.when(F.col("_m") == 0, "front").when(F.col("_i") < start, "front").when(F.col("_i") > end, "back").otherwise("body")
    return rows.select("book", "page_number", "like", zone.alias("zone"))


def with_zones(stats: DataFrame, marker_floor: int = K.MARKER_FLOOR) -> DataFrame:
    zones = zone_split(stats.select("book", "page_number", F.coalesce(is_like(marker_floor), F.lit(False)).alias("like")))
    return stats.join(zones, ["book", "page_number"])


def book_kind(zoned: DataFrame) -> DataFrame:
    """Kind of each book, from its body pages or, without any, all scored ones."""
    rows = zoned.withColumn("_body", F.max((F.col("zone") == "body").cast("int")).over(Window.partitionBy("book")) == 1)
    rows = rows.where(~F.col("_body") | (F.col("zone") == "body"))
    prose = (F.col("prose_hints") >= 3) | (F.col("avg_sentence_len") > K.SENTENCE_CEILING)
    share = lambda c: F.avg(c.cast("double"))
    figures = rows.groupBy("book").agg(
        F.bool_or("_body").alias("has_body"),
        F.median("words").alias("words"),
        F.avg("markers").alias("markers"),
        share(prose).alias("prose"),
        share(F.col("like")).alias("dict_like"),
        share(F.col("section_headers") >= 1).alias("sectional"),
    )
    kind = (
        F.when(~F.col("has_body") & (F.col("words") >= K.MIN_WORDS), "teaching_book")
        .when(~F.col("has_body"), "unknown")
        .when((F.col("words") < 60) & (F.col("markers") < 3), "kids_picture_book")
        .when((F.col("sectional") >= 0.15) & ((F.col("prose") >= 0.3) | (F.col("sectional") >= 0.5)), "grammar_morphology")
        .when((F.col("dict_like") < 0.5) & (F.col("prose") >= 0.5), "grammar_morphology")
        .when((F.col("dict_like") >= 0.2) & (F.col("prose") >= 0.2), "mixed")
        .otherwise("dictionary")
    )
    return figures.withColumn("book_kind", kind)


def book_conventions(zoned: DataFrame) -> DataFrame:
    """Layout figures of the body: markers a page and in all, numbered-list pages, function words."""
    body = zoned.where("zone = 'body'")
    return body.groupBy("book").agg(
        F.count("*").alias("pages"),
        F.avg("markers").alias("markers_per_page"),
        F.sum("markers").alias("markers_total"),
        F.count_if(F.col("numbered_items") >= 5).alias("numbered_pages"),
        *[F.sum(f"{lang}_hits").alias(f"{lang}_hits") for lang in K.FUNCTION_WORDS],
    )


def suggestions(kinds: DataFrame, conventions: DataFrame) -> DataFrame:
    """Settings to try for each book, in order."""
    rows = kinds.select("book", "book_kind").join(conventions, "book", "left")
    langs = F.array_compact(F.array(*[F.when(F.col(f"{lang}_hits") > 0, F.lit(lang)) for lang in K.FUNCTION_WORDS]))
    odd = F.col("book_kind").isin("kids_picture_book", "grammar_morphology", "teaching_book")
    lines = F.array(
        F.when(F.col("markers_total") > 0, F.concat(F.lit(f"split_before: `{K.SPLIT_BEFORE}` ("), F.col("markers_total").cast("string"), F.lit(" markers)"))),
        F.when(F.size(langs) > 0, F.concat(F.lit("gloss languages: "), F.array_join(langs, ", "))),
        F.lit("check the text layer of scanned pages by eye"),
        F.when(odd, F.concat(F.col("book_kind"), F.lit(": review the profile before extraction"))),
    )
    return rows.select("book", F.array_compact(lines).alias("suggestions"))


def profile_books(pages: DataFrame, marker_floor: int = K.MARKER_FLOOR) -> DataFrame:
    """One row a book: kind, pages of each zone, unreadable pages, figures and suggestions.

    Digital pages and a sample of the scanned ones are scored; the others count as not liked.
    """
    sample = page_sample(pages.where("was_ocr")).select("book", "page_number")
    scored = pages.where("not was_ocr").unionByName(pages.join(sample, ["book", "page_number"], "left_semi"))
    stats = page_stats(scored)
    likes = pages.select("book", "page_number").join(stats.select("book", "page_number", is_like(marker_floor).alias("_l")), ["book", "page_number"], "left")
    zones = zone_split(likes.select("book", "page_number", F.coalesce("_l", F.lit(False)).alias("like")))
    zoned = stats.join(zones, ["book", "page_number"])
    kinds = book_kind(zoned)
    in_zone = lambda z: F.array_sort(F.collect_list(F.when(F.col("zone") == z, F.col("page_number")))).alias(f"{z}_pages")
    parts = zones.groupBy("book").agg(in_zone("front"), in_zone("body"), in_zone("back"))
    bad = unreadable(stats).groupBy("book").agg(F.array_sort(F.collect_list("page_number")).alias("unreadable_pages"))
    figures = book_conventions(zoned)
    return (
        parts.join(kinds.select("book", "book_kind"), "book", "left")
        .withColumn("book_kind", F.coalesce("book_kind", F.lit("unknown")))
        .join(bad, "book", "left")
        .join(figures, "book", "left")
        .join(suggestions(kinds, figures), "book", "left")
    )
