"""Entries from page text: candidate lines, chunks, matches and counters.

Pages have (book, page_number, text, was_ocr, ocr_confidence).  A page's candidates are made in one expression on its own
row, so nothing is shuffled; every entry carries its place (book, page_number, idx), which orders whatever follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions import constants as K
from lexispark.functions.text import entry_id, lines, rx, strip

#: Between the parts of an entry.
SEPARATOR = "\u0001"


def candidates_of(text: Column) -> Column:
    """Array of candidates: a line that starts in lower case continues the one before it."""
    joined = F.array_join(lines(text), "\n")
    glued = F.regexp_replace(joined, f"\n(?!{K.CANDIDATE_START})", " ")
    return F.filter(F.split(glued, "\n"), lambda x: x != "")


def chunks_of(text: Column, split_before: str) -> Column:
    """Array of chunks, cut before each place where split_before (a Java pattern without groups) matches."""
    parts = F.split(text, rx(f"(?={split_before})" if not split_before.startswith("(?=") else split_before))
    flat = F.transform(parts, lambda x: strip(F.regexp_replace(x, rx(r"\s+"), " ")))
    return F.filter(flat, lambda x: x != "")


def _found(split_before: str | None) -> Column:
    return chunks_of(F.col("text"), split_before) if split_before else candidates_of(F.col("text"))


def candidates(pages: DataFrame, split_before: str | None = None) -> DataFrame:
    """pages -> one row a candidate, with its idx on the page."""
    return pages.select("book", "page_number", "was_ocr", "ocr_confidence", F.posexplode(_found(split_before)).alias("idx", "candidate"))


def _cut(candidate: Column, entry_pattern: str | None) -> Column:
    """An empty string, headword, part of speech and gloss before stripping; one string where a candidate isn't an entry.

    The default pattern is matched once: it is anchored, and neither of its first two groups can hold the separator.
    """
    if entry_pattern:
        return F.array(F.lit(""), *[F.regexp_extract(candidate, rx(entry_pattern), k) for k in (1, 2, 3)])
    # Limit of 4 parts: the gloss keeps separators of its own.
    whole = F.regexp_replace(candidate, rx(K.ENTRY), f"{SEPARATOR}$1{SEPARATOR}$2{SEPARATOR}$3")
    return F.when(~candidate.startswith(SEPARATOR), F.split(whole, SEPARATOR, 4))


def matched(pages: DataFrame, entry_pattern: str | None = None, split_before: str | None = None, only_entries: bool = False) -> DataFrame:
    """pages -> candidates with oversized, headword, pos and gloss; headword is null where the candidate isn't an entry.

    All of it is made inside the generator, once a candidate: as columns over it, the patterns would be matched again for
    each filter that Spark pushes down to them.
    """
    cut = lambda c: F.when(F.length(c) <= K.OVERSIZE, _cut(c, entry_pattern))
    rows = F.transform(_found(split_before), lambda c, i: F.struct(i.alias("idx"), (F.length(c) > K.OVERSIZE).alias("oversized"), cut(c).alias("p")))
    part = lambda r, k: F.when(F.get(r["p"], F.lit(0)) == "", F.get(r["p"], F.lit(k)))
    rows = F.transform(
        rows,
        lambda r: F.struct(
            r["idx"].alias("idx"),
            r["oversized"].alias("oversized"),
            strip(part(r, 1)).alias("headword"),
            F.nullif(part(r, 2), F.lit("")).alias("part_of_speech"),
            strip(part(r, 3)).alias("gloss_pivot"),
        ),
    )
    good = lambda r: (r["headword"] != "") & (r["gloss_pivot"] != "")
    if only_entries:
        rows = F.filter(rows, good)
    found = pages.select("book", "page_number", "was_ocr", "ocr_confidence", F.explode(rows).alias("r"))
    when = lambda c: F.col(f"r.{c}") if only_entries else F.when(good(F.col("r")), F.col(f"r.{c}"))
    return found.select(
        "book", "page_number", "was_ocr", "ocr_confidence", "r.idx", "r.oversized", *[when(c).alias(c) for c in ("headword", "part_of_speech", "gloss_pivot")]
    )


def confidence() -> Column:
    own = F.when(F.col("was_ocr"), F.col("ocr_confidence"))
    return F.coalesce(F.when(own != 0, own), F.lit(1.0))


def extract_entries(pages: DataFrame, entry_pattern: str | None = None, split_before: str | None = None, language: str = "") -> DataFrame:
    """pages -> entries in the record schema, with book and place."""
    rows = matched(pages, entry_pattern, split_before, only_entries=True)
    return rows.select(
        entry_id(F.col("book"), F.col("page_number"), F.col("idx")).alias("id"),
        "headword",
        "part_of_speech",
        "gloss_pivot",
        F.array().cast("array<string>").alias("examples"),
        F.col("page_number").alias("page_ref"),
        confidence().alias("confidence"),
        F.lit(language).alias("source_language"),
        F.col("book").alias("source_book"),
        F.col("page_number").alias("source_page"),
        "book",
        "page_number",
        "idx",
    )


def extract_counters(pages: DataFrame, entry_pattern: str | None = None, split_before: str | None = None) -> DataFrame:
    """Entries, skipped and oversized candidates of each book."""
    rows = matched(pages, entry_pattern, split_before)
    return rows.groupBy("book").agg(
        F.count_if(F.col("headword").isNotNull()).alias("entries"),
        F.count_if(F.col("headword").isNull() & ~F.col("oversized")).alias("skipped"),
        F.count_if("oversized").alias("oversized"),
    )
