"""Pages from text layers and OCR words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.functions import constants as K
from lexispark.functions.text import strip


def needs_ocr(probes: DataFrame) -> DataFrame:
    """A text layer under 200 stripped characters isn't used."""
    short = F.length(strip(F.coalesce("digital_text", F.lit("")))) < K.MIN_CONTENT
    return probes.withColumn("needs_ocr", short).withColumn("digital_text", F.when(~short, F.col("digital_text")))


def ocr_selected(probes: DataFrame, wanted: DataFrame) -> DataFrame:
    """Probes of the wanted (book, page_number) only; unknown numbers don't matter, each page comes once."""
    return probes.join(wanted.distinct(), ["book", "page_number"], "left_semi")


def page_text(words: DataFrame, *page: str) -> DataFrame:
    """Words (idx, word, conf) of each page joined in order; mean of the confidences from 0 up, over 100; else 0."""
    rows = words.where(strip(F.col("word")) != "")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("idx", "word"))), lambda x: x["word"])
    mean = F.avg(F.when(F.col("conf") >= 0, F.col("conf"))) / 100
    return rows.groupBy(*page).agg(F.array_join(ordered, " ").alias("text"), F.coalesce(mean, F.lit(0.0)).alias("ocr_confidence"))


def classify_pages(pages: DataFrame) -> DataFrame:
    """Adds page_class: digital, ocr or bad (a scan under 0.55)."""
    bad = F.col("was_ocr") & (F.coalesce("ocr_confidence", F.lit(0.0)) < K.BAD_PAGE)
    return pages.withColumn("page_class", F.when(bad, "bad").when(F.col("was_ocr"), "ocr").otherwise("digital"))


def parse_pages(pages: DataFrame, only_pages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad) pages, of the wanted ones if given."""
    if only_pages is not None:
        pages = pages.join(only_pages.select("book", "page_number").distinct(), ["book", "page_number"], "left_semi")
    rows = classify_pages(pages)
    return rows.where("page_class <> 'bad'").drop("page_class"), rows.where("page_class = 'bad'").drop("page_class")


def global_numbers(pages: DataFrame, files: DataFrame) -> DataFrame:
    """pages(book, file_no, local_page) and files(book, file_no, n_pages) -> page_number that runs on over a book's files."""
    from pyspark.sql import Window

    before = Window.partitionBy("book").orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    offset = files.select("book", "file_no", F.coalesce(F.sum("n_pages").over(before), F.lit(0)).alias("_offset"))
    return pages.join(offset, ["book", "file_no"]).withColumn("page_number", F.col("local_page") + F.col("_offset")).drop("_offset")
