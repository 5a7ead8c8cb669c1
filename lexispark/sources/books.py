"""Books from files: names in natural order, JSON lines, page tables, documents behind a decoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexispark.operators.ocr import needs_ocr

CORPUS = (
    "id string, headword string, pos string, gloss_pivot string, examples array<string>, page_ref int, confidence double, "
    "source_language string, source_book string, source_page int"
)
PAGES = "book string, page_number int, text string, was_ocr boolean, ocr_confidence double"


def infer_book_id(path: Column) -> Column:
    """File name without its ending, lower-cased; spaces and hyphens as single underscores, none at the ends."""
    name = F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")
    return F.trim(F.regexp_replace(F.translate(F.lower(name), " -", "__"), "_+", "_"), F.lit("_"))


def natural_order(files: DataFrame, name: str = "name") -> DataFrame:
    """Adds place: files with a leading number by that number and name, then the others by name."""
    prefix = F.nullif(F.regexp_extract(name, r"^\s*([0-9]+)", 1), F.lit("")).try_cast("decimal(38,0)")
    # One row a file of one folder: the window orders a listing, not data.
    order = Window.orderBy(prefix.asc_nulls_last(), F.col(name))
    return files.withColumn("place", F.row_number().over(order))


def list_documents(spark: SparkSession, source: str) -> DataFrame:
    """PDF files of a folder, or one file, in natural order; an error if there is none."""
    reader = spark.read.format("binaryFile")
    if not source.lower().endswith(".pdf"):
        reader = reader.option("pathGlobFilter", "[!.]*.[pP][dD][fF]")
    files = reader.load(source).select("path", F.element_at(F.split("path", "/"), -1).alias("name"))
    if files.isEmpty():
        raise FileNotFoundError(source)
    return natural_order(files)


def decode(spark: SparkSession, source: str, decoder: Callable[[bytes], Iterator[tuple[str | None, float | None]]]) -> DataFrame:
    """Pages of documents; decoder gives (text layer, OCR confidence or None) for each page of a file's bytes."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = [
                (path, i, text, conf is not None, conf)
                for path, content in zip(pdf["path"], pdf["content"], strict=True)
                for i, (text, conf) in enumerate(decoder(content), 1)
            ]
            yield pd.DataFrame(rows, columns=["path", "local_page", "text", "was_ocr", "ocr_confidence"])

    reader = spark.read.format("binaryFile").option("pathGlobFilter", "[!.]*.[pP][dD][fF]")
    pages = reader.load(source).select("path", "content").mapInPandas(
        run, "path string, local_page int, text string, was_ocr boolean, ocr_confidence double"
    )
    files = pages.groupBy("path").agg(F.max("local_page").alias("n_pages"))
    files = natural_order(files.withColumn("name", F.element_at(F.split("path", "/"), -1)))
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("path", F.coalesce(F.sum("n_pages").over(before), F.lit(0)).alias("_offset"))
    return pages.join(files, "path").withColumn("page_number", (F.col("local_page") + F.col("_offset")).cast("int")).drop("_offset")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A page table in Parquet or JSON lines."""
    return spark.read.schema(PAGES).json(path) if path.endswith((".json", ".jsonl")) else spark.read.parquet(path)


def probe_pages(pages: DataFrame) -> DataFrame:
    return needs_ocr(pages.withColumnRenamed("text", "digital_text"))


def _defaults(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.coalesce("id", F.lit("")).alias("id"),
        F.coalesce("headword", F.lit("")).alias("headword"),
        F.col("pos").alias("part_of_speech"),
        F.coalesce("gloss_pivot", F.lit("")).alias("gloss_pivot"),
        F.coalesce("examples", F.array().cast("array<string>")).alias("examples"),
        "page_ref",
        F.coalesce("confidence", F.lit(1.0)).alias("confidence"),
        F.coalesce("source_language", F.lit("")).alias("source_language"),
        F.coalesce("source_book", F.lit("")).alias("source_book"),
        "source_page",
        "book",
        F.coalesce("page_ref", F.lit(0)).alias("page_number"),
        "idx",
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """A place within the book from the id, as files have no order of lines that survives splitting."""
    return rows.withColumn("idx", F.row_number().over(Window.partitionBy("book", "page_ref").orderBy("id", "headword", "gloss_pivot")))


def load_corpus(spark: SparkSession, path: str | None) -> DataFrame | None:
    """A corpus in JSON lines with a fixed schema and defaults; None without a path.  Rows need headword and gloss."""
    if path is None:
        return None
    rows = spark.read.schema(CORPUS).json(path).withColumn("book", F.coalesce("source_book", F.lit("")))
    return _defaults(_numbered(rows.where("headword is not null and gloss_pivot is not null")))


def load_books(spark: SparkSession, root: str) -> DataFrame:
    """books/*/entries.jsonl below a root; the folder names the book where a row doesn't."""
    rows = spark.read.schema(CORPUS).json(f"{root}/books/*/entries.jsonl").withColumn("_path", F.col("_metadata.file_path"))
    book = F.regexp_extract("_path", r"/books/([^/]+)/entries\.jsonl", 1)
    rows = rows.withColumn("book", book).withColumn("source_book", F.coalesce(F.nullif("source_book", F.lit("")), "book"))
    return _defaults(_numbered(rows))
