"""python -m lexispark.cli extract | merge"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.functions.config import Language, Phonology
from lexispark.operators.merge import merge_books, merge_summary
from lexispark.operators.ocr import parse_pages
from lexispark.operators.profile import profile_books
from lexispark.plans.loop import run_quality_loop
from lexispark.sources import sinks
from lexispark.sources.books import infer_book_id, load_books, load_corpus, read_pages


def body_pages(pages: DataFrame, profiles: DataFrame) -> DataFrame:
    body = profiles.select("book", F.explode("body_pages").alias("page_number"))
    return pages.join(body, ["book", "page_number"], "left_semi")


def extract(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Profile, parse the body, loop, write; an empty corpus where there is no body."""
    phonology = Phonology.load(args.phonology) if args.phonology else Phonology()
    language = Language(args.lang_code, args.lang_name, args.lang_family, args.pivot_code, args.pivot_name)
    pages = read_pages(spark, args.pages)
    profiles = profile_books(pages)
    book = args.book_id or spark.range(1).select(infer_book_id(F.lit(args.pages))).first()[0]
    sinks.write_lines(sinks.profile_markdown(profiles), "markdown", f"{args.output_dir}/books/{book}/book_profile.md")
    good, bad = parse_pages(body_pages(pages, profiles))
    session = run_quality_loop(good, phonology, language.name, language.pivot_name, load_corpus(spark, args.existing_corpus), args.max_iterations)
    out = f"{args.output_dir}/books/{book}"
    sinks.write_corpus(session.entries, args.output_dir, language.code, book)
    sinks.write_flags(session.flags, f"{out}/flagged_terms.md")
    sinks.write_patterns(session.patterns, f"{out}/pattern_insights.md")
    sinks.write_lines(sinks.report_markdown(session.reports), "markdown", f"{out}/quality_reports.md")
    return {"entries": session.entries.count(), "bad_pages": bad.count(), "queued": session.queue.count()}


def merge(spark: SparkSession, args: argparse.Namespace) -> dict:
    entries = load_books(spark, args.output_dir)
    corpus = merge_books(entries)
    sinks.write_corpus(corpus.withColumnRenamed("pos", "part_of_speech"), args.output_dir, args.lang_code)
    sinks.write_lines(sinks.conflicts_markdown(corpus), "line", f"{args.output_dir}/merge_conflicts.md")
    return merge_summary(entries, corpus).first().asDict()


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="lexispark")
    verbs = out.add_subparsers(dest="verb", required=True)
    one = verbs.add_parser("extract")
    one.add_argument("--pages", "--pdf", dest="pages", required=True, help="page table, Parquet or JSON lines")
    one.add_argument("--book-id")
    one.add_argument("--lang-code", required=True)
    one.add_argument("--lang-name", required=True)
    one.add_argument("--lang-family", default="")
    one.add_argument("--pivot-code", default="ind")
    one.add_argument("--pivot-name", default="Bahasa Indonesia")
    one.add_argument("--phonology")
    one.add_argument("--existing-corpus")
    one.add_argument("--max-iterations", type=int, default=5)
    two = verbs.add_parser("merge")
    two.add_argument("--lang-code", required=True)
    for verb in (one, two):
        verb.add_argument("--output-dir", default="out")
    return out


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("lexispark").getOrCreate()
    print({"extract": extract, "merge": merge}[args.verb](spark, args))


if __name__ == "__main__":
    main()
