"""Writers: JSON lines and Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.operators.flags import markdown_row
from lexispark.operators.patterns import ORDER


def as_corpus_row(entries: DataFrame) -> DataFrame:
    """Columns of the wire schema, confidence to three places."""
    return entries.select(
        "id", "headword", F.col("part_of_speech").alias("pos"), "gloss_pivot", "examples", "page_ref",
        F.round("confidence", 3).alias("confidence"), "source_language", "source_book", "source_page",
    )


def write_corpus(entries: DataFrame, output_dir: str, language_code: str, book_id: str | None = None) -> str:
    """A folder of JSON lines, replaced whole: one for the book, or one for the language."""
    path = f"{output_dir}/books/{book_id}/entries.jsonl" if book_id else f"{output_dir}/corpus_{language_code}.jsonl"
    as_corpus_row(entries).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_lines(rows: DataFrame, column: str, path: str) -> str:
    rows.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
    return path


def write_flags(flags: DataFrame, path: str) -> str:
    """A row of a Markdown table for each flag, in order."""
    rows = flags.orderBy("raised_at_pass", *ORDER).select(markdown_row().alias("line"))
    return write_lines(rows, "line", path)


def pattern_markdown() -> Column:
    ids = F.concat(F.array_join(F.slice("affected_entry_ids", 1, 10), ", "), F.when(F.size("affected_entry_ids") > 10, " ...").otherwise(""))
    return F.concat(
        F.lit("### "), "pattern_type", F.lit(" (confidence "), F.format_number("confidence", 2), F.lit("): "), "subject", F.lit("; "),
        "suggested_action", F.lit("; "), F.size("affected_entry_ids").cast("string"), F.lit(" entries: "), ids,
    )


def write_patterns(patterns: DataFrame, path: str) -> str:
    return write_lines(patterns.select(pattern_markdown().alias("line")), "line", path)


def page_range(pages: Column) -> Column:
    """N pages (a-b), page a, or none."""
    first, last = F.array_min(pages).cast("string"), F.array_max(pages).cast("string")
    many = F.concat(F.size(pages).cast("string"), F.lit(" pages ("), first, F.lit("–"), last, F.lit(")"))
    return F.when(F.size(pages) > 1, many).when(F.size(pages) == 1, F.concat(F.lit("page "), first)).otherwise("_none_")


def profile_markdown(profiles: DataFrame) -> DataFrame:
    """(book, markdown) for one row a book of operators.profile.profile_books."""
    zones = [F.concat(F.lit(f"- {z.title()}: "), page_range(F.col(f"{z}_pages"))) for z in ("front", "body", "back")]
    lines = F.array(
        F.concat(F.lit("# Book profile: "), "book"),
        F.concat(F.lit("**Kind:** "), "book_kind"),
        *zones,
        F.concat(F.lit("- Unreadable: "), F.coalesce(F.nullif(F.array_join("unreadable_pages", ", "), F.lit("")), F.lit("_none_"))),
        F.concat(F.lit("- Markers: "), F.coalesce(F.col("markers_total").cast("string"), F.lit("0"))),
    )
    every = F.concat(lines, F.transform(F.coalesce("suggestions", F.array().cast("array<string>")), lambda s: F.concat(F.lit("- "), s)))
    return profiles.select("book", F.array_join(every, "\n").alias("markdown"))


def report_markdown(reports: DataFrame) -> DataFrame:
    """(pass_number, markdown)."""
    names = ("entries_in", "entries_out", "typo_fixes_applied", "flags_raised", "flags_resolved", "patterns_spotted", "converged")
    lines = F.array(*[F.concat(F.lit(f"- {n}: "), F.col(n).cast("string")) for n in names])
    head = F.concat(F.lit("# Quality report, pass "), F.col("pass_number").cast("string"), F.lit("\n"))
    return reports.select("pass_number", F.concat(head, F.array_join(lines, "\n")).alias("markdown"))


def conflicts_markdown(corpus: DataFrame) -> DataFrame:
    """Lines for the conflicts of a merge, or one that says there are none."""
    rows = corpus.where("how = 'conflict'").select(F.concat(F.lit("| "), "headword", F.lit(" | "), "gloss_pivot", F.lit(" | "), "source_book", F.lit(" |")).alias("line"))
    none = corpus.sparkSession.range(1).select(F.lit("_No conflicts found._").alias("line"))
    return rows.unionByName(none.join(rows.limit(1).select(F.lit(1).alias("_x")), F.lit(True), "left_anti"))
