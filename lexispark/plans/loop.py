"""The quality loop: extract once, then correct, cross-check and reconcile until a pass raises nothing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.functions import constants as K
from lexispark.functions.config import Phonology
from lexispark.operators.correct import correct, typo_flags
from lexispark.operators.crosscheck import crosscheck, digested
from lexispark.operators.extract import extract_entries
from lexispark.operators.flags import as_stored, escalate, reconcile, web_queue
from lexispark.operators.patterns import count_patterns, spot_patterns
from lexispark.plans.state import saved

#: What names a flag, and what is told of it.
FLAG = ["entry_id", "issue_type", "raised_at_pass", "k"]
TEXTS = ["note", "suggested_query"]


@dataclass
class Session:
    entries: DataFrame
    flags: DataFrame
    patterns: DataFrame
    reports: DataFrame
    queue: DataFrame


def run_quality_loop(
    pages: DataFrame,
    phonology: Phonology,
    language: str = "",
    pivot: str = "",
    corpus: DataFrame | None = None,
    max_iterations: int = K.MAX_PASSES,
) -> Session:
    """pages (good ones of the body) -> the session after the last pass.

    Only the counters of a pass come to the driver.  Each pass's entries and flags are written to the shared folder, the
    flags without their texts: these, and the ids of patterns, are made when the session's flags or patterns are read.
    """
    spark = pages.sparkSession
    entries = saved(extract_entries(pages, phonology.entry_pattern, phonology.entry_split), "entries")
    columns, stored, found, texts, reports = entries.columns, None, None, None, []
    small = None if corpus is None else digested(corpus)
    for number in range(1, max_iterations + 1):
        fixed = saved(correct(entries, phonology), "corrected")
        typo = typo_flags(fixed, number)
        new = typo.unionByName(crosscheck(digested(fixed), small, language, pivot, number), allowMissingColumns=True)
        new = saved(new.drop(*TEXTS), "new")
        told = typo.unionByName(crosscheck(fixed, corpus, language, pivot, number), allowMissingColumns=True).select(*FLAG, *TEXTS)
        texts = told if texts is None else texts.unionByName(told)
        before = stored if stored is not None else as_stored(new).where("false")
        stored = saved(reconcile(before, new), "flags")
        spotted = spot_patterns(new, fixed).withColumn("pass", F.lit(number))
        found = spotted if found is None else found.unionByName(spotted)
        counts = fixed.agg(F.count("*").alias("n"), F.count_if("fixed").alias("f")).first()
        raised = new.count()
        resolved = stored.where("resolved").count() - before.where("resolved").count()
        reports.append((number, counts["n"], counts["n"], counts["f"], raised, resolved, raised == 0, count_patterns(new, fixed)))
        entries = fixed.select(columns)
        if raised == 0:
            break
    names = "pass_number int, entries_in long, entries_out long, typo_fixes_applied long, flags_raised long, flags_resolved long, converged boolean, patterns_spotted long"
    report = spark.createDataFrame(reports, names)
    flags = stored.join(texts.dropDuplicates(FLAG), FLAG, "left")
    if number == max_iterations:
        flags = escalate(flags, language)
    return Session(entries, flags, found, report, web_queue(flags))
