"""What grows no faster than the input, and the same results by the ways that make it so."""

import glob
import os
from difflib import SequenceMatcher
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from lexispark.functions import constants as K
from lexispark.functions.config import Phonology
from lexispark.functions.text import rx, strip
from lexispark.operators import similarity, translation
from lexispark.operators.extract import extract_entries
from lexispark.operators.morphology import analyze_morphology
from lexispark.operators.patterns import hotspot, issue_hotspot, page_clusters
from lexispark.plans import fixtures as fx
from lexispark.plans.loop import run_quality_loop
from lexispark.plans.state import shared_dir

COLUMNS = "id string, headword string, gloss_pivot string, page_ref int, confidence double, book string, page_number int, idx int"


def entry(no, headword, gloss, book="src1", page=1):
    return (f"{no:016d}", headword, gloss, page, 1.0, book, page, no)


def test_entry_pattern_is_matched_once(spark, docs):
    pages = fx._numbered(docs([(1, "Word (n.) gloss.")]).select("source", "doc_id", "text")).withColumnRenamed("source", "book")
    pages = pages.withColumn("was_ocr", F.lit(False)).withColumn("ocr_confidence", F.lit(None).cast("double"))
    plan = analyze_morphology(extract_entries(pages))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(K.ENTRY[:20]) == 1


def test_separators_in_a_candidate(spark):
    text = "Word a\u0001b\u0001c.\nX\n \u0001Word gloss\nNa (n.) x\u0001"
    page = spark.createDataFrame([("b", 1, text, False, None)], "book string, page_number int, text string, was_ocr boolean, ocr_confidence double")
    got = [(r.headword, r.part_of_speech, r.gloss_pivot) for r in extract_entries(page).collect()]
    assert got == [("Word", None, "a\u0001b\u0001c"), ("X", None, "\u0001Word gloss"), ("Na", "n.", "x\u0001")]


def test_strip_is_that_of_the_pattern(spark):
    words = [(chr(c) + "a" + chr(c),) for c in [*range(0, 0x300), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF]]
    old = F.regexp_replace(F.regexp_replace("w", rx(r"^\s+"), ""), rx(r"\s+$"), "")
    assert spark.createDataFrame(words, "w string").where(strip(F.col("w")) != old).count() == 0


def test_pages_of_a_large_source_are_dealt_over_tasks(spark, docs):
    rows = [(i * 7, f"t{i}", "en", "hot") for i in range(1500)] + [(5, "u", "en", None), (None, "v", "en", "hot")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = fx._numbered(docs(rows).select("source", "doc_id", "text")).withColumn("p", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    hot = sorted((r for r in got if r.source == "hot"), key=lambda r: (r.doc_id is not None, r.doc_id))
    assert [r.page_number for r in hot] == list(range(1, 1502)) and len({r.p for r in hot}) > 1
    assert [r.page_number for r in got if r.source is None] == [1]


def test_conflicts_are_counted_not_listed(spark):
    rows = [entry(i, "the", f"gloss {i}", f"src{i % 2 + 1}", i // 10) for i in range(200)]
    every = spark.createDataFrame(rows, COLUMNS)
    new = fx.new_flags(every)
    assert new.count() <= 2 * 100 and new.agg(F.sum("n")).first()[0] == 100 * 100 + 99
    top = hotspot(new).first()
    assert (top.subject, top.n) == ("meaning_conflict", 10000)
    assert len(issue_hotspot(new).first().affected_entry_ids) == 10000
    assert page_clusters(new, every).agg(F.sum("n")).first()[0] == 10099


def test_notes_made_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(translation, "BLOCK", 40)
    glosses = ["b", "a", "é é", "b", "c", "c", "c", "d; e"]
    rows = [entry(i, "W" if i % 2 else "w", g) for i, g in enumerate(glosses)] + [entry(50, "one", "x"), entry(51, "one", "X ")]
    got = {r.entry_id: r.note for r in translation.gloss_conflicts(spark.createDataFrame(rows, COLUMNS)).collect()}
    want = {}
    for i, g in enumerate(glosses):
        rest = glosses[:i] + glosses[i + 1 :]
        order = [x for x in dict.fromkeys(glosses) if x in rest]
        want[f"{i:016d}"] = f"this gloss: {g}; other glosses: " + "; ".join(x + (f" (x{rest.count(x)})" if rest.count(x) > 1 else "") for x in order)
    assert got == want


def test_words_meet_in_what_is_left_of_them(spark):
    words = ["".join(p) for p in permutations("abcdef")]
    words += ["abcdefg", "a", "ab", "internationally-known", "internationaly-known", "internationalyknown", "congratulations", "congratulation"]
    frame = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, first int")
    near = similarity._by_rests(frame.withColumn("n", F.length("word")), 0.85, 0.85 / 1.15).distinct().count()
    assert near < 20 * len(words)
    got = {(r.left, r.right) for r in similarity.similar_pairs(frame, 0.85).collect()}
    assert got == {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if SequenceMatcher(None, a, b).ratio() >= 0.85}


@pytest.mark.parametrize("passes", [1, 3])
def test_loop_tells_texts_at_the_end(spark, passes):
    page = ("b", 1, "Word one gloss\nWord other gloss\nLow", True, 0.6)
    pages = spark.createDataFrame([page], "book string, page_number int, text string, was_ocr boolean, ocr_confidence double")
    done = run_quality_loop(pages, Phonology("abcdefghijklmnopqrstuvwxyz"), "L", "P", max_iterations=passes)
    rows = done.flags.collect()
    assert "low_confidence" in {r.issue_type for r in rows} and all(r.note and r.suggested_query for r in rows if not r.resolved)
    assert done.queue.count() == sum(not r.resolved for r in rows) > 0
    tables = max(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/new-*"), key=os.path.getmtime)
    assert not {"note", "suggested_query"} & set(spark.read.parquet(tables).columns)
