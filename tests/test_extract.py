import re

from pyspark.sql import functions as F

from lexispark.functions import constants as K
from lexispark.operators.extract import candidates_of, chunks_of, extract_counters, extract_entries

PAGES = "book string, page_number int, text string, was_ocr boolean, ocr_confidence double"


def model(text):
    """Candidates by the rule: a line in lower case goes on with the line before."""
    out = []
    for line in (x.strip() for x in text.splitlines()):
        if line and (not out or re.match(K.CANDIDATE_START, line)):
            out.append(line)
        elif line:
            out[-1] += " " + line
    return out


TEXTS = ["lower first\nUpper one\ngoes on\n\n  Next", "", "\n \n", "One\r\nTwo three\x0bFour", " Trimmed \nÀ la\nÉté", "a\nb\nc"]


def test_candidates(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", candidates_of(F.col("t")).alias("c")).collect()
    assert {r.t: r.c for r in rows} == {t: model(t) for t in TEXTS}


def test_chunks(spark):
    rows = spark.createDataFrame([("one  (1) two\n(1) three",)], "t string").select(chunks_of(F.col("t"), r"\(1\)").alias("c"))
    assert rows.first().c == ["one", "(1) two", "(1) three"]


def test_entries_and_counters(spark):
    text = "\n".join(["Bo (n.) house.", "Ka water", "123 no", "Lone", "X" + "y " * 450])
    pages = spark.createDataFrame([("b", 1, text, True, 0.6), ("b", 2, "Do (v) run.", False, None), ("b", 3, "Zu  z", True, 0.0)], PAGES)
    out = {r.headword: r for r in extract_entries(pages).collect()}
    assert {k: (r.part_of_speech, r.gloss_pivot, r.confidence) for k, r in out.items()} == {
        "Bo": ("n.", "house", 0.6),
        "Ka": (None, "water 123 no", 0.6),
        "Lon": (None, "e", 0.6),
        "Do": ("v", "run", 1.0),
        "Zu": (None, "z", 1.0),
    }
    assert out["Do"].source_book == "b" and out["Do"].source_page == 2
    c = extract_counters(pages).first()
    assert c.oversized == 1 and c.entries == 5
