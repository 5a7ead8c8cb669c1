"""Rules on small tables, each against what Python says."""

import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from lexispark.functions.config import Affixes, Phonology, to_java
from lexispark.functions.text import gloss_norm, key, strip
from lexispark.operators import conventions, crosscheck, flags, homonyms, merge, morphology, patterns, profile, translation
from lexispark.operators.correct import correct, typo_flags
from lexispark.operators.similarity import similar_pairs

ENTRY = (
    "id string, headword string, part_of_speech string, gloss_pivot string, examples array<string>, page_ref int, confidence double, "
    "source_language string, source_book string, source_page int, book string, page_number int, idx int"
)


@pytest.fixture(scope="module")
def entries(spark):
    def make(*rows, book="b"):
        """rows of (headword, gloss[, confidence[, book[, examples]]])"""
        full = []
        for i, r in enumerate(rows):
            where = r[3] if len(r) > 3 else book
            full.append((f"e{i}", r[0], None, r[1], r[4] if len(r) > 4 else [], i // 3, r[2] if len(r) > 2 else 1.0, "x", where, i // 3, where, i // 3, i))
        return spark.createDataFrame(full, ENTRY)

    return make


def test_text(spark):
    row = spark.createDataFrame([("  Äb..\n",)], "t string").select(strip(F.col("t")), key(F.col("t")), gloss_norm(F.col("t"))).first()
    assert tuple(row) == ("Äb..", "äb..", "äb")


def test_phonology():
    md = "## Valid characters\na b é (not q)\n## OCR confusion pairs\n- `rn` → `m`\n- `x` → ``\n## Digital text layer\ntrusted: no\n## Entry pattern\n- pattern: `(?P<headword>a)`\n"
    p = Phonology.parse(md)
    assert p.valid_chars == "abé" and p.confusion_pairs == [("rn", "m"), ("x", "")] and not p.digital_text_trusted and p.entry_pattern == "(?<headword>a)"
    assert to_java("(") is None and "q" in Phonology.parse(md, strict=True).valid_chars and Phonology.parse("").digital_text_trusted


def test_affixes():
    a = Affixes.parse("## Morphology\n- Prefixes: ka-, meN-\n- Suffixes: -an\n- Circumfixes: ke-...-an\n## Next\n- Prefixes: zz-\n")
    assert [r[:2] for r in a.rules] == [("prefix", "ka"), ("prefix", "men"), ("suffix", "-an"), ("circumfix", "ke-...-an")]
    assert Affixes.parse("nothing") == Affixes.default()


def test_correction(entries):
    p = Phonology("abm", [("rn", "m"), ("q", "z")])
    rows = entries(("barn", "g", 0.8), ("aqb", "g", 0.7), ("ab", "g", 0.76), ("barn", "g", 1.0))
    out = {r.id: r for r in correct(rows, p).collect()}
    assert out["e0"].headword == "bam" and out["e0"].confidence == pytest.approx(0.77) and not out["e3"].fixed
    found = sorted((r.entry_id, r.issue_type, r.needs_web_check) for r in typo_flags(correct(rows, p), 2).collect())
    assert found == [("e1", "low_confidence", True), ("e1", "ocr_typo", False)]


def test_crosscheck_compares_with_the_entry_before(entries):
    ids = lambda df: sorted(r.entry_id for r in df.collect())
    assert ids(crosscheck.duplicates(entries(("a", "X"), ("A ", "Y"), ("a", "x.")))) == ["e1", "e2"]
    assert ids(crosscheck.duplicates(entries(("a", "X"), ("a", "X."), ("a", "Y")))) == ["e2"]
    old = entries(("a", "X"), ("a", "Z"), ("b", "q"))
    assert sorted((r.entry_id, r.k) for r in crosscheck.conflicts(entries(("a", "Y"), ("a", "z..")), old).collect()) == [("e0", 1), ("e0", 2), ("e1", 1)]


def test_flag_state(entries):
    new = crosscheck.duplicates(entries(("a", "X"), ("a", "Y"), ("a", "X")))
    new = new.withColumn("attempted_fix", F.lit(None).cast("struct<before:string,after:string>"))
    first = flags.reconcile(flags.as_stored(new).where("false"), new.unionByName(new.withColumn("k", F.lit(1))))
    assert sorted(r.entry_id for r in first.collect()) == ["e1", "e2"]
    second = flags.reconcile(first, new.where("entry_id = 'e1'")).cache()
    assert {r.entry_id: (r.resolved, r.raised_at_pass) for r in second.collect()} == {"e1": (False, 1), "e2": (True, 1)}
    assert [r.entry_id for r in flags.web_queue(second).collect()] == ["e1"]
    e = second.sparkSession.createDataFrame([("e2", "seen", ["u"], False), ("e1", "ok", [], True), ("zz", "", [], True)], "entry_id string, evidence string, sources array<string>, resolves boolean")
    done = {r.entry_id: r for r in flags.apply_evidence(second, e).withColumn("status", flags.status()).collect()}
    assert done["e1"].status == done["e2"].status == "resolved (web)" and done["e1"].resolution_note == flags.BY_WEB


def test_patterns(entries):
    rows = entries(*[("barn", "g", 0.8)] * 4)
    found = patterns.spot_patterns(typo_flags(correct(rows, Phonology("x", [("rn", "m")]))), rows).collect()
    assert {r.pattern_type: (r.n, round(r.confidence, 6)) for r in found} == {
        "recurring_ocr_substitution": (4, 0.7),
        "bad_page_cluster": (3, 0.7),
        "issue_type_hotspot": (4, 1.0),
    }


def test_translation(entries):
    rows = entries(("a", "x"), ("Bx", "two words"), ("bX", "other"), ("run3", "the of and in"), ("McDonald", "ok"), ("lari", "ok", 1.0, "b", ["he ran", "dia lari"]))
    found = sorted((r.entry_id, r.stage) for r in translation.check_translations(rows).collect())
    assert found == [("e0", 1), ("e0", 5), ("e1", 2), ("e2", 2), ("e3", 4), ("e3", 5), ("e4", 5), ("e5", 3)]


def test_duplicate_headword_conflict(entries):
    rows = entries(("A", "x y"), ("a", "Other"), ("a", "x y"), ("b", "same"), ("b", "SAME"))
    out = {r.entry_id: r for r in translation.gloss_conflicts(rows, "english").collect()}
    assert set(out) == {"e0", "e1", "e2"} and {(r.issue_type, r.needs_web_check) for r in out.values()} == {("duplicate_headword", True)}
    assert out["e0"].suggested_query == '"A" meaning English OR "A" definition'
    assert out["e1"].note == "this gloss: Other; other glosses: x y (x2)" and out["e2"].note == "this gloss: x y; other glosses: x y; Other"


def test_first_conflicts(entries):
    r = random.Random(5)
    make = lambda n: [(r.choice("abc"), r.choice(["X", "x.", "Y", "Z", "z "])) for _ in range(n)]
    for n in (0, 1, 3, 30):
        new, old = entries(*make(20)), entries(*make(n)) if n else entries(("a", "X")).limit(0)
        every = crosscheck.conflicts(new, old, "l", "p").collect()
        want = {x.entry_id: (*x, sum(y.entry_id == x.entry_id for y in every)) for x in every if x.k == 1}
        assert {x.entry_id: tuple(x) for x in crosscheck.first_conflicts(new, old, "l", "p").collect()} == want


def test_suggested_patterns():
    refs = [{"marker": "see_also", "n": 2}, {"marker": "KS", "n": 1}, {"marker": "cf", "n": 0}]
    both = {"split_mode": "hybrid", "dotted_markers": True, "cross_refs": refs}
    assert conventions.suggest_split_pattern(both | {"split_mode": "line"}) is None and conventions.suggest_split_pattern({"split_mode": "marker"}) is None
    found = re.compile(conventions.suggest_split_pattern(both))
    assert [m.start() for m in found.finditer("a b •• c KS: d see_also e cf: f")] == [4, 9, 15]
    assert conventions.suggest_entry_pattern({}) is None
    entry = re.compile(conventions.suggest_entry_pattern({"dotted_markers": True, "has_hyphen": True}))
    assert entry.match("a •• kata-kata hati").group("headword", "gloss") == ("kata-kata hat", "i")


def test_homonyms(entries):
    rows = entries(("a", "big red house"), ("A", "big red barn"), ("b", "x"), ("b", "y"), ("colour", "q"), ("color", "q"))
    out = {(r.type, r.headword) for r in homonyms.analyze_homonyms(rows).collect()}
    assert out == {("polysemy", "a"), ("homonym", "b"), ("ocr_variant", "colour")}


def test_similarity_join_loses_nothing(spark):
    r = random.Random(1)
    words = sorted({"".join(r.choice("abcd") for _ in range(r.randint(1, 12))) for _ in range(120)})
    r.shuffle(words)
    frame = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, first int")
    got = {(x.left, x.right): x.ratio for x in similar_pairs(frame, 0.85).collect()}
    want = {(a, b): q for i, a in enumerate(words) for b in words[i + 1 :] if (q := difflib.SequenceMatcher(None, a, b).ratio()) >= 0.85}
    assert got == want


def test_morphology(entries):
    rows = entries(*[(w, "g") for w in ("bo-bo", "memakan", "makanan", "Bobo", "lari", "berlari", "kebaikan", "x")])
    out = {r.derived_form: (r.type, r.root, r.action) for r in morphology.analyze_morphology(rows).collect()}
    assert out["bo-bo"] == ("reduplication", "bo", "keep_as_entry") and out["Bobo"][1] == "Bo"
    assert out["memakan"] == ("prefix", "akan", "flag_as_variant") and out["makanan"] == ("suffix", "makan", "cross_reference")
    assert out["lari"] == ("suffix", "lar", "cross_reference") and "x" not in out


def test_zones(spark):
    r = random.Random(4)

    def model(like):
        n, liked = len(like), [i for i, x in enumerate(like) if x]
        if not liked:
            return ["front"] * n
        f = liked[0] if liked[0] + 1 < n and like[liked[0] + 1] else 0
        l = liked[-1] if liked[-1] > 0 and like[liked[-1] - 1] else n - 1  # noqa: E741
        step = max(1, n // len(liked))
        return ["front" if i < max(0, f - step) else "back" if i > min(n - 1, l + step) else "body" for i in range(n)]

    books = {f"b{k}": [r.random() < r.choice([0.05, 0.3, 0.8]) for _ in range(r.randint(1, 30))] for k in range(40)} | {"none": [False] * 4}
    frame = spark.createDataFrame([(b, i, x) for b, xs in books.items() for i, x in enumerate(xs)], "book string, page_number int, like boolean")
    out = {}
    for row in profile.zone_split(frame).collect():
        out[row.book, row.page_number] = row.zone
    assert out == {(b, i): z for b, xs in books.items() for i, z in enumerate(model(xs))}


def test_merge(entries):
    rows = entries(
        ("a", "One", 0.5, "b1", ["x1"]), ("A", "one", 0.9, "b2", ["y1"]),
        ("b", "first sense", 0.8, "b1", ["x"] * 7), ("b", "zweite", 0.6, "b2", ["y"] * 7), ("b", "third", 0.4, "b1"),
        ("c", "a long gloss here", 0.7), ("c", "a long gloss here.", 0.9), ("d", "only", 0.3),
    )
    out = {r.headword.lower(): r for r in merge.merge_books(rows).collect()}
    assert (out["a"].how, out["a"].gloss_pivot, out["a"].source_book) == ("same", "one", "b1,b2")
    assert out["a"].examples == ["y1"] and out["b"].examples == ["x"] * 7 + ["y"] * 3 and out["c"].examples == []
    assert out["b"].gloss_pivot == "(1) first sense; (2) third; (3) zweite" and out["b"].confidence == 0.6 and len(out["b"].examples) == 10
    assert (out["c"].how, out["c"].gloss_pivot, out["c"].confidence) == ("similar", "a long gloss here.", 0.9)
    assert (out["d"].how, out["d"].id) == ("single", "e7")
    assert merge.merge_summary(rows, merge.merge_books(rows)).first().asDict() == {"books": 3, "entries_in": 8, "entries_out": 4, "conflicts": 0}
    assert merge.merge_summary(rows.limit(0), merge.merge_books(rows.limit(0))).first().asDict() == dict.fromkeys(("books", "entries_in", "entries_out", "conflicts"), 0)
