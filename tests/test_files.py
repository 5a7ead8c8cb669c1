import pytest
from pyspark.sql import functions as F

from lexispark.cli import main, parser
from lexispark.plans import fixtures as fx
from lexispark.plans.loop import run_quality_loop
from lexispark.sources import sinks
from lexispark.sources.books import decode, infer_book_id, list_documents, load_books, load_corpus, natural_order


def test_names(spark, tmp_path):
    rows = spark.createDataFrame([("/x/My Book--2.v1.PDF",), ("plain",), ("/a/_x_.pdf",)], "p string").select(infer_book_id(F.col("p"))).collect()
    assert [r[0] for r in rows] == ["my_book_2.v1", "plain", "x"]
    names = ["10 b.pdf", "2 a.pdf", "z.pdf", "02 b.PDF", "a.pdf", "1.pdf"]
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    assert [r.name for r in natural_order(frame).orderBy("place").collect()] == ["1.pdf", "02 b.PDF", "2 a.pdf", "10 b.pdf", "a.pdf", "z.pdf"]
    for n in (*names, ".hidden.pdf", "x.txt"):
        (tmp_path / n).write_bytes(b"p1\fp2")
    assert list_documents(spark, str(tmp_path)).count() == 6
    pages = decode(spark, str(tmp_path), lambda b: ((t, None) for t in b.decode().split("\f"))).collect()
    assert sorted(r.page_number for r in pages) == list(range(1, 13))
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        list_documents(spark, str(tmp_path / "none"))


def test_round_trip_and_merge(spark, tmp_path):
    rows = fx.entries(spark, "/root/testdata/sf0.001").where("book in ('src1', 'src2')")
    for book in ("src1", "src2"):
        sinks.write_corpus(rows.where(F.col("book") == book), str(tmp_path), "inv", book)
    back = load_books(spark, str(tmp_path))
    assert back.count() == rows.count() and {r.book for r in back.select("book").distinct().collect()} == {"src1", "src2"}
    main(["merge", "--lang-code", "inv", "--output-dir", str(tmp_path)])
    corpus = load_corpus(spark, str(tmp_path / "corpus_inv.jsonl"))
    assert 0 < corpus.count() < rows.count() and load_corpus(spark, None) is None


def test_loop_never_converges_with_a_duplicate(spark):
    pages = spark.createDataFrame([("b", 1, "Ab xx\nAb yy\nAb xx", False, None)], "book string, page_number int, text string, was_ocr boolean, ocr_confidence double")
    session = run_quality_loop(pages, fx.PHONOLOGY, "L", "P", max_iterations=2)
    assert [(r.flags_raised, r.flags_resolved, r.converged) for r in session.reports.collect()] == [(2, 0, False)] * 2
    assert {r.raised_at_pass for r in session.flags.collect()} == {1} and session.queue.count() == 2
    clean = run_quality_loop(pages.withColumn("text", F.lit("Ab xx")), fx.PHONOLOGY)
    assert [r.converged for r in clean.reports.collect()] == [True]


def test_cli_arguments():
    args = parser().parse_args(["extract", "--pages", "p", "--lang-code", "x", "--lang-name", "X"])
    assert args.max_iterations == 5 and args.pivot_code == "ind"
    with pytest.raises(SystemExit):
        parser().parse_args([])
