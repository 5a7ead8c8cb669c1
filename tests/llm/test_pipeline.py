import corpus_pipeline as P
from lexispark.llm.common import Scratch
from tests.llm.test_langid import rows


def test_stages(spark, docs, tmp_path):
    base = [(i, t, lang, f"s{i % 3}") for i, t, lang in rows(12)]
    base += [(100 + i, f"unique{i} " + base[i][1], "en", "s0") for i in range(5)]
    base += [(200, None, None, None), (201, "1 2 3", None, "s1"), (202, base[0][1], None, "s9")]
    frame = docs(base)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    now, scratch, seen = frame, Scratch(spark, "t"), {}
    for name, stage in P.STAGES:
        now = scratch.table(stage(spark, now, str(tmp_path)))
        seen[name] = now
        if name != "tokens":
            assert now.columns == frame.columns
    ids = {k: {x.doc_id for x in v.collect()} for k, v in seen.items()}
    assert ids["language"] == {r[0] for r in base} - {200, 201}
    assert 202 not in ids["lines"] and 0 in ids["near_duplicates"]
    assert ids["mixture"] == ids["tokens"] <= ids["near_duplicates"]
    assert P.run(spark, str(tmp_path)).count() == seen["tokens"].count()


def test_near_duplicates_keep_one(spark, docs):
    text = " ".join(f"w{i}" for i in range(100))
    out = P.near_duplicates(spark, docs([(3, text), (1, text + " end"), (2, text), (9, "quite another text of six words"), (8, None), (None, "x")]), "")
    assert sorted((x.doc_id or -1) for x in out.collect()) == [-1, 1, 8, 9]


def test_empty(spark, docs):
    now = docs([])
    for _, stage in P.STAGES:
        now = stage(spark, now, "")
        assert now.count() == 0
