import hashlib
import re

from pyspark.sql import functions as F

from lexispark.llm import pii
from lexispark.llm.common import Scratch

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return 9 <= len(digits) <= 15 if kind == "phone" else True


def brute(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, text or "") if valid(k, m[0]))


TEXTS = [
    "mail a.b@c.example.com, x@y z@w.de. é a@b.c.x@y.z a@b.com%x@y.z",
    "1.2.3.4.5.6.7.8 300.1.1.1 001.02.255.0004 10.0.0.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111111111 4111111111111112 x4111111111111111y",
    "+1 (743) 555-3824 +12 +123456789 +1234567890123456 日本 +49 30 123456-78.",
    None,
    "",
    "a" * 20_000 + "@" + "b." * 3000 + "c",
    "1 " * 5000,
    "+" + "1-" * 4000 + "2",
    "none of it",
]


def test_base_against_re(spark, docs):
    rows = list(enumerate(TEXTS)) + [(0, TEXTS[0])]
    out = pii.digest(pii.find(docs(rows).withColumnRenamed("lang", "text_key"))).collect()
    assert len(out) == len(rows)
    for x in out:
        spans = brute(TEXTS[x.doc_id])
        assert x.base_sha256 == hashlib.sha256(spans.encode()).hexdigest(), x.doc_id
        assert [x.n_email, x.n_ip, x.n_card, x.n_phone] == [spans.count(f"{k}:") for k in BASE]
        assert set(spans.split(",")) <= set(x.spans.split(","))
    assert pii.find(docs([])).count() == 0


def test_patterns_find_unseen_identifiers(spark, docs):
    rows = [(i, f"please write to user{i}@mail.example.com for more help {i}") for i in range(12)]
    rows += [(50, "please write to someone@localhost for more help"), (51, "the price was 123456789 in all then"), (52, "meet me@home now")]
    out = {x.doc_id: x.spans for x in pii.digest(pii.find(docs(rows))).collect()}
    assert out[50] == "email:16:33" and out[51] == "" and out[52] == ""


def test_scores_against_brute_force(spark):
    mentions = [(0, f"v{i}", ["<a", ">b"]) for i in range(5)] + [(None, "n1", ["<a"]), (None, "n2", ["<c"]), (None, "n3", ["<a", ">b"])]
    frame = spark.createDataFrame(mentions, "kind int, value string, patterns array<string>")
    got = {x.value: x.score for x in pii.bootstrap(frame, Scratch(spark, "t")).collect()}
    values = {"<a": ["v0", "v1", "v2", "v3", "v4", "n1", "n3"], ">b": ["v0", "v1", "v2", "v3", "v4", "n3"]}
    score = {v: 1.0 for v in values[">b"][:5]}
    for _ in range(pii.ROUNDS):
        sure = {}
        for p, members in values.items():
            s = sum(score.get(v, 0) for v in members)
            sure[p] = s / len(members) * (1 - 1 / (1 + s))
        new = {"n1": sure["<a"], "n3": 1 - (1 - sure["<a"]) * (1 - sure[">b"])}
        score = {v: 1.0 for v in values[">b"][:5]} | new
    assert set(got) == {"n1", "n3"} and all(abs(got[k] - score[k]) < 1e-9 for k in got)


def test_no_python_in_the_plan(spark, docs):
    plan = pii.digest(pii.find(docs([(1, "a@b.c")])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_luhn(spark):
    frame = spark.createDataFrame([("4111111111111111",), ("4111111111111112",)], "d string")
    assert [r[0] for r in frame.select(pii.luhn(F.col("d"))).collect()] == [True, False]
