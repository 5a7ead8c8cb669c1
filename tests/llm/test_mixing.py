import math
import random

import pytest
from pyspark.sql import functions as F

from lexispark.llm.common import Scratch
from lexispark.llm.mixing import entropy_mix, mixed, multipliers, rate, targets


def expected(own):
    """own: size by source in order -> targets."""
    weight = {s: i % 3 + 1 for i, s in enumerate(own)}
    left, free, out = sum(own.values()), set(own), {}
    while True:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * own[s] + 1e-9]
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = 3.0 * own[s]
            free.discard(s)
        left = sum(own.values()) - sum(out.values())


def rows(n=200):
    r = random.Random(5)
    return [(i, "w " * int(r.paretovariate(1.2) * 20), None, r.choice(["a", "a", "a", "b", "c", None, "tiny"] if i % 40 == 0 else ["a", "a", "b", "c"])) for i in range(n)]


def test_targets_rates_and_copies(spark, docs):
    data = rows()
    out = entropy_mix(docs(data).withColumnRenamed("lang", "copies")).collect()
    own = {}
    for s in sorted({r[3] for r in data} - {None}) + [None]:
        own[s] = sum(len(r[1].split()) for r in data if r[3] == s)
    goal = expected(own)
    assert len(out) == len(data)
    for s in own:
        group = [x for x in out if x.source == s]
        taken, least = sum(x.copies * x.size for x in group), min(x.size for x in group)
        assert abs(group[0].target - goal[s]) < 1e-6 * goal[s] and group[0].source_size == own[s]
        assert abs(taken - goal[s]) <= max(2 * least, 0.02 * goal[s]), (s, taken, goal[s])
    assert all(0 <= x.copies <= 3 for x in out)
    plan = {x.doc_id: x.copies for x in out}
    frame = docs(data).repartition(7).withColumn("__extra", F.lit(1))
    got = {}
    for x in mixed(frame).collect():  # another partitioning, another run
        got[x.doc_id] = got.get(x.doc_id, 0) + 1
    assert got == {i: c for i, c in plan.items() if c}


def tilted(sizes, target):
    """Rates nearest to 1 in relative entropy, between 0 and 3, that meet the target: by bisection on the one multiplier."""
    mean = sum(sizes) / len(sizes)
    low, high = -1e4, 1e4
    for _ in range(300):
        mid = (low + high) / 2
        w = [min(3.0, math.exp(min(700, mid * x / mean))) for x in sizes]
        low, high = (mid, high) if sum(a * x for a, x in zip(w, sizes)) < target else (low, mid)
    return w


def test_newton_finds_the_optimum(spark):
    r = random.Random(2)
    own = {"a": [r.randrange(1, 900) for _ in range(60)], "b": [7] * 9, "c": [1, 2, 3, 4000], "d": [5, 50, 500] * 40, "e": [0, 3, 9]}
    rows = [(s, x, own[s].count(x)) for s in own for x in sorted(set(own[s]))]
    classes = spark.createDataFrame(rows, "source string, size long, n long")
    scratch = Scratch(spark, "t")
    goals = expected({s: sum(v) for s, v in own.items()})
    found = multipliers(classes, targets(classes, scratch), scratch)
    out = classes.join(found, "source").withColumn("rate", rate(F.col("size"))).collect()
    assert len(out) == len(rows)
    for s, sizes in own.items():
        sizes = [x for x in sizes if x]
        best = dict(zip(sizes, tilted(sizes, goals[s]), strict=True))
        for x in out:
            if x.source == s and x["size"]:
                assert x.rate == pytest.approx(best[x["size"]], rel=1e-5, abs=1e-9), (s, x)
        # Moving words between two documents, so that the target is still met, takes the rates further from 1.
        w = list(best.items())
        def off(v):
            return sum(y * math.log(y) - y + 1 if y > 0 else 1 for y in v)
        for (x, p), (y, q) in zip(w, w[1:]):
            for step in (1e-4, -1e-4):
                p2, q2 = p + step / x, q - step / y
                if 0 <= p2 <= 3 and 0 <= q2 <= 3:
                    assert off([p2, q2]) * 1 >= off([p, q]) - 1e-7
    shrinks = sorted((x["size"], x.rate) for x in out if x.source == "a")
    assert goals["a"] < sum(own["a"]) and [w for _, w in shrinks] == sorted((w for _, w in shrinks), reverse=True)


def test_repeated_and_missing_ids_are_mixed(spark, docs):
    data = [(1, "a b c", None, "x"), (1, "d e", None, "x"), (None, "f g h", None, "x"), (None, "f g h", None, "x"), (2, "i", None, "y"), (3, None, None, "y")]
    frame = docs(data).withColumn("key", F.lit("k")).withColumn("copies", F.lit(9))
    plan = entropy_mix(frame)
    assert plan.count() == len(data)
    wanted = sum(x.copies * x.size for x in plan.collect())
    out = mixed(frame)
    assert out.columns == frame.columns and sum(len((x.text or "").split()) for x in out.collect()) == wanted > 0


def test_edges(spark, docs):
    out = {x.doc_id: x for x in entropy_mix(docs([(1, None, None, "a"), (2, "", None, "a"), (3, " \n", None, None)])).collect()}
    assert all((x.size, x.target, x.copies) == (0, 0.0, x.copies) for x in out.values())
    assert entropy_mix(docs([])).count() == 0
    data = [(i, "a b c d", None, "hot") for i in range(2500)] + [(5000 + i, "x y z", None, "z") for i in range(1000)]
    plan = entropy_mix(docs(data + [(1, "a b c d", None, "hot")] * 3))
    hot = plan.where("source = 'hot'").agg(F.sum(F.col("copies") * F.col("size")), F.max("target"), F.max("copies")).first()
    assert abs(hot[0] - hot[1]) <= 4 and hot[2] == 1
    text = plan._jdf.queryExecution().toString()
    assert not any(x in text for x in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
