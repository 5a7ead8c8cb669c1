import random
import re

import numpy as np
import pyarrow as pa
import pytest

from lexispark.llm import ngram_join as ngram_module
from lexispark.llm.common import Scratch
from lexispark.llm.ngram_join import Bands, _load, ngram_join, set_ids, shingle_sets, signatures


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) >= width:
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
    return {tuple(words)} if words else set()


def brute(rows, width, percent):
    sets = {i: shingles(t, width) for i, t in rows}
    ids, root = sorted(sets), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            same = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * same >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_against_brute_force(spark, docs, width, percent):
    r = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows, bases = [], [[r.choice(words) for _ in range(r.choice([3, 8, 30, 90, 200]))] for _ in range(12)]
    for i in range(150):
        base = list(r.choice(bases))
        for _ in range(r.choice([0, 0, 1, 2, 3, 6, 12])):
            base[r.randrange(len(base))] = r.choice(words)
        rows.append((i, " ".join(base)))
    rows += [(200, None), (201, ""), (202, " \n "), (203, "one"), (204, "ONE"), (205, "one two"), (206, "é" * 5000), (207, "É" * 5000)]
    expected = brute(rows, width, percent)
    out = ngram_join(docs(rows).withColumnRenamed("lang", "set_id"), percent, width).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out} == expected


def test_empty_and_repeated(spark, docs):
    assert ngram_join(docs([])).count() == 0
    out = ngram_join(docs([(5, "a b c d e f"), (5, "a b c d e f"), (2, "a b c d e f"), (None, None)])).collect()
    assert sorted((x.doc_id, x.component_id) for x in out if x.doc_id) == [(2, 2), (5, 2), (5, 2)]


def test_signatures_of_similar_sets_meet():
    r = np.random.default_rng(1)
    bands = Bands(85)
    for n in (1, 5, 6, 13, 60, 300, 700):
        for _ in range(30):
            a = r.integers(0, 2**63, n).astype(np.uint64)
            k = 0
            while (n - k - 1) / (n + k + 1) >= 0.85:
                k += 1
            b = a.copy()
            b[: k] = r.integers(0, 2**63, k).astype(np.uint64)
            assert set(signatures(np.sort(a), bands).tolist()) & set(signatures(np.sort(b), bands).tolist())
            low = a[: max(1, -(-85 * n // 100))]
            assert set(signatures(np.sort(a), bands).tolist()) & set(signatures(np.sort(low), bands).tolist())


def test_families_around_the_threshold(spark, docs):
    """Copies of copies, many of them just beyond the threshold of their centre: groups with several components are refined."""
    r = random.Random(11)
    words = [f"v{i}" for i in range(60)]
    rows, i = [], 0
    for _ in range(3):
        base = [r.choice(words) for _ in range(120)]
        variants = [base]
        for _ in range(70):
            copy = list(r.choice(variants))
            for _ in range(r.choice([1, 2, 3, 4, 5])):
                copy[r.randrange(len(copy))] = r.choice(words)
            variants.append(copy)
        for v in variants:
            rows.append((i, " ".join(v)))
            i += 1
    out = ngram_join(docs(rows), 80, 5).collect()
    expected = brute(rows, 5, 80)
    assert len({c for _, c in expected.values()}) > 20
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out} == expected


def test_rows_with_one_id_and_without(spark, docs):
    r = random.Random(5)
    one, two, three = (" ".join(r.choice(["a", "b", "c", "d", "e"]) + str(r.randrange(99)) for _ in range(80)) for _ in range(3))
    rows = [(5, one), (5, two), (7, one + " x"), (8, two + " y"), (9, three), (None, three + " z"), (None, "alone here"), (None, "alone here")]
    out = ngram_join(docs(rows), 85, 4).collect()
    found = sorted((x.doc_id or 0, x.component_id or 0) for x in out)
    assert found == [(0, 0), (0, 0), (0, 9), (5, 5), (5, 5), (7, 5), (8, 5), (9, 9)]


def hashed(text, width):
    return next(shingle_sets(pa.array([text]), width))[1]


def test_sets_alone_are_not_loaded(spark, docs):
    """Sets that meet by one signature but have most features to themselves don't go on; those that may link do."""
    r = random.Random(7)
    base, other = ([f"w{r.randrange(9999)}" for _ in range(200)] for _ in range(2))
    near = [*base[:190], *(f"x{i}" for i in range(10))]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(other))]
    scratch = Scratch(spark, "test")
    ids = {i: int(set_ids(h, np.array([len(h)]))[0]) for i, t in rows for h in [hashed(t, 4)]}
    classes = spark.createDataFrame([(s, i) for i, s in ids.items()], "set_id long, least long")
    loaded = _load(docs(rows).select("doc_id", "text"), classes, 4, 85, scratch)
    assert {x.set_id for x in loaded.collect()} == {ids[1], ids[2]}
    scratch.close()


def test_compared_pairs_are_done(spark, docs, monkeypatch):
    """Two sets that share a signature and don't link were compared, so nothing is left to refine."""
    r = random.Random(9)
    bands = Bands(85)
    base = [f"w{r.randrange(9999)}" for _ in range(200)]
    for cut in range(12, 40):
        pair = [" ".join(base), " ".join([*base[:-cut], *(f"x{i}" for i in range(cut))])]
        one, two = (shingles(t, 4) for t in pair)
        met = set(signatures(hashed(pair[0], 4), bands).tolist()) & set(signatures(hashed(pair[1], 4), bands).tolist())
        if 100 * len(one & two) < 85 * len(one | two) and met:
            break
    else:
        pytest.fail("no such pair")
    called = []
    monkeypatch.setattr(ngram_module, "_bounded", lambda rows, *rest: called.append(1) or rows)
    out = ngram_join(docs(list(enumerate(pair))), 85, 4).collect()
    assert sorted((x.doc_id, x.component_id) for x in out) == [(0, 0), (1, 1)]
    assert not called
