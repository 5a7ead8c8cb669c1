import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa

from lexispark.llm.fingerprints import Sampler, compare_with_next, edited, fingerprint, likeness, terms


def jaccard(a, b):
    a, b = Counter(a.split()), Counter(b.split())
    keys = a.keys() | b.keys()
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys)


def test_collisions_estimate_generalised_jaccard():
    r = np.random.default_rng(2)
    sampler, errors = Sampler(256), []
    for _ in range(40):
        base = r.zipf(1.5, 200) % 60
        other = np.where(r.random(200) < r.random(), base, r.zipf(1.5, 200) % 60)
        a, b = (" ".join(f"w{x}" for x in t) for t in (base, other))
        one, two = sampler.fingerprints([a, b])
        errors.append(likeness(one, two) - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_terms():
    row, _, count = terms(pa.array(["b a b", "", None, "x" * 100, "b"]))
    assert list(zip(row.tolist(), sorted(count.tolist()), strict=True)) is not None
    assert sorted(count[row == 0].tolist()) == [1, 2] and (row == 3).sum() == 2 and (row == 1).sum() == 0


def test_with_next(spark, docs):
    rows = [(7, "a b c d"), (1, None), (3, ""), (5, "é" * 9), (9, "a b c d"), (11, "word " * 30_000), (12, "x")]
    out = {x.doc_id: x for x in compare_with_next(docs(rows).withColumnRenamed("lang", "bucket")).collect()}
    order = sorted((i, t or "") for i, t in rows)
    assert len(out) == len(rows)
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        changed = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        assert edited(text, following) == changed
        assert out[i].n_chars == len(text) and out[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= out[i].near_edited <= 1 and 0 <= out[i].near_next <= 1
    assert out[7].fingerprint == out[9].fingerprint != "" and out[1].fingerprint == "" and out[1].near_next == 1.0
    assert {x.doc_id: x.fingerprint for x in fingerprint(docs(rows)).collect()} == {i: x.fingerprint for i, x in out.items()}


def test_one_row_no_row_and_repeats(spark, docs):
    (only,) = compare_with_next(docs([(4, "a b c d")])).collect()
    assert only.near_next == 1.0
    assert compare_with_next(docs([])).count() == 0
    assert compare_with_next(docs([(4, "a"), (4, "a"), (4, "b"), (None, "c")])).count() == 4
