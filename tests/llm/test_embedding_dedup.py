import math

import numpy as np
import pytest

from lexispark.llm.embedding_dedup import CoverTree, dual, near_vectors


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def clustered(r, n, d=16):
    centres = r.normal(size=(6, d))
    return centres[r.integers(0, 6, n)] + r.normal(scale=r.choice([0.02, 0.1, 0.3, 1.0], (n, 1)), size=(n, d))


@pytest.mark.parametrize("seed", range(4))
def test_dual_traversal_is_exact(seed):
    r = np.random.default_rng(seed)
    a, b = unit(clustered(r, 300)), unit(clustered(r, 200))
    one, two = CoverTree(a), CoverTree(b)
    links_a, links_b, _ = dual(one, two, 0.93, False)
    close = a @ b.T >= 0.93
    assert (links_a == close.sum(1)).all() and (links_b == close.sum(0)).all()
    links, _, _ = dual(one, one, 0.93, True)
    assert (links == (a @ a.T >= 0.93).sum(1) - 1).all()


def test_tree_covers():
    r = np.random.default_rng(9)
    x = unit(clustered(r, 400))
    t = CoverTree(x)
    for node in range(len(t.centre)):
        apart = np.sqrt(np.maximum(2 - 2 * x[t.members(node)] @ x[t.centre[node]], 0))
        assert apart.max() <= t.radius[node] + 1e-12
        if t.children[node]:
            assert sorted(np.concatenate([t.members(c) for c in t.children[node]])) == sorted(t.members(node))


def test_frame_against_brute_force(spark):
    r = np.random.default_rng(4)
    x = clustered(r, 260, 8).astype(np.float32)
    x[250:] = x[3]
    labels = [None if i % 50 == 7 else int(i % 3 > 0) for i in range(260)]
    rows = [(i, x[i].tolist(), labels[i]) for i in range(260)]
    odd = [[0.0] * 8, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, None, [], [None] + [1.0] * 7, [1.0, 2.0]]
    rows += [(1000 + i, v, 1) for i, v in enumerate(odd)] + [(0, x[0].tolist(), labels[0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS block", "2 AS links")
    out = near_vectors(frame, block=64).collect()
    assert len(out) == len(rows)
    u = unit(x.astype(float))
    close = (u @ u.T >= 0.93) & np.array([[a is not None and a == b for b in labels] for a in labels])
    np.fill_diagonal(close, False)
    root = list(range(260))
    changed = True
    while changed:
        changed = False
        for i, j in zip(*np.nonzero(close), strict=True):
            low = min(root[i], root[j])
            changed |= root[i] != low or root[j] != low
            root[i] = root[j] = low
    for v in out:
        if v.vec_id < 260:
            assert (v.n_links, v.component_id, v.kept) == (close[v.vec_id].sum(), root[v.vec_id], root[v.vec_id] == v.vec_id)
        else:
            assert (v.n_links, v.component_id, v.kept) == (0, v.vec_id, True)
    assert near_vectors(frame.limit(0)).count() == 0


def test_double_precision(spark):
    """Cosines that differ only beyond single precision, and components beyond its range."""
    a, b = [1e300, 1e299], [2e300, 2e299]
    x = math.sqrt(1 - 0.93**2) / 0.93
    rows = [(1, a, 0), (2, b, 0), (3, [1.0, 0.0], 1), (4, [1.0, x * (1 - 1e-11)], 1), (5, [1.0, 0.0], 2), (6, [1.0, x * (1 + 1e-11)], 2)]
    out = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()}
    assert out == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5), 6: (0, 6)}
