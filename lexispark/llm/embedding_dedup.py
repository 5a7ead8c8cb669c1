"""Embedding near-dedup by cover-tree dual traversal.

Vectors are compared within a label only, as points on the unit sphere: cosine >= t is distance <= sqrt(2 - 2 t).  A label
is dealt by a hash into blocks of about BLOCK vectors.  Each block gets a cover tree: levels halve the radius, a node's
points lie within its radius of its centre, a centre stays the first child's centre, and centres of one level are further
apart than the radius of the next.  Each pair of a label's blocks is one unit of work, in which two trees are traversed
together: a node pair goes when its centres are further apart than the distance plus both covering radii, is linked as a
whole when no two of its points can be further apart than the distance, and is opened otherwise; small nodes are compared
point by point in double precision.  So pairs are exact, and no unit holds more than two blocks.  A unit returns a row
for each vector that has links there: how many, and the smallest id that its links reach there.

Defined results: a vector that is null, empty or zero, or has null or non-finite components, links with nothing, as does
one without a label or with another length than its fellow's.  Rows that repeat a vec_id are one vector, the least label
and vector of theirs.  Very long vectors are compared whole; an empty table gives an empty result; extra columns, of any
name, are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import Scratch
from lexispark.llm.graph import components

THRESHOLD = 0.93
BLOCK = 1024
LEAF = 48
_SLACK = 1e-7


class CoverTree:
    """Nodes in arrays; the points of a node are a range of `order`."""

    def __init__(self, points: np.ndarray):
        self.points, self.order = points, np.arange(len(points))
        self.centre, self.radius, self.low, self.high, self.children = [], [], [], [], []
        self._node(0, len(points), 0, 2.0)

    def _node(self, low: int, high: int, centre: int, cover: float) -> int:
        """Points order[low:high] lie within cover of points[centre]."""
        own = self.order[low:high]
        apart = _distance(self.points[own], self.points[centre][None])[:, 0]
        me = len(self.centre)
        self.centre.append(centre), self.radius.append(float(apart.max())), self.low.append(low), self.high.append(high)
        self.children.append([])
        if high - low <= LEAF or self.radius[me] <= _SLACK:
            return me
        cover = min(cover, self.radius[me]) / 2
        left, parts, at = own, [], centre
        while len(left):
            near = _distance(self.points[left], self.points[at][None])[:, 0] <= cover
            near |= left == at
            parts.append((at, left[near]))
            left = left[~near]
            if len(left):
                at = int(left[0])
        for at, members in parts:
            self.order[low : low + len(members)] = members
            self.children[me].append(self._node(low, low + len(members), at, cover))
            low += len(members)
        return me

    def members(self, node: int) -> np.ndarray:
        return self.order[self.low[node] : self.high[node]]


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def dual(a: CoverTree, b: CoverTree, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Links of each point of a and of b, and point pairs that connect what is linked; same: a is b."""
    links_a, links_b, joins = np.zeros(len(a.points), np.int64), np.zeros(len(b.points), np.int64), []
    most, stack = math.sqrt(2 - 2 * threshold), [(0, 0)]
    while stack:
        x, y = stack.pop()
        own, other = a.members(x), b.members(y)
        twin = same and x == y
        leaf_x, leaf_y = not a.children[x], not b.children[y]
        if leaf_x and leaf_y:
            close = a.points[own] @ b.points[other].T >= threshold
            if twin:
                np.fill_diagonal(close, False)
            links_a[own] += close.sum(1)
            if not twin:
                links_b[other] += close.sum(0)
            i, j = np.nonzero(close)
            if len(i):
                joins.append((own[i], other[j]))
            continue
        left = [x] if leaf_x else a.children[x]
        right = [y] if leaf_y else b.children[y]
        r, s = np.array([a.radius[k] for k in left]), np.array([b.radius[k] for k in right])
        apart = _distance(a.points[[a.centre[k] for k in left]], b.points[[b.centre[k] for k in right]])
        reach = r[:, None] + s[None]
        near = apart - reach <= most + _SLACK
        if twin:
            near = np.triu(near)
        whole = near & (apart + reach <= most - _SLACK)
        for i, j in zip(*np.nonzero(near), strict=True):
            p, q = left[i], right[j]
            if not whole[i, j]:
                stack.append((p, q))
                continue
            own, other = a.members(p), b.members(q)
            less = 1 if same and p == q else 0
            links_a[own] += len(other) - less
            if not less:
                links_b[other] += len(own)
            joins.append((own, np.full(len(own), other[0])))
            joins.append((np.full(len(other), own[0]), other))
    return (links_a + links_b if same else links_a), links_b, joins


def _least(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest point that each of n points is connected with."""
    label = np.arange(n)
    while True:
        new = label.copy()
        least = np.minimum(label[u], label[v])
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id")
    data = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
    return pd.DataFrame(
        {"label": [pdf["label"].iloc[0]], "width": [data.shape[1]], "n_blocks": [pdf["n_blocks"].iloc[0]], "block": [pdf["block"].iloc[0]],
         "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()], "data": [data.tobytes()]}
    )


def _unit(row) -> tuple[np.ndarray, CoverTree]:
    x = np.frombuffer(row.data, np.float64).reshape(-1, row.width)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return np.frombuffer(row.ids, np.int64), CoverTree(x / np.linalg.norm(x, axis=1, keepdims=True))


def _traversed(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(pdf.sort_values("block").itertuples())
        ids, tree = _unit(rows[0])
        if len(rows) == 1 and rows[0].low == rows[0].high:
            links, _, joins = dual(tree, tree, threshold, True)
            every = ids
        elif len(rows) == 1:  # the other block is empty
            return pd.DataFrame({"vec_id": [], "links": [], "least": []}).astype("int64")
        else:
            other, second = _unit(rows[1])
            one, two, joins = dual(tree, second, threshold, False)
            every, links = np.concatenate([ids, other]), np.concatenate([one, two])
            joins = [(u, v + len(ids)) for u, v in joins]
        rank = np.argsort(every)
        place = np.empty(len(every), np.int64)
        place[rank] = np.arange(len(every))
        u = place[np.concatenate([u for u, _ in joins] or [np.zeros(0, np.int64)])]
        v = place[np.concatenate([v for _, v in joins] or [np.zeros(0, np.int64)])]
        least = every[rank][_least(len(every), u, v)][place]
        some = links > 0
        return pd.DataFrame({"vec_id": every[some], "links": links[some], "least": least[some]})

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """vectors(vec_id, embedding, label) -> vec_id, n_links, component_id, kept."""
    scratch = Scratch(vectors.sparkSession, "vectors")
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    fit = whole.where(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & some & ~bad)
    least = F.min(F.struct("label", F.size("embedding").alias("width"), "embedding")).alias("_v")
    fit = scratch.table(fit.groupBy("vec_id").agg(least).select("vec_id", "_v.*"))
    counts = fit.groupBy(F.col("label").alias("_l"), F.col("width").alias("_w")).agg(F.ceil(F.count("*") / block).alias("n_blocks"))
    counts = scratch.table(counts)
    dealt = fit.join(counts, (F.col("label") == F.col("_l")) & (F.col("width") == F.col("_w")))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "vec_id"), "n_blocks")).select("vec_id", "label", "width", "n_blocks", "block", "embedding")
    label = fit.schema["label"].dataType.simpleString()
    blocks = dealt.groupBy("label", "width", "block").applyInPandas(
        _block, f"label {label}, width long, n_blocks long, block long, ids binary, data binary"
    )
    blocks = scratch.table(blocks)
    pairs = blocks.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
    pairs = pairs.withColumn("low", F.least("block", "_o")).withColumn("high", F.greatest("block", "_o"))
    found = pairs.groupBy("label", "width", "low", "high").applyInPandas(_traversed(threshold), "vec_id long, links long, least long")
    found = scratch.table(found)
    total = scratch.table(found.groupBy(F.col("vec_id").alias("_v")).agg(F.sum("links").alias("n_links")))
    label = components(vectors.sparkSession, found.select(F.col("vec_id").alias("a"), F.col("least").alias("b")), scratch)
    out = whole.select("vec_id").join(total, F.col("vec_id") == F.col("_v"), "left").join(label, F.col("vec_id") == F.col("node"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept")
    )
