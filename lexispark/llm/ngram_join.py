"""N-gram Jaccard join with PartEnum signatures (Arasu, Ganti and Kaushik, VLDB 2006).

Sets are the distinct word shingles of a text.  Sizes fall in bands [l, r] with r = floor(l / threshold); two sets that
reach the threshold lie in one band or in neighbouring ones, and their symmetric difference is at most
k = floor(2 (1 - t) / (1 + t) r) for the upper band's r.  The hashed feature domain is cut into n = k // 2 + 1 + 2 m
first-level parts.  Each part is cut into CELLS cells, and every subset of CELLS - 1 of them is enumerated; its content is
a signature.  A part in which two sets don't differ has all its signatures equal, one with a single differing feature has
one equal signature, so such sets have 2 n - k > 4 m equal signatures at least.  Each set leaves out its 2 m signatures of
the least content, which would meet by chance; so one equal signature always remains.  Every set gets the signatures of
its own band and of the next one.

Sets that share a signature are candidates.  Many meet by chance, and the more the larger the table, so sets go first that
have too many features of their own among those with an even hash: a link leaves 1 - t of a set's features to it alone, of
whichever features one looks at (see `_load`).  Candidates aren't paired within a group: a group's members are checked with one
centre, which needs no more, and groups whose other members are then connected are done, such as all of two sets.  From
the others go the sets whose features other components
don't have (see `_bounded`); what is left is paired by rare features in which sets differ from their centre (see `_rest`).
Checks compare whole sets; only a parity sketch (the bits in which two sketches differ are never more than the features in
which the sets do) may rule out a pair before.  So every pair that links is either checked or inside one component already.

Defined results: null, empty and blank texts have no shingles, are linked with nothing and are their own component;
texts with fewer words than a shingle have the whole sequence as their one shingle; very long texts are taken whole;
repeated rows and equal texts share a component; rows with one doc_id and different texts, and rows with a null doc_id,
take part one by one, with their own set; a component's id is its smallest doc_id that isn't null, and null if it has
none; ties need no rule; an empty table gives an empty result; extra columns, of any name, are ignored.  Shingles and
whole sets are known by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.common import Scratch, forget, lists, mix, slices, span_hashes, utf8, words
from lexispark.llm.graph import components

SHINGLE = 5
THRESHOLD = 80
#: Second-level parts of a first-level part.
CELLS = 3
#: Pairs with one centre that are checked together.
TOGETHER = 256
#: 64-bit words of the sketch that conditions of a join compare.
SMALL = 16

_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, sorted distinct shingle hashes, sizes per row) for slices of a string column."""
    data, offsets = utf8(column)
    for i, j in slices(offsets):
        part = offsets[i : j + 1] - offsets[i]
        starts, ends, row = words(data[offsets[i] : offsets[j]], part)
        h = span_hashes(data[offsets[i] : offsets[j]], starts, ends, lower=True)
        count = np.bincount(row, minlength=j - i)
        if len(h) >= width:
            s = h[: len(h) - width + 1].copy()
            for k in range(1, width):
                s = mix(s * _STEP + h[k : len(h) - width + 1 + k])
            ok = row[: len(s)] == row[width - 1 :]
            s, r = s[ok], row[: len(ok)][ok]
        else:
            s, r = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        short = (count < width) & (count > 0)
        if short.any():
            extra, of = [], np.flatnonzero(short)
            first = np.searchsorted(row, of)
            for d, f in zip(of, first, strict=True):
                x = np.full(1, count[d], np.uint64)
                for k in range(count[d]):
                    x = mix(x * _STEP + h[f + k])
                extra.append(x[0])
            s, r = np.concatenate([s, np.array(extra, np.uint64)]), np.concatenate([r, of])
        order = np.lexsort((s, r))
        s, r = s[order], r[order]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
        s, r = s[keep], r[keep]
        yield i, s, np.bincount(r, minlength=j - i)


def set_ids(s: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name of each row's set."""
    total = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)), out=total[1:])
    ends = np.cumsum(sizes)
    return mix(total[ends] - total[ends - sizes] + sizes.astype(np.uint64) * _STEP).view(np.int64)


class Bands:
    def __init__(self, percent: int):
        self.t = Fraction(percent, 100)
        self.right = [1]

    def of(self, size: int) -> int:
        while self.right[-1] < size:
            self.right.append(max(self.right[-1] + 1, math.floor((self.right[-1] + 1) / self.t)))
        return int(np.searchsorted(self.right, size))

    def parts(self, band: int) -> tuple[int, int]:
        """(first-level parts, signatures left out)"""
        while len(self.right) <= band:
            self.of(self.right[-1] + 1)
        k = math.floor(2 * (1 - self.t) / (1 + self.t) * self.right[band])
        m = k // 24
        return k // 2 + 1 + 2 * m, 2 * m


def signatures(s: np.ndarray, bands: Bands) -> np.ndarray:
    """PartEnum signatures of one set of hashes."""
    out, at = [], bands.of(len(s))
    place, low, high = mix(s ^ _STEP), (s & np.uint64(0xFFFFFFFF)).astype(np.float64), (s >> np.uint64(32)).astype(np.float64)
    for band in (at, at + 1):
        n, less = bands.parts(band)
        cell = (place % np.uint64(n * CELLS)).astype(np.int64)
        count = np.bincount(cell, minlength=n * CELLS).reshape(n, CELLS)
        a, b = (np.bincount(cell, x, n * CELLS).astype(np.uint64).reshape(n, CELLS) for x in (low, high))
        which = np.arange(CELLS, dtype=np.uint64)
        content = mix(mix(mix(a + which) * _STEP + b) * _STEP + count.astype(np.uint64))
        without = content.sum(1, keepdims=True) - content  # each subset of CELLS - 1 cells
        tag = mix(np.uint64(band) * np.uint64(1 << 32) + np.arange(n, dtype=np.uint64))
        sig = mix(without * _STEP + tag[:, None] + which).ravel()
        emptiest = np.argsort((count.sum(1, keepdims=True) - count).ravel(), kind="stable")
        out.append(sig[emptiest[less:]])
    return np.concatenate(out)


def sketch(s: np.ndarray, bits: int = 0) -> np.ndarray:
    """Parity of the features at each of so many bits, by default the power of two from 4 to 8 for each feature, 256 at least."""
    bits = bits or max(256, 1 << (4 * len(s) - 1).bit_length())
    odd = np.bincount((mix(s + _STEP) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def apart(a: np.ndarray, b: np.ndarray) -> int:
    """A lower bound of the symmetric difference, from two sketches."""
    while len(a) != len(b):
        if len(a) < len(b):
            a, b = b, a
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _sizes(width: int):
    def run(batches):
        forget()
        for batch in batches:
            for i, s, n in shingle_sets(batch.column(1), width):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, len(n)), pa.array(n, pa.int64()), pa.array(np.where(n > 0, set_ids(s, n), 0), pa.int64())],
                    names=["doc_id", "n_shingles", "set_id"],
                )

    return run


def _signed(width: int, percent: int):
    def run(batches):
        forget()
        bands, seen = Bands(percent), set()
        for batch in batches:
            for _, s, n in shingle_sets(batch.column(0), width):
                names, ends, sig, who = set_ids(s, n), np.cumsum(n), [], []
                for k in np.flatnonzero(n):
                    if (name := int(names[k])) in seen:  # a copy within this task
                        continue
                    if len(seen) < 1_000_000:
                        seen.add(name)
                    sig.append(signatures(s[ends[k] - n[k] : ends[k]], bands))
                    who.append(np.full(len(sig[-1]), name))
                if sig:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(who))], names=["sig", "set_id"]
                    )

    return run


def _named(width: int):
    """Texts with their sets' names and sizes, and the features with an even hash."""

    def run(batches):
        forget()
        for batch in batches:
            for i, s, n in shingle_sets(batch.column(0), width):
                even = (s & np.uint64(1)) == 0
                row = np.repeat(np.arange(len(n)), n)[even]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_ids(s, n)), pa.array(n, pa.int64()), batch.column(0).slice(i, len(n)),
                     lists(s[even].view(np.int64), np.bincount(row, minlength=len(n)), pa.int64())],
                    names=["set_id", "n", "text", "even"],
                )

    return run


def _sets(width: int):
    def run(batches):
        forget()
        for batch in batches:
            for _, s, n in shingle_sets(batch.column(0), width):
                ends, some = np.cumsum(n), np.flatnonzero(n)
                made = [sketch(s[ends[k] - n[k] : ends[k]]) for k in some]
                bits = np.concatenate(made) if made else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(set_ids(s, n)[some]), pa.array(n[some], pa.int64()), lists(s.view(np.int64), n[some], pa.int64()),
                     lists(bits.view(np.int64), np.array([len(x) for x in made], np.int64), pa.int64())],
                    names=["set_id", "n", "items", "sketch"],
                )

    return run


def _views(column: pa.Array) -> list[np.ndarray]:
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
    return [values[i:j] for i, j in zip(offsets[:-1], offsets[1:], strict=True)]


def _near(percent: int):
    """Which pairs sizes and sketches let reach the threshold."""

    def run(batches):
        forget()
        for batch in batches:
            n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            ok = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            one, two = _views(batch.column("sketch_a")), _views(batch.column("sketch_b"))
            for k in np.flatnonzero(ok):
                ok[k] = (100 + percent) * apart(one[k], two[k]) <= (100 - percent) * (n[k] + m[k])
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok)], names=["a", "b", "near"])

    return run


def _compared(percent: int, differences: bool):
    """Links of pairs of whole sets; differences: also b's size, the features that only one of the two has, and a sketch of b."""

    def run(batches):
        forget()
        for batch in batches:
            ok, counts, parts, bits = np.zeros(len(batch), bool), np.zeros(len(batch), np.int64), [], []
            for k, (x, y) in enumerate(zip(_views(batch.column("items_a")), _views(batch.column("items_b")), strict=True)):
                only = np.setxor1d(x, y, assume_unique=True)
                ok[k] = (100 + percent) * len(only) <= (100 - percent) * (len(x) + len(y))
                if differences:
                    counts[k] = len(only)
                    parts.append(only)
                    bits.append(sketch(y, SMALL * 64))
            if differences:
                delta = lists(np.concatenate(parts or [np.zeros(0, np.uint64)]).view(np.int64), counts, pa.int64())
                small = lists(np.concatenate(bits or [np.zeros(0, np.uint64)]).view(np.int64), np.full(len(ok), SMALL), pa.int64())
                out = [batch.column("a"), batch.column("b"), batch.column("n_b"), pa.array(ok), delta, small]
                yield pa.RecordBatch.from_arrays(out, names=["g", "set_id", "n", "linked", "delta", "small"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(ok)], names=["a", "b", "linked"])

    return run


def _joined(pairs: DataFrame, sets: DataFrame, *columns: str) -> DataFrame:
    """pairs(a, b) with those columns of both sets; a set in many pairs as a is copied once for every TOGETHER of them."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / TOGETHER).alias("_n"))
    salted = pairs.join(salts, "a").withColumn("_salt", F.pmod(F.xxhash64("b"), "_n")).drop("_n")
    one = sets.select(F.col("set_id").alias("a"), *[F.col(c).alias(f"{c}_a") for c in columns])
    one = one.join(salts, "a").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n")
    two = sets.select(F.col("set_id").alias("b"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return salted.join(two, "b").join(one, ["a", "_salt"]).drop("_salt")


def _open(rows: DataFrame, label: DataFrame) -> DataFrame:
    """Rows of the groups g whose members are in several components, with their component."""
    rows = rows.drop("component").join(label.withColumnRenamed("node", "set_id"), "set_id", "left")
    rows = rows.withColumn("component", F.coalesce("component", "set_id"))
    return _several(rows, "g")


def _several(rows: DataFrame, *key: str) -> DataFrame:
    """Rows of the keys that several components share."""
    ends = rows.groupBy(*key).agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    return rows.join(ends.where("_low <> _high").select(*key).hint("shuffle_hash"), [*key])


def _bounded(rows: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """rows(g, set_id, component) without the sets that can't link with another component's.

    Such a link takes at least the threshold's share of a set's features, all of which another component among the rows
    must have too.  What goes makes others' features unshared, so this is done until few go.
    """
    before = None
    while True:
        own = scratch.table(rows.select("set_id", "component").distinct())
        n = own.count()
        if before is not None and n >= 0.9 * before:
            scratch.drop(own)
            return rows
        before = n
        items = sets.join(own, "set_id").select("set_id", "component", F.explode("items").alias("item"))
        able = _several(items, "item").groupBy("set_id").agg(F.count("*").alias("_shared")).join(sets.select("set_id", "n"), "set_id")
        able = able.where(100 * F.col("_shared") >= percent * F.col("n")).select("set_id")
        new = scratch.table(_several(rows.join(able, "set_id"), "g"))
        scratch.drop(own, rows)
        rows = new


def _centred(rows: DataFrame, weight: DataFrame) -> DataFrame:
    """(g, set_id, centre, members) of all but the centre of each group g: the member of the largest weight(set_id, weight),
    then id; members counts it too."""
    centre = rows.join(weight, "set_id").groupBy("g").agg(F.max(F.struct("weight", "set_id")).alias("_c"), F.count("*").alias("members"))
    centre = centre.select("g", F.col("_c.set_id").alias("centre"), "members")
    return rows.join(centre, "g").where("centre <> set_id").select("g", "set_id", "centre", "members")


def _rest(rows: DataFrame, weight: DataFrame, sets: DataFrame, label: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Components after all links between members of the groups g of rows(g, set_id).

    Every member of a group is compared with its centre c; groups with one centre become one.  Let D be what a set and c
    differ in, n its size and E = (100 + p) |D| - (100 - p) n.  Two members i and j link exactly if
    2 (100 + p) |Di & Dj| >= Ei + Ej.  A pair of different components has a member that c doesn't link with (a far one),
    for which Ei + Ej > 0, so the two share features of D.  Only features that several components have in D count (q of
    them).  By the prefix filter a pair shares one of the rarest q - o + 1 of each, with o the least overlap that any
    partner asks for: far sets for the others, all for far sets.  Pairs that meet in one of these features and may link by
    E, q, sizes and a parity sketch are checked.
    """
    star = scratch.table(_centred(rows, weight).select("centre", "set_id").distinct())
    found = _joined(star.select(F.col("centre").alias("a"), F.col("set_id").alias("b")), sets, "n", "items")
    found = scratch.table(found.mapInArrow(_compared(percent, True), "g long, set_id long, n long, linked boolean, delta array<long>, small array<long>"))
    label = _linked(label, found.where("linked").select(F.col("g").alias("a"), F.col("set_id").alias("b")), scratch)
    centre = label.select(F.col("node").alias("g"), F.col("component").alias("_of_centre"))
    far = F.col("component") != F.coalesce("_of_centre", "g")
    excess = (100 + percent) * F.size("delta").cast("long") - (100 - percent) * F.col("n")
    d = F.size("delta").cast("long")
    known = _open(found, label).join(centre, "g", "left")
    known = known.select("g", "set_id", "component", far.alias("far"), "n", d.alias("d"), excess.alias("excess"), "delta", "small")
    # Groups without a far member are done, as are members that share too little with any far one even if that has all of D.
    least_far = known.where("far").groupBy("g").agg(F.min("excess").alias("least_far"))
    twice = 2 * (100 + percent)
    known = known.join(least_far, "g").where(F.col("far") | (twice * F.col("d") >= F.col("excess") + F.col("least_far")))
    known = scratch.table(known.drop("d"))
    held = known.select("g", "set_id", "component", F.explode("delta").alias("item"))
    counts = held.groupBy("g", "item").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count("*").alias("_often"))
    held = held.drop("component").join(counts.where("_low <> _high").select("g", "item", "_often"), ["g", "item"])
    rarest = F.sort_array(F.collect_list(F.struct("_often", "item"))).alias("items")  # no longer than two sets
    held = scratch.table(held.groupBy("g", "set_id").agg(rarest))
    q = F.size("items").cast("long")
    members = held.join(known.drop("delta", "small"), ["g", "set_id"])
    members = members.where(F.col("far") | (twice * q >= F.col("excess") + F.col("least_far")))
    least = members.groupBy("g").agg(F.min("excess").alias("least"))
    partner = F.when(F.col("far"), F.col("least")).otherwise(F.col("least_far"))
    overlap = F.greatest(F.lit(1), F.ceil((F.col("excess") + partner) / twice))
    members = members.join(least, "g").withColumn("_take", (q - overlap + 1).cast("int")).where("_take > 0")
    members = members.select("g", "set_id", q.alias("q"), F.slice("items", 1, F.greatest(F.col("_take"), F.lit(0))).alias("items"))
    members = members.join(known.select("g", "set_id", "component", "far", "n", "excess", "small"), ["g", "set_id"])
    keyed = members.withColumn("item", F.explode("items.item")).drop("items")
    keyed = scratch.table(_several(keyed, "g", "item"))
    one, two = keyed.where("far").alias("x"), keyed.alias("y")
    able = (F.col("x.g") == F.col("y.g")) & (F.col("x.item") == F.col("y.item")) & (F.col("x.component") != F.col("y.component"))
    able &= ~F.col("y.far") | (F.col("x.set_id") < F.col("y.set_id"))
    able &= 100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")
    able &= twice * F.least("x.q", "y.q") >= F.col("x.excess") + F.col("y.excess")
    differ = sum(F.bit_count(F.col("x.small")[i].bitwiseXOR(F.col("y.small")[i])) for i in range(SMALL))
    able &= (100 + percent) * differ <= (100 - percent) * (F.col("x.n") + F.col("y.n"))
    pairs = scratch.table(one.join(two, able).select(F.least("x.set_id", "y.set_id").alias("a"), F.greatest("x.set_id", "y.set_id").alias("b")).distinct())
    near = _joined(pairs, sets, "n", "sketch").mapInArrow(_near(percent), "a long, b long, near boolean").where("near").select("a", "b")
    links = _joined(scratch.table(near), sets, "items").mapInArrow(_compared(percent, False), "a long, b long, linked boolean")
    label = _linked(label, links.where("linked").select("a", "b"), scratch)
    scratch.drop(rows, star, found, known, held, keyed)
    return label


def _linked(label: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """label(node, component) after more links(a, b), found on the graph of components."""
    ends = links.join(label.select(F.col("node").alias("a"), F.col("component").alias("_a")), "a", "left")
    ends = ends.join(label.select(F.col("node").alias("b"), F.col("component").alias("_b")), "b", "left")
    between = ends.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")).where("a <> b")
    between = scratch.table(between)
    if between.isEmpty():
        return label
    more = components(label.sparkSession, between, scratch).select(F.col("node").alias("component"), F.col("component").alias("_new"))
    nodes = label.unionByName(more.select(F.col("component").alias("node"), "component").join(label.select("node"), "node", "left_anti"))
    return scratch.table(nodes.join(more, "component", "left").select("node", F.coalesce("_new", "component").alias("component")))


def ngram_join(
    docs: DataFrame, threshold: int = THRESHOLD, width: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None
) -> DataFrame:
    """docs -> (doc_id, n_shingles, set_id, component_id), links where 100 |A ∩ B| >= threshold |A ∪ B|."""
    spark, docs = docs.sparkSession, docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    scratch = scratch or Scratch(spark, "ngram")
    sized = scratch.table(docs.mapInArrow(_sizes(width), "doc_id long, n_shingles long, set_id long"))
    classes = scratch.table(sized.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("least")))
    # Read twice from one shuffle: the signatures that several sets have, and the rows of these.
    signed = docs.select("text").mapInArrow(_signed(width, threshold), "sig long, set_id long").repartition("sig")
    ends = signed.groupBy("sig").agg(F.min("set_id").alias("_low"), F.max("set_id").alias("_high"))
    shared = signed.join(ends.where("_low <> _high").select("sig").hint("shuffle_hash"), "sig")
    shared = scratch.table(shared.select(F.col("sig").alias("g"), "set_id").distinct())
    weight = scratch.table(shared.groupBy("set_id").agg(F.count("*").alias("weight")))
    scratch.drop()  # the shuffle of all signatures
    sets = _load(docs, classes.join(weight, "set_id"), width, threshold, scratch)
    able = scratch.table(shared.join(sets.select("set_id"), "set_id", "left_semi").select("g", "set_id"))
    scratch.drop(shared)
    others = scratch.table(_centred(able, weight))
    scratch.drop(able)
    star = scratch.table(others.select(F.col("centre").alias("a"), F.col("set_id").alias("b")).distinct())
    near = _joined(star, sets, "n", "sketch").mapInArrow(_near(threshold), "a long, b long, near boolean").where("near").select("a", "b")
    near = scratch.table(near)
    scratch.drop(star)
    checked = _joined(near, sets, "items").mapInArrow(_compared(threshold, False), "a long, b long, linked boolean")
    checked = scratch.table(checked.where("linked").select("a", "b"))
    label = components(spark, checked, scratch)
    # The centre was compared with all of its group, so only the other members may hold pairs that are still open.
    rows = scratch.table(_open(others.where("members > 2").select("g", "set_id"), label))
    scratch.drop(others, near)
    if not rows.isEmpty():
        rows = _bounded(rows, sets, threshold, scratch)
        label = _rest(rows, weight, sets, label, threshold, scratch)
    of_set = classes.join(label.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    best = of_set.groupBy("component").agg(F.min("least").alias("component_id"))
    found = scratch.table(of_set.join(best, "component").select(F.col("set_id").alias("_set"), "component_id"))
    scratch.drop(classes, sets)
    return sized.join(found, (F.col("set_id") == F.col("_set")) & (F.col("n_shingles") > 0), "left").select(
        "doc_id", "n_shingles", "set_id", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _load(docs: DataFrame, classes: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """The whole sets of classes(set_id, least) that may link with another, one row each; a set is known by its own
    shingles, whatever its row's id.

    A set that links has at most 100 - percent of 100 features that its partner lacks, so it has no more than that which no
    other set here has.  Counting only features with an even hash finds fewer of these and so keeps all such sets.
    """
    ids = classes.select(F.col("least").alias("_id")).distinct()
    texts = docs.join(ids.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")
    named = scratch.table(texts.mapInArrow(_named(width), "set_id long, n long, text string, even array<long>"))
    scratch.drop()  # the shuffle of all texts
    held = named.select("set_id", "n", F.explode("even").alias("item")).groupBy("item").agg(F.count("*").alias("_often"), F.min(F.struct("set_id", "n")).alias("_of"))
    own = held.where("_often = 1").groupBy(F.col("_of.set_id").alias("set_id"), F.col("_of.n").alias("n")).agg(F.count("*").alias("_own"))
    alone = scratch.table(own.where(100 * F.col("_own") > (100 - percent) * F.col("n")).select("set_id"))
    able = classes.select("set_id").join(alone, "set_id", "left_anti")
    able = named.join(able, "set_id", "left_semi").dropDuplicates(["set_id"]).select("text")
    sets = scratch.table(able.mapInArrow(_sets(width), "set_id long, n long, items array<long>, sketch array<long>"))
    scratch.drop(named, alone)
    return sets
