"""Line dedup by pairwise alignment.

A line goes if patience diff with any earlier document (smaller id) puts it in an aligned block: shared seeds (the k-th
occurrence with the k-th) in longest increasing order, grown over equal neighbours of any length.  A seed is a run of
consecutive lines, the shortest from its first line or to its last one that has RARE_WORDS words or more, so that two texts
rarely share it by chance: a long line alone, or short lines together.  Equal documents go at any number of words.

Not all pairs are aligned.  Of equal line sequences the first document stands for all, and the others go whole.  Each
document is aligned with the first holder of each of its seeds.  While a line of a seed is left, its document is then
aligned with the seed's other earlier holders, nearest first, 1, 2, 4, ... at a time, until its lines have gone or all were
tried.  So most seeds make one pair however common they are, and lines go or stay as they do if all pairs are aligned.
A line stays where every alignment has it out of order.

Defined results: a text of which all lines with words go becomes empty; null and empty texts stay; rows that repeat a
doc_id never count as later than each other, so equal rows stay equal; rows with a null doc_id, and those of an id that has
different texts, stay as they are, and nothing goes because of them; very long texts are aligned whole; an empty table
gives an empty result.  Extra columns stay as they are, except that columns named n_lines and n_removed are replaced.
Lines are known by 64-bit hashes.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lexispark.llm.common import _INV, WORD, Scratch, _power_tables, forget, mix, rows_of, slices, utf8

RARE_WORDS = 5


def _numbered_keys(keys):
    seen: dict[int, int] = {}
    for i, x in enumerate(keys):
        seen[x] = k = seen.get(x, -1) + 1
        yield i, (x, k)


def patience(a: list[int], b: list[int], seed: list[bool]) -> list[int]:
    """Places of b in the common blocks of a and b; seed: may this line of b start a block?"""
    places = {x: i for i, x in _numbered_keys(a)}
    return grown(a, b, [(places[x], j) for j, x in _numbered_keys(b) if seed[j] and x in places])


def windows(lines: list[int], words: list[int], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Starts, ends and hashes of the seeds of a text, and how many of them, the first ones, are the shortest from their starts."""
    n = len(lines)
    total = np.concatenate([[0], np.cumsum(np.array(words, np.int64))])
    ends = np.searchsorted(total, total[:-1] + least, "left")
    starts = np.flatnonzero(ends <= n)
    ends = ends[starts]
    back = np.searchsorted(total, total[1:] - least, "right") - 1
    to = np.flatnonzero(back >= 0)
    s, e = np.concatenate([starts, back[to]]), np.concatenate([ends, to + 1])
    pw, inverse = _power_tables(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(np.array(lines, np.int64).view(np.uint64) * pw[:n], out=sums[1:])
    h = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(_INV))
    return s, e, h.view(np.int64), len(starts)


def grown(a: list[int], b: list[int], anchors: list[tuple[int, int]]) -> list[int]:
    """Places of b in the blocks around the longest increasing chain of anchors (i, j), which are in the order of j."""
    tops, ends, back = [], [], {}
    for n, (i, _) in enumerate(anchors):
        k = bisect_left(tops, i)
        if k == len(tops):
            tops.append(i), ends.append(n)
        else:
            tops[k], ends[k] = i, n
        back[n] = ends[k - 1] if k else None
    chain, n = [], ends[-1] if ends else None
    while n is not None:
        chain.append(anchors[n])
        n = back[n]
    chain.reverse()
    out: set[int] = set()
    low = (-1, -1)
    for n, (i, j) in enumerate(chain):
        high = chain[n + 1] if n + 1 < len(chain) else (len(a), len(b))
        out.add(j)
        x, y = i - 1, j - 1
        while x > low[0] and y > low[1] and a[x] == b[y]:
            out.add(y)
            x, y = x - 1, y - 1
        x, y = i + 1, j + 1
        while x < high[0] and y < high[1] and a[x] == b[y]:
            out.add(y)
            x, y = x + 1, y + 1
        low = (x - 1, y - 1)
    return sorted(out)


def _aligned(least: int):
    def first_lines(lines, words):
        starts, _, h, n = windows(lines, words, least)
        starts = starts[:n].tolist()
        return [(starts[i], x) for i, x in _numbered_keys(h[:n].tolist())]

    def run(batches):
        forget()
        for rows in (r for batch in batches for r in rows_of(batch, "doc_id", "lines_a", "lines_b", "words_a", "words_b")):
            ids, gone = [], []
            for doc, a, b, words_a, words_b in rows:
                places = {x: i for i, x in first_lines(a, words_a)}
                ids.append(doc), gone.append(grown(a, b, [(places[x], j) for j, x in first_lines(b, words_b) if x in places]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], names=["doc_id", "gone"])

    return run


def _seeds(least: int, left: bool = False):
    """Seeds of each document; left: those with a line that isn't gone."""

    def run(batches):
        forget()
        for rows in (r for batch in batches for r in rows_of(batch, "doc_id", "lines", "words", *(["gone"] if left else []))):
            ids, found = [], []
            for doc, lines, words, *gone in rows:
                s, e, h, _ = windows(lines, words, least)
                if left:
                    stay = np.ones(len(lines), np.int64)
                    stay[gone[0]] = 0
                    stay = np.concatenate([[0], np.cumsum(stay)])
                    h = h[stay[e] > stay[s]]
                h = np.unique(h)
                ids.append(np.full(len(h), doc, np.int64)), found.append(h)
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(found))], names=["doc_id", "h"])

    return run


def _numbered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """rows(h, doc_id) with their place n in the order of h and doc_id; no task takes all rows of one h."""
    rows = rows.repartitionByRange("h", "doc_id").sortWithinPartitions("h", "doc_id")
    rows = scratch.table(rows.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    base, n = [], 0
    for p, size in sorted(rows.groupBy(part.alias("p")).agg(F.count("*").alias("c")).collect()):
        base.append((p, n - (p << 33)))
        n += size
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(base, "p long, base long")), part == F.col("p")).select(
        "h", "doc_id", (F.col("at") + F.col("base")).alias("n")
    )


def _pairs_left(once: DataFrame, seeds: DataFrame, holders: DataFrame, pairs: DataFrame, align, least: int, scratch: Scratch) -> list[DataFrame]:
    """What goes from each document, by the pairs of first holders and then by those that the lines left still need."""
    out, tried = [align(pairs, once)], pairs

    def left(docs, of):
        gone = out[0]
        for x in out[1:]:
            gone = gone.unionByName(x)
        gone = gone.join(docs, "doc_id", "left_semi").groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
        return of.join(gone, "doc_id").select("doc_id", "lines", "words", "gone").mapInArrow(_seeds(least, True), "doc_id long, h long")

    now = left(pairs.select(F.col("doc_b").alias("doc_id")).distinct(), once)
    now = scratch.table(now.join(holders, "h").where("first < doc_id").select("doc_id", "h"))
    if now.isEmpty():
        return out
    order = scratch.table(_numbered(seeds.join(now.select("h").distinct(), "h", "left_semi"), scratch))
    # The rounds only read documents with a seed that is left somewhere.
    live = scratch.table(once.join(order.select("doc_id").distinct(), "doc_id", "left_semi"))
    starts = order.groupBy("h").agg(F.min("n").alias("start"))
    # The row at start is the first holder, which has been tried.
    now = scratch.table(now.join(order, ["doc_id", "h"]).join(starts, "h").where("n - start > 1"))
    nearest = 1
    while not now.isEmpty():
        last = F.greatest(F.col("n") - (2 * nearest - 1), F.col("start") + 1)
        wanted = now.select(F.col("doc_id").alias("doc_b"), F.explode(F.sequence(last, F.col("n") - nearest)).alias("n"))
        more = wanted.join(order.select("n", F.col("doc_id").alias("doc_a")), "n").select("doc_a", "doc_b").distinct()
        more = scratch.table(more.join(tried, ["doc_a", "doc_b"], "left_anti"))
        tried = tried.unionByName(more)
        out.append(align(more, live))
        nearest *= 2
        rest = now.where(F.col("n") - nearest > F.col("start"))
        now = scratch.table(rest.join(left(rest.select("doc_id").distinct(), live), ["doc_id", "h"], "left_semi"))
    return out


def _without(text_at: int, names: list[str]):
    def run(batches):
        forget()
        for batch in batches:
            _, offsets = utf8(batch.column(text_at))
            for i, j in slices(offsets):
                texts, gone = batch.column(text_at).slice(i, j - i).to_pylist(), batch.column("__gone").slice(i, j - i).to_pylist()
                total, removed = [], []
                for k, (text, less) in enumerate(zip(texts, gone, strict=True)):
                    lines = text.split("\n") if text else []
                    total.append(len(lines)), removed.append(len(less) if less else 0)
                    if less:
                        less = set(less)
                        left = [x for n, x in enumerate(lines) if n not in less]
                        texts[k] = "\n".join(left) if any(x.strip() for x in left) else ""
                out = [c.slice(i, j - i) for c in batch.columns[:-1]]
                out[text_at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(
                    out + [pa.array(total, pa.int64()), pa.array(removed, pa.int64())], names=names + ["n_lines", "n_removed"]
                )

    return run


def line_dedup(
    docs: DataFrame, rare_words: int = RARE_WORDS, id_col: str = "doc_id", text_col: str = "text", scratch: Scratch | None = None
) -> DataFrame:
    """docs -> the same columns with the later copies of aligned lines gone, n_lines and n_removed."""
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    split = F.split(F.col(f"`{text_col}`").cast("string"), "\n", -1)
    lines = docs.where(F.length(f"`{text_col}`") > 0).select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.transform(split, lambda x: F.xxhash64(x)).alias("lines"),
        F.transform(split, lambda x: F.regexp_count(x, F.lit(WORD))).alias("words"),
    )
    lines = lines.where("doc_id is not null").withColumn("whole", F.xxhash64("lines", F.size("lines")))
    once = lines.groupBy("doc_id").agg(F.first("lines").alias("lines"), F.first("words").alias("words"), F.min("whole").alias("whole"), F.max("whole").alias("_other"))
    once = scratch.table(once.where("whole = _other").drop("_other"))
    firsts = once.groupBy("whole").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last").select("whole", "first")
    seeded = once.where("exists(words, x -> x > 0)").select("doc_id", "whole", F.size("lines").alias("n"))
    copies = scratch.table(seeded.join(firsts, "whole").where("doc_id > first").select("doc_id", "n"))
    once = scratch.table(once.drop("whole").join(copies.hint("merge"), "doc_id", "left_anti"))
    seeds = scratch.table(once.mapInArrow(_seeds(rare_words), "doc_id long, h long"))
    holders = scratch.table(
        seeds.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last").select("h", "first")
    )
    pairs = scratch.table(
        seeds.join(holders, "h").where("doc_id > first").select(F.col("first").alias("doc_a"), F.col("doc_id").alias("doc_b")).distinct()
    )

    def align(pairs, of):
        both = (
            pairs.join(of.select(F.col("doc_id").alias("doc_a"), F.col("lines").alias("lines_a"), F.col("words").alias("words_a")), "doc_a")
            .join(of.select(F.col("doc_id").alias("doc_b"), F.col("lines").alias("lines_b"), F.col("words").alias("words_b")), "doc_b")
            .select(F.col("doc_b").alias("doc_id"), "lines_a", "lines_b", "words_a", "words_b")
        )
        return scratch.table(both.mapInArrow(_aligned(rare_words), "doc_id long, gone array<int>").where("size(gone) > 0"))

    gone = copies.select("doc_id", F.sequence(F.lit(0), F.col("n") - 1).alias("gone"))
    for x in _pairs_left(once, seeds, holders, pairs, align, rare_words, scratch):
        gone = gone.unionByName(x)
    gone = scratch.table(gone.groupBy(F.col("doc_id").alias("__gone_id")).agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("__gone")))
    kept = [f for f in docs.schema.fields if f.name not in ("n_lines", "n_removed")]
    docs = docs.select(*[f"`{f.name}`" for f in kept])
    # Sorted and merged at every size: what is gone grows with the input.
    joined = docs.join(gone.hint("merge"), F.col(f"`{id_col}`").cast("long") == F.col("__gone_id"), "left").drop("__gone_id")
    schema = StructType(kept + [StructField("n_lines", LongType()), StructField("n_removed", LongType())])
    names = [f.name for f in kept]
    return joined.mapInArrow(_without(names.index(text_col), names), schema)
