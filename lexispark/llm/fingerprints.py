"""Document fingerprints by consistent weighted sampling (Ioffe, ICDM 2010).

A text is a bag of words weighted by their counts; a word of more than LONG bytes counts as its consecutive pieces of
PIECE bytes, so that texts without spaces have terms too.  For each of SAMPLES hash functions a term of weight S draws
r, c ~ Gamma(2, 1) and b ~ U(0, 1) from its hash and takes t = floor(ln S / r + b), ln a = ln c - r (t - b) - r; the term
with the least a gives the sample (term, t).  Two texts agree on a sample with a probability equal to their generalised
Jaccard similarity, sum of min weights over sum of max weights.  A fingerprint holds 16 bits of each sample in hex, so
the share of equal samples estimates that similarity.

Defined results: texts without words, null and empty ones included, have the fingerprint "" and are like each other (1)
and unlike all others (0).  Equal texts have equal fingerprints.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import mix, slices, span_hashes, utf8, words

SAMPLES = 128
LONG, PIECE = 48, 16
#: Weighted terms whose draws a worker keeps.
REMEMBERED = 60_000
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of every distinct term, by row."""
    data, offsets = utf8(texts)
    starts, ends, row = words(data, offsets)
    if len(starts) and int((ends - starts).max()) > LONG:
        long = ends - starts > LONG
        count = np.where(long, -(-(ends - starts) // PIECE), 1)
        which = np.repeat(np.arange(len(starts)), count)
        k = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        starts, ends, row = np.where(long[which], starts[which] + k * PIECE, starts[which]), ends[which], row[which]
        ends = np.where(long[which], np.minimum(ends, starts + PIECE), ends)
    h = span_hashes(data, starts, ends)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], h[at], np.diff(np.append(at, len(h)))


class Sampler:
    def __init__(self, samples: int = SAMPLES):
        self.samples = samples
        self.seeds = mix(np.arange(1, 5 * samples + 1, dtype=np.uint64) * _GOLD).reshape(5, samples)
        self.place: dict[int, int] = {}
        self.level = np.zeros((0, samples), np.float32)
        self.code = np.zeros((0, samples), np.uint16)

    def draws(self, h: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ln a and 16 bits of (term, t), by term and sample."""
        u = [((mix(h[:, None] ^ s) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53 for s in self.seeds]
        r, b = -np.log(u[0] * u[1]), u[4]
        t = np.floor(np.log(weight)[:, None] / r + b)
        level = np.log(-np.log(u[2] * u[3])) - r * (t - b) - r
        code = mix(h[:, None] * _GOLD ^ t.astype(np.int64).view(np.uint64)) >> np.uint64(48)
        return level.astype(np.float32), code.astype(np.uint16)

    def fingerprints(self, texts: list[str]) -> list[np.ndarray | None]:
        row, h, n = terms(pa.array(texts, pa.large_string()))
        keys, which = np.unique(mix(h + n.astype(np.uint64) * _GOLD), return_inverse=True)
        first = np.zeros(len(keys), np.int64)
        first[which[::-1]] = np.arange(len(which))[::-1]
        names = keys.tolist()
        at = np.fromiter((self.place.get(k, -1) for k in names), np.int64, len(names))
        new = np.flatnonzero(at < 0)
        if len(self.level) + len(new) > REMEMBERED and len(self.level):
            self.place, new = {}, np.arange(len(keys))
            self.level, self.code = self.level[:0], self.code[:0]
        if len(new):
            made = [self.draws(h[first[new[k : k + 2048]]], n[first[new[k : k + 2048]]]) for k in range(0, len(new), 2048)]
            base = len(self.level)
            self.level = np.concatenate([self.level, *(m[0] for m in made)])
            self.code = np.concatenate([self.code, *(m[1] for m in made)])
            at[new] = np.arange(base, base + len(new))
            self.place.update(zip(keys[new].tolist(), at[new].tolist(), strict=True))
        rows, ends, out, every = at[which], np.searchsorted(row, np.arange(len(texts) + 1)), [], np.arange(self.samples)
        for k in range(len(texts)):
            own = rows[ends[k] : ends[k + 1]]
            if not len(own):
                out.append(None)
                continue
            best = own[:1].repeat(self.samples)
            for c in range(0, len(own), 4096):
                part = own[c : c + 4096]
                won = part[self.level[part].argmin(0)]
                best = np.where(self.level[won, every] < self.level[best, every], won, best)
            out.append(self.code[best, every])
        return out


def likeness(a: np.ndarray | None, b: np.ndarray | None) -> float:
    if a is None or b is None:
        return float(a is None and b is None)
    return float((a == b).mean())


def _hex(f: np.ndarray | None) -> str:
    return "" if f is None else f.astype(">u2").tobytes().hex()


_SAMPLERS: dict[int, Sampler] = {}


def _sampler(samples: int) -> Sampler:
    return _SAMPLERS.setdefault(samples, Sampler(samples))


def fingerprint(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs -> (doc_id, fingerprint)."""

    def run(batches):
        for batch in batches:
            _, offsets = utf8(batch.column(1))
            for i, j in slices(offsets, 1 << 20):
                made = _sampler(samples).fingerprints([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(map(_hex, made), pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)).mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """The last floor(n / 2) code points replaced by the first as many, or all, of the following text."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


def _with_next(samples: int):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def finish(rows, sampler):
        """rows: (doc_id, text, text of the next), which is the next row's text or, at the end of a range, one of its own."""
        texts, places, nexts = [], [], []
        for k, (_, text, following) in enumerate(rows):
            places.append(len(texts))
            texts.append(text)
            nexts.append(len(texts))
            if k + 1 == len(rows) or rows[k + 1][1] is not following:
                texts.append(following)
        changed = [edited(t, f) for _, t, f in rows]
        made = sampler.fingerprints(texts + changed)
        cols = [[], [], [], [], [], [], []]
        for k, (doc_id, text, _) in enumerate(rows):
            one, two, three = made[places[k]], made[len(texts) + k], made[nexts[k]]
            values = (doc_id, len(text), hashlib.sha256(changed[k].encode()).hexdigest(), _hex(one), _hex(two), likeness(one, two), likeness(one, three))
            for c, v in zip(cols, values, strict=True):
                c.append(v)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    def run(batches):
        sampler, held, ready, size = _sampler(samples), None, [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("bucket", "trailer", "doc_id", "text")]
            for bucket, trailer, doc_id, text in zip(*columns, strict=True):
                row = (bucket.as_py(), doc_id.as_py(), text.as_py() or "")
                if held and held[0] == row[0]:
                    ready.append((held[1], held[2], row[2]))
                    size += len(held[2])
                held = None if trailer.as_py() else row
                if size > 500_000:
                    yield finish(ready, sampler)
                    ready, size = [], 0
        if ready:
            yield finish(ready, sampler)

    return run


def compare_with_next(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint beside its edited text's and the next document's, in ascending doc_id (after the last: the first).

    Documents are dealt out by ranges of ids whose bounds are ids that occur; a document on a bound also goes to the range
    before, as the one that follows it there.  So texts are shuffled once and no task sorts more than a range.  A null id
    comes before all others; rows with equal ids follow each other by text.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = rows.select(key.alias("k")).agg(F.percentile_approx("k", [i / parts for i in range(1, parts)], 100 * parts).alias("b"), F.min("k").alias("m"))
    found = found.first()
    if found["m"] is None:
        bounds, least = [], 0
    else:
        bounds, least = sorted(set(found["b"]) - {found["m"]}), found["m"]
    b = F.array(*map(F.lit, bounds)).cast("array<long>")
    own = F.size(F.filter(b, lambda x: x <= key)) if bounds else F.lit(0)
    places = [F.struct(own.alias("bucket"), F.lit(False).alias("trailer"))]
    places.append(F.when(F.array_contains(b, key), F.struct((own - 1).alias("bucket"), F.lit(True).alias("trailer"))))
    places.append(F.when(key == least, F.struct(F.lit(len(bounds)).alias("bucket"), F.lit(True).alias("trailer"))))
    dealt = rows.withColumn("_p", F.explode(F.array_compact(F.array(*places)))).select("_p.bucket", "_p.trailer", "doc_id", "text")
    dealt = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "trailer", "doc_id", "text")
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(_with_next(samples), schema)
