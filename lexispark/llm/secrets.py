"""Secret scans: base patterns, and a character convolutional network over every other candidate in its context.

Candidates are runs of RUN or more characters of `[A-Za-z0-9+/_=.-]` with a letter and a digit in them that overlap no
base match.  The network reads the characters of a candidate and BESIDE on either side (embedding, one convolution, ReLU,
maximum over places, logistic output); of a long candidate it reads every window of WINDOW characters and the highest
score counts.  It is trained in numpy on labelled findings that a seeded generator writes (FINDINGS of them, a fixed
bound): keys, tokens and passwords in configuration lines and prose against identifiers, paths, versions, dates, numbers,
addresses and words.  Scores are calibrated by logistic (Platt) scaling on a second part, and the threshold is the
highest one that keeps a recall of RECALL on it.

Base spans always stay.  Positions are code points, ends exclusive.

Defined results: null and empty texts have no spans; kinds are searched apart and may overlap; very long texts are
searched whole, a fixed number of windows at a time; rows that repeat get equal results; an empty table gives an empty
result; extra columns, of any name, are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import slices, utf8

KINDS = ("assign", "access", "hex")
RUN, WINDOW, BESIDE = 16, 48, 24
FINDINGS, RECALL = 2400, 0.97
_ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=.-]{{{RUN},}}")
_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[[*b"0123456789abcdef"]] = True
_RUN_BYTE = np.zeros(256, bool)
_RUN_BYTE[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-"]] = True
_WORDS = ("passw", "secret", "token", "api")


# ---------------------------------------------------------------- base


def base_spans(text: str, lower: str | None = None, hexes: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    lower = text.lower() if lower is None else lower
    found = []
    if any(w in lower for w in _WORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if hexes:
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """base: sorted.  Spans are looked at from left to right, so this is linear."""
    out, at, reach = [], 0, 0
    for m in _CANDIDATE.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        word = m[0]
        if reach <= m.start() and any(c.isdigit() for c in word) and any(c.isalpha() for c in word):
            out.append(m.span())
    return out


def long_runs(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, least: int) -> np.ndarray:
    """Which rows have a run of at least so many bytes of a class."""
    inside = table[data].astype(np.int8)
    edge = np.diff(inside, prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    long = np.flatnonzero(ends - starts >= least)
    out = np.zeros(len(offsets) - 1, bool)
    first = np.searchsorted(offsets, starts[long], "right") - 1
    last = np.searchsorted(offsets, ends[long], "left") - 1
    for a, b in zip(first, last, strict=True):  # a run over the end of a row may be long in either
        out[a : b + 1] = True
    return out


# ---------------------------------------------------------------- network

_CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=.-:\"' @,;()[]{}<>|#$%&*!?~^\\\n\t"
_CODE = {c: i + 2 for i, c in enumerate(_CHARS)}
_WIDTH, _FILTERS, _DIM = 5, 24, 8
_LENGTH = WINDOW + 2 * BESIDE


def _view(text: str, start: int, end: int, at: int) -> tuple[list[int], list[int]]:
    """Codes and candidate mask of the window at a place; 0 pads, 1 is any other character."""
    low = at - BESIDE
    codes = [_CODE.get(text[i], 1) if 0 <= i < len(text) else 0 for i in range(low, low + _LENGTH)]
    return codes, [int(start <= i < end) for i in range(low, low + _LENGTH)]


def views(text: str, start: int, end: int) -> Iterator[tuple[list[int], list[int]]]:
    """The windows of a candidate, one after the other."""
    for at in range(start, max(end - WINDOW // 2, start + 1), WINDOW):
        yield _view(text, start, end, at)


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        n = _WIDTH * (_DIM + 1)
        self.p = {
            "e": r.normal(0, 0.5, (len(_CODE) + 2, _DIM)),
            "w": r.normal(0, (2 / n) ** 0.5, (n, _FILTERS)),
            "b": np.zeros(_FILTERS),
            "v": r.normal(0, 0.3, _FILTERS),
            "c": np.zeros(1),
        }
        self.scale, self.shift, self.threshold = 1.0, 0.0, 0.5

    def _forward(self, codes: np.ndarray, mask: np.ndarray):
        x = np.concatenate([self.p["e"][codes], mask[:, :, None]], 2)
        n = codes.shape[1] - _WIDTH + 1
        cols = np.stack([x[:, k : k + n] for k in range(_WIDTH)], 2).reshape(len(x), n, -1)
        z = cols @ self.p["w"] + self.p["b"]
        top = z.argmax(1)
        h = np.maximum(np.take_along_axis(z, top[:, None], 1)[:, 0], 0)
        return cols, top, h, h @ self.p["v"] + self.p["c"]

    def logits(self, codes: np.ndarray, mask: np.ndarray) -> np.ndarray:
        parts = [self._forward(codes[i : i + 256], mask[i : i + 256])[3] for i in range(0, len(codes), 256)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * logit + self.shift)))

    def train(self, codes: np.ndarray, mask: np.ndarray, y: np.ndarray, epochs: int = 12, seed: int = 11) -> None:
        r, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for _ in range(epochs):
            order = r.permutation(len(y))
            for i in range(0, len(y), 64):
                at = order[i : i + 64]
                cols, top, h, z = self._forward(codes[at], mask[at])
                d = (1 / (1 + np.exp(-z)) - y[at]) / len(at)
                g = {"v": h.T @ d, "c": d.sum(keepdims=True)}
                dh = d[:, None] * self.p["v"] * (h > 0)
                picked = np.take_along_axis(cols, top[:, :, None], 1)  # (case, filter, input)
                g["w"] = np.einsum("cfn,cf->nf", picked, dh)
                g["b"] = dh.sum(0)
                back = (dh[:, :, None] * self.p["w"].T[None]).reshape(len(at), _FILTERS, _WIDTH, _DIM + 1)[..., :_DIM]
                g["e"] = np.zeros_like(self.p["e"])
                where = codes[at][np.arange(len(at))[:, None, None], top[:, :, None] + np.arange(_WIDTH)]
                np.add.at(g["e"], where, back)
                step += 1
                for k in self.p:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    s[k] = 0.99 * s[k] + 0.01 * g[k] ** 2
                    self.p[k] -= 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)

    def calibrate(self, codes: np.ndarray, mask: np.ndarray, y: np.ndarray, recall: float = RECALL) -> None:
        z, a, b = self.logits(codes, mask), 1.0, 0.0
        for _ in range(50):  # Newton on the logistic loss, with a small ridge
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            g = np.array([((p - y) * z).sum() + 0.1 * (a - 1), (p - y).sum() + 0.1 * b])
            w = p * (1 - p)
            h = np.array([[(w * z * z).sum() + 0.1, (w * z).sum()], [(w * z).sum(), w.sum() + 0.1]])
            a, b = np.array([a, b]) - np.linalg.solve(h, g)
        self.scale, self.shift = float(a), float(b)
        good = np.sort(self.probability(z)[y == 1])
        self.threshold = float(good[int((1 - recall) * len(good))])


def findings(n: int = FINDINGS, seed: int = 5) -> list[tuple[str, int, int, int]]:
    """Labelled findings: (text, start, end, is it a secret?)."""
    r = np.random.default_rng(seed)

    def pick(chars: str, low: int, high: int) -> str:
        return "".join(r.choice(list(chars), int(r.integers(low, high + 1))))

    low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    word = lambda: pick("etaoinshrdlu", 2, 6) + pick("aeionrst", 1, 4)
    prose = lambda: " ".join(word() for _ in range(int(r.integers(3, 8))))
    secrets = (
        lambda: pick(low + up + num + "+/", 28, 64) + "=" * int(r.integers(0, 3)),
        lambda: pick(low + up + num, 20, 44),
        lambda: pick(up + num, 20, 40),
        lambda: "_".join([pick(low, 2, 4), pick(low, 3, 5), pick(low + up + num, 24, 36)]),
        lambda: ".".join(pick(low + up + num + "_-", 18, 40) for _ in range(3)),
        lambda: "-".join(pick(low + up + num, 10, 14) for _ in range(3)),
    )
    plain = (
        lambda: "_".join(word() for _ in range(int(r.integers(2, 5)))) + pick(num, 1, 3),
        lambda: "/".join(word() for _ in range(int(r.integers(3, 6)))) + f"{pick(num, 1, 2)}.{pick(low, 2, 3)}",
        lambda: f"{pick(num, 4, 4)}-{pick(num, 2, 2)}-{pick(num, 2, 2)}T{pick(num, 2, 2)}.{pick(num, 2, 6)}Z",
        lambda: f"{word()}-{pick(num, 1, 2)}.{pick(num, 1, 2)}.{pick(num, 1, 3)}-{word()}",
        lambda: ".".join([word(), f"{word()}{pick(num, 1, 2)}", word(), "com"]),
        lambda: word() + word() + pick(num, 1, 3) + word() + word(),
        lambda: "=".join([word() + word(), pick(num, 2, 8) + pick(low, 1, 3)]),
        lambda: f"{word().title()}{word().title()}{word().title()}{pick(num, 1, 2)}",
        lambda: "-" * int(r.integers(8, 20)) + word() + pick(num, 1, 3) + "." * int(r.integers(3, 9)),
    )
    around = ('key = "{}"', "auth: {}", "{}", "credential={}", "use {} here", "Bearer {}", "id {} of", "see {}.", '"{}",', "# {}")
    out = []
    for k in range(n):
        makers = secrets if k % 2 else plain
        value = makers[int(r.integers(len(makers)))]()
        before, after = around[int(r.integers(len(around)))].split("{}")
        front = prose() + " " + before if r.random() < 0.8 else before
        text = front + value + after + (" " + prose() if r.random() < 0.8 else "")
        out.append((text, len(front), len(front) + len(value), k % 2))
    return out


def _tensors(cases) -> tuple[np.ndarray, np.ndarray]:
    seen = [_view(t, s, e, s) for t, s, e, *_ in cases]
    return np.array([c for c, _ in seen], np.int64), np.array([m for _, m in seen], float)


@lru_cache
def trained(n: int = FINDINGS, recall: float = RECALL) -> Network:
    cases = findings(n)
    codes, mask = _tensors(cases)
    y, part = np.array([c[3] for c in cases], float), (np.arange(len(cases)) // 2) % 4
    net = Network()
    net.train(codes[part > 0], mask[part > 0], y[part > 0])
    net.calibrate(codes[part == 0], mask[part == 0], y[part == 0], recall)
    return net


def scored(text: str, spans: list[tuple[int, int]], net: Network) -> list[float]:
    """Calibrated probability of each candidate, the highest of its windows; so many windows are read together."""
    best, held = [0.0] * len(spans), []

    def read() -> None:
        p = net.probability(net.logits(np.array([c for _, (c, _) in held], np.int64), np.array([m for _, (_, m) in held], float)))
        for (k, _), x in zip(held, p.tolist(), strict=True):
            best[k] = max(best[k], x)
        held.clear()

    for k, (start, end) in enumerate(spans):
        for view in views(text, start, end):
            held.append((k, view))
            if len(held) == 256:
                read()
    if held:
        read()
    return best


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", net: Network | None = None) -> DataFrame:
    """docs -> doc_id, base and spans: arrays of (start, kind, end) by start, then kind."""
    shared = docs.sparkSession.sparkContext.broadcast(net or trained())
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])

    def rows(spans):
        return [{"start": s, "kind": k, "end": e} for s, k, e in spans]

    def run(batches):
        net = shared.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in slices(offsets):
                part = offsets[i : j + 1] - offsets[i]
                own = data[offsets[i] : offsets[j]]
                hexes, runs = long_runs(own, part, _HEX_BYTE, 24), long_runs(own, part, _RUN_BYTE, RUN)
                base, every = [], []
                for k, text in enumerate(batch.column(1).slice(i, j - i).to_pylist()):
                    found = base_spans(text, hexes=bool(hexes[k])) if text else []
                    more = []
                    if text and runs[k]:
                        spans = candidates(text, found)
                        for (s, e), p in zip(spans, scored(text, spans, net), strict=True):
                            if p >= net.threshold:
                                more.append((s, 2 if _HEX.fullmatch(text, s, e) else 1 if text[s:e].isupper() else 0, e))
                    base.append(rows(found)), every.append(rows(sorted(found + more)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(base, pa.list_(span)), pa.array(every, pa.list_(span))],
                    names=["doc_id", "base", "spans"],
                )

    inner = "array<struct<start:int,kind:int,end:int>>"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id long, base {inner}, spans {inner}"
    )


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query's contract."""
    names = F.array(*map(F.lit, KINDS))

    def joined(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")

    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )
