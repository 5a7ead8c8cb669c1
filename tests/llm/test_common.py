import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lexispark.llm.common import Scratch, forget, remembered, rows_of, slices, span_hashes, utf8, words
from lexispark.llm.graph import components


@settings(max_examples=50, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t你", max_size=30)), max_size=12))
def test_words(texts):
    data, offsets = utf8(pa.array(texts, pa.string()))
    starts, ends, row = words(data, offsets)
    found = [(int(r), data[s:e].tobytes().decode()) for r, s, e in zip(row, starts, ends, strict=True)]
    assert found == [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    hashes = span_hashes(data, starts, ends).tolist()
    assert len(set(hashes)) == len({w for _, w in found}) and len({(h, w) for h, (_, w) in zip(hashes, found, strict=True)}) == len(set(hashes))


def test_blocks_agree():
    text = " ".join(f"word{i % 1000}" for i in range(400_000))
    data, offsets = utf8(pa.array([text]))
    starts, ends, _ = words(data, offsets)
    h = span_hashes(data, starts, ends)
    assert (h.reshape(400, 1000) == h[:1000]).all() and len(set(h.tolist())) == 1000
    assert (span_hashes(data, starts[-7:], ends[-7:]) == h[-7:]).all()
    lower = utf8(pa.array(["ABC abc Éx éx"]))
    s, e, _ = words(*lower)
    a = span_hashes(lower[0], s, e, lower=True)
    assert a[0] == a[1] and a[2] != a[3]


def test_slices():
    offsets = np.array([0, 5, 5, 20, 21, 22])
    assert list(slices(offsets, 6)) == [(0, 2), (2, 3), (3, 5)] and list(slices(np.array([0]))) == []


def test_rows_come_in_bounded_parts():
    batch = pa.RecordBatch.from_pydict({"k": [1, 2, 3, 4, 5], "a": [[1] * 9, None, [], [2, 3], [4]], "b": [[1], [2], [3], [4, 5], [6]]})
    parts = list(rows_of(batch, "k", "a", "b", most=5))
    assert [[r[0] for r in p] for p in parts] == [[1], [2, 3], [4], [5]]
    assert [r for p in parts for r in p] == [tuple(x.values()) for x in batch.to_pylist()]
    assert list(rows_of(batch.slice(3), "k", "a")) == [[(4, [2, 3]), (5, [4])]] and list(rows_of(batch.slice(5), "k", "a")) == []


def test_a_worker_keeps_one_thing():
    a = remembered(("a", 1), lambda: ["a"])
    assert remembered(("a", 1), list) is a and remembered(("b", 1), lambda: "b") == "b"
    assert remembered(("a", 1), lambda: "new") == "new"
    forget()
    assert remembered(("a", 1), lambda: "again") == "again"
    forget()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    frame = spark.createDataFrame(edges, "a long, b long")
    out = {x.node: x.component for x in components(spark, frame, Scratch(spark, "t")).collect()}
    assert out == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}
    assert components(spark, frame.limit(0), Scratch(spark, "t")).count() == 0
