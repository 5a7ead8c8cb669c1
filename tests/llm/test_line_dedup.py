from random import Random

from lexispark.llm.line_dedup import grown, line_dedup, patience


def test_patience():
    assert patience([1, 2, 3, 4], [9, 2, 3, 8], [True] * 4) == [1, 2]
    assert patience([1, 2, 3], [3, 1, 2], [True] * 3) == [1, 2]
    assert patience([1, 7, 2], [1, 7, 2], [True, False, True]) == [0, 1, 2]
    assert patience([7, 1], [7, 5], [False, True]) == []
    assert patience([1, 1, 2], [1, 2], [True, True]) == [0, 1]
    assert patience([], [1], [True]) == [] and patience([1], [], []) == []


def line(k, n=8):
    return " ".join(f"w{k}x{i}" for i in range(n))


def brute(rows):
    """Aligns each text with the first holder of each of its seed lines."""
    first, out = {}, {}
    for i, t in sorted(r for r in rows if r[0] is not None):
        for x in (t or "").split("\n"):
            if len(x.split()) >= 5:
                first.setdefault(x, i)
    text = dict(rows)
    for i, t in rows:
        own = (t or "").split("\n") if t else []
        gone = set()
        for holder in {first[x] for x in own if x in first and i is not None and first[x] < i}:
            gone |= set(patience(text[holder].split("\n"), own, [len(x.split()) >= 5 for x in own]))
        left = "\n".join(x for n, x in enumerate(own) if n not in gone)
        out[i] = (left if left.strip() else "") if gone else t, len(own), len(gone)
    return out


def test_against_brute_force(spark, docs):
    rows = [
        (1, "\n".join([line(1), "short", line(2), line(3)])),
        (2, "\n".join([line(9), line(1), "short", line(2), "other"])),
        (3, "\n".join([line(3), line(1)])),
        (4, "\n".join(map(line, (1, 2, 3)))),
        (5, "\n".join([line(9), "tail"])),
        (6, None),
        (7, ""),
        (8, line(4, 20_000)),
        (9, line(4, 20_000) + "\nnew"),
        (10, "short\nother"),
        (11, "\n\n" + line(1) + "\n\n"),
        (12, "\n".join(line(k) for k in range(100, 400))),
        (13, "\n".join(line(k) for k in range(200, 500))),
    ]
    frame = docs(rows).withColumnRenamed("lang", "__x").withColumnRenamed("source", "n_lines")
    out = {x.doc_id: (x.text, x.n_lines, x.n_removed) for x in line_dedup(frame).collect()}
    assert out == brute(rows)
    assert out[4][0] == "" and out[13][2] == 200 and out[10] == ("short\nother", 2, 0)


def test_many_sharers_empty_and_repeats(spark, docs):
    rows = [(i, f"{line(1)}\n{line(100 + i)}") for i in range(60)]
    out = {x.doc_id: x.n_removed for x in line_dedup(docs(rows)).collect()}
    assert out == {i: int(i > 0) for i in range(60)}
    assert line_dedup(docs([])).count() == 0
    same = line_dedup(docs([(1, line(1)), (1, line(1)), (None, line(1)), (2, line(1))])).collect()
    assert sorted((x.doc_id or 0, x.text) for x in same) == [(0, line(1)), (1, line(1)), (1, line(1)), (2, "")]


def every_pair(rows):
    """What goes from each text if it is aligned with all earlier ones."""
    out = {}
    for i, t in rows:
        own = t.split("\n")
        gone = set()
        for _, other in (r for r in rows if r[0] < i):
            gone |= set(patience(other.split("\n"), own, [len(x.split()) >= 5 for x in own]))
        out[i] = len(gone)
    return out


def test_seed_lines_go_as_if_all_pairs_were_aligned(spark, docs):
    x, y = "\n".join(map(line, (1, 2))), "\n".join(map(line, (3, 4)))
    rows = [(1, f"{x}\n{y}"), (2, f"{y}\n{x}"), (3, f"{y}\n{x}"), (4, f"{y}\n{line(9)}\n{x}"), (5, f"{line(9)}\n{x}\n{y}")]
    out = {r.doc_id: (r.text, r.n_removed) for r in line_dedup(docs(rows)).collect()}
    assert out[3] == ("", 4) and out[4] == (line(9), 4)
    rng = Random(5)
    rows = [(i, "\n".join(line(rng.randrange(7)) for _ in range(rng.randrange(1, 9)))) for i in range(120)]
    assert {r.doc_id: r.n_removed for r in line_dedup(docs(rows)).collect()} == every_pair(rows)


def runs(lines):
    """The k-th occurrence of each shortest run of lines with five words or more, by its first place."""
    out, seen = {}, {}
    for i in range(len(lines)):
        for j in range(i + 1, len(lines) + 1):
            if sum(len(x.split()) for x in lines[i:j]) >= 5:
                x = tuple(lines[i:j])
                seen[x] = k = seen.get(x, -1) + 1
                out[x, k] = i
                break
    return out


def test_short_lines_seed_together(spark, docs):
    rng = Random(7)
    pool = ["a", "b b", "c c c", "", line(1), line(2)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 8)))) for i in range(60)]
    rows += [(100, "x\ny\nz\nu\nv\nw"), (101, "head\nx\ny\nz\nu\nv\ntail"), (102, "one\ntwo"), (103, "one\ntwo"), (104, "one\nthree")]
    out = {r.doc_id: r for r in line_dedup(docs(rows)).collect()}
    assert out[101].text == "head\ntail" and out[103].text == "" and out[104].text == "one\nthree" and out[102].text == "one\ntwo"
    for i, t in rows:
        own, gone = t.split("\n"), set()
        for _, other in (r for r in rows if r[0] < i and t):
            if other == t and t.strip():
                gone |= set(range(len(own)))
            a = other.split("\n")
            places = runs(a)
            gone |= set(grown(a, own, sorted(((places[x], j) for x, j in runs(own).items() if x in places), key=lambda p: p[1])))
        assert out[i].n_removed == len(gone), (i, t)
