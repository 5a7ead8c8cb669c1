import heapq
import itertools

from lexispark.llm.chat import INSERT, LEGAL, MERGE, RELABEL, ROLES, UNKNOWN, format_chats, render, repair


def cheapest(roles):
    heap, seen = [(0, 0, "")], set()
    while heap:
        cost, i, s = heapq.heappop(heap)
        if (i, s) in seen:
            continue
        seen.add((i, s))
        if i == len(roles):
            return cost
        state, role = s or None, roles[i]
        to = lambda q: 0 if q == role else RELABEL if role in ROLES else UNKNOWN  # noqa: B023, E731
        if state:
            heapq.heappush(heap, (cost + MERGE + to(state), i + 1, s))
        for q in LEGAL[state]:
            heapq.heappush(heap, (cost + to(q), i + 1, q))
            for q2 in LEGAL[q]:
                heapq.heappush(heap, (cost + INSERT + to(q2), i + 1, q2))


def test_least_cost_and_legal():
    for n in range(5):
        for roles in itertools.product([*ROLES, None, "tool"], repeat=n):
            fixed, cost = repair([(r, str(i)) for i, r in enumerate(roles)])
            assert cost[0] == cheapest(roles)
            state = None
            for role, _ in fixed:
                assert role in LEGAL[state]
                state = role
            assert [t for _, text in fixed for t in text.split("\n") if t] == [str(i) for i in range(n)]


def test_frame(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "user", "there"), (1, 2, "assistant", None), (2, 1, "assistant", "a"), (2, 0, "system", "s"),
            (2, 1, "assistant", "a"), (None, 0, None, "x"), (3, None, "bot", "<|user|>"), (4, 0, "user", "y" * 50_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS cost")
    out = {x.conv_id: x for x in format_chats(frame).collect()}
    assert set(out) == {1, 2, 3, 4, None}
    assert out[1].rendered == render([("user", "hi\nthere"), ("assistant", "")]) and out[1].n_merged == 1
    assert out[2].n_turns == 2 and out[2].n_inserted == 1 and "<|user|>\n\n" in out[2].rendered
    assert "<\\|user|>" in out[3].rendered and out[4].cost == 0
    assert format_chats(frame.limit(0)).count() == 0
