"""Chat formatting with minimum-cost role repair.

Legal conversations: at most one system turn, first; then user and assistant turns in turn, starting with the user.  A
dynamic programme over that automaton (states: nothing yet, system, user, assistant) goes through the turns in order.  A
turn is kept as it is (cost 0), relabelled (RELABEL; UNKNOWN for a role outside the three), merged into the turn before it
(MERGE, and the relabelling if the roles differ), and in front of a kept or relabelled turn one empty turn may be inserted
(INSERT).  Of equally cheap repairs the one with fewer insertions, then relabels, then merges is taken, then the one that
keeps the earlier roles.  The repaired turns are rendered between markers; markers inside a text are escaped.

Defined results: turns go in order of number, role and text, nulls first; rows that repeat whole count once; a null text
is empty; a null or unknown role costs UNKNOWN; a null conv_id is a conversation of its own.  One conversation is one
row, as is its rendering; extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
MERGE, RELABEL, UNKNOWN, INSERT = 2, 5, 1, 4
#: Roles that may follow each state; None is the start.
LEGAL = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}


def repair(turns: list[tuple[str | None, str | None]]) -> tuple[list[tuple[str, str]], tuple[int, int, int, int]]:
    """(role, text) in order -> repaired turns, (cost, insertions, relabels, merges)."""
    best = {None: ((0, 0, 0, 0), None)}  # state -> cost, chain of (action, role, the rest)
    for role, _ in turns:
        known = role in ROLES
        new: dict = {}

        def offer(state, cost, step, new=new):
            if state not in new or cost < new[state][0]:
                new[state] = (cost, step)

        for state, ((cost, ins, rel, mer), chain) in best.items():
            if state is not None:
                price = MERGE + (0 if role == state else RELABEL if known else UNKNOWN)
                offer(state, (cost + price, ins, rel + (role != state), mer + 1), ("merge", state, chain))
            for between in (None, *LEGAL[state]):
                for to in LEGAL[between or state] if between else LEGAL[state]:
                    price = (INSERT if between else 0) + (0 if role == to else RELABEL if known else UNKNOWN)
                    put = (cost + price, ins + bool(between), rel + (role != to), mer)
                    step = ("keep", to, ("insert", between, chain) if between else chain)
                    offer(to, put, step)
        best = new
    cost, chain = min(best.values(), key=lambda x: x[0])
    steps = []
    while chain is not None:
        steps.append(chain[:2])
        chain = chain[2]
    out: list[list] = []
    texts = iter(turns)
    for action, role in reversed(steps):
        if action == "insert":
            out.append([role, []])
        elif action == "keep":
            out.append([role, [next(texts)[1] or ""]])
        else:
            out[-1][1].append(next(texts)[1] or "")
    return [(role, "\n".join(t for t in parts if t)) for role, parts in out], cost


def render(turns: list[tuple[str, str]]) -> str:
    return "".join(f"<|{role}|>\n{text.replace('<|', '<\\|')}\n<|end|>\n" for role, text in turns)


def _rendered(batches):
    for batch in batches:
        columns = [[], [], [], [], [], [], []]
        for rows in batch.column("turns").to_pylist():
            fixed, (cost, ins, rel, mer) = repair([(r["role"], r["text"]) for r in rows])
            for c, v in zip(columns, (len(rows), len(fixed), cost, ins, rel, mer, render(fixed)), strict=True):
                c.append(v)
        kinds = [pa.int64()] * 6 + [pa.string()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id")] + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["conv_id", "n_turns", "n_rendered", "cost", "n_inserted", "n_relabelled", "n_merged", "rendered"],
        )


def format_chats(rows: DataFrame) -> DataFrame:
    """rows(conv_id, turn, role, text) -> one row a conversation: counts of repairs and the rendered text."""
    turn = F.struct(F.col("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    chats = rows.groupBy("conv_id").agg(F.array_distinct(F.array_sort(F.collect_list(turn))).alias("turns"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns long, n_rendered long, cost long, n_inserted long, n_relabelled long, n_merged long, rendered string"
    return chats.mapInArrow(_rendered, schema)
