"""The order of tool calls against a plain walk over the same graphs."""

import random

from tidegauge.llm import tool_links


def walked(calls):
    """``due`` of each call, None in or behind a ring; ``calls`` is id -> (turn, ids waited for)."""
    due = {}
    left = dict(calls)
    while True:
        ready = [c for c, (_, after) in left.items() if not any(a in left for a in after)]
        if not ready:
            return {**due, **dict.fromkeys(left)}
        for c in ready:
            turn, after = left.pop(c)
            behind = [(*due[a][:2], due[a][2] + 1) for a in after if a in due]
            due[c] = max([(turn, 0, 0), *behind])


def test_order_against_a_walk(spark):
    rnd = random.Random(5)
    graphs = {
        # A chain in which each call waits for the one before, and the first for a much later one.
        1: {"c80": (80, ["c200"]), "c200": (200, []), **{f"c{t}": (t, [f"c{t - 1}"]) for t in range(81, 101)}},
        2: {"c13": (13, ["c15"]), "c15": (15, ["c13"]), "c17": (17, ["c15"]), "c19": (19, ["c17", "no such call"]), "c1": (1, [])},
        3: {"a": (1, ["b"]), "b": (2, ["c"]), "c": (3, ["a"]), "d": (4, ["a", "e"]), "e": (5, []), "f": (6, ["d"]), "g": (7, ["g"]), "h": (8, ["e", "f2"]), "f2": (9, ["e"])},
        # Each waits for the two before, the first for the last but one.
        4: {**{f"c{t}": (t, [f"c{t - 1}", f"c{t - 2}"]) for t in range(2, 14)}, "c1": (1, ["z"]), "z": (50, ["y"]), "y": (51, [])},
    }
    for conv in range(5, 25):
        n = rnd.randrange(2, 12)
        graphs[conv] = {f"k{i}": (i, [f"k{rnd.randrange(n)}" for _ in range(rnd.choice([0, 1, 1, 2]))]) for i in range(n)}
    rows = [(conv, c, turn, 0, sorted(set(after))) for conv, calls in graphs.items() for c, (turn, after) in calls.items()]
    table = spark.createDataFrame(rows, "conv_id BIGINT, call_id STRING, turn BIGINT, pos INT, after ARRAY<STRING>")
    got = {(r["conv_id"], r["call_id"]): (r["due_turn"], r["due_pos"], r["hops"]) for r in tool_links.ordered(table).collect()}
    want = {(conv, c): due or (None, None, None) for conv, calls in graphs.items() for c, due in walked(calls).items()}
    assert got == want
