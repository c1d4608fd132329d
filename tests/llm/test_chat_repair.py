"""Operator 6 against an exhaustive search for the cheapest repair, and rendering."""
import functools
import itertools
import random
import re

import pytest

from ledgerline.llm import chat_repair as C
from ledgerline.llm import queries


def cheapest(roles, end_with_assistant=False):
    """Least cost over all sequences of merges, relabels and insertions (at most two in a row)."""
    ends = C.endings(end_with_assistant)

    @functools.cache
    def best(k, state):
        if k == len(roles):
            return C.INSERT * len(ends[state]) if ends[state] is not None else 10**6
        options = [10**6]
        for inserted in itertools.chain([()], itertools.product((1, 2, 3), repeat=1), itertools.product((1, 2, 3), repeat=2)):
            way = [state, *inserted]
            if all(b in C.NEXT[a] for a, b in zip(way, way[1:])):
                for t in C.NEXT[way[-1]]:
                    options.append(C.INSERT * len(inserted) + C.RELABEL * (roles[k] != t) + best(k + 1, t))
        if state != C.START:
            options.append(C.MERGE + C.RELABEL * (roles[k] != state) + best(k + 1, state))
        return min(options)

    return best(0, C.START)


def cost_of(rows):
    price = {"keep": 0, "relabel": C.RELABEL, "merge": C.MERGE, "merge_relabel": C.MERGE + C.RELABEL}
    return sum(price[r["action"]] + C.INSERT * r["n_inserted"] for r in rows)


def legal(text, end=False):
    turns = re.findall(r"<\|im_start\|>(\w+)\n", text)
    spoken = turns[1:] if turns[:1] == ["system"] else turns
    return bool(spoken) and spoken == (["user", "assistant"] * len(spoken))[:len(spoken)] and (not end or spoken[-1] == "assistant")


def test_paths_cost_the_least_however_they_are_cut():
    rng = random.Random(0)
    for trial in range(300):
        roles = [rng.randrange(4) for _ in range(rng.randint(1, 9))]
        end = trial % 2 == 0
        cuts = sorted(rng.sample(range(1, len(roles)), min(len(roles) - 1, rng.randint(0, 3)))) if len(roles) > 1 else []
        parts = [roles[a:b] for a, b in zip([0, *cuts], [*cuts, len(roles)])]
        ways = C.link_segments([C.segment_matrix(p) for p in parts], end)
        total, state, made = 0, C.START, 0
        for part, (entry, leave, before) in zip(parts, ways):
            assert entry == state and before == made
            for role, after in zip(part, C.segment_path(part, entry, leave)):
                total, made = total + C.COST[role, state, after] // C.UNIT, made + C.MADE[role, state, after]
                state = after
        assert total + C.INSERT * len(C.endings(end)[state]) == cheapest(tuple(roles), end)


@pytest.mark.parametrize("end", [False, True])
def test_table_with_a_hot_conversation(spark, end):
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "User ", "bot", "tool", None]
    rows = [(c, t, rng.choice(roles), rng.choice(["hi", "", None, "a <|im_end|> b"])) for c in range(30) for t in range(rng.randint(1, 8))]
    rows += [(99, t, rng.choice(roles), f"t{t}") for t in range(400)] + [(None, 1, "user", "x"), (7, None, "user", "first"), (5, 0, "user", "hi"), (5, 0, "user", "hi")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, rendered string").repartition(7)
    got = [r.asDict() for r in C.repair(df, end_with_assistant=end).collect()]
    assert len(got) == len(rows)
    code = lambda r: C.ROLES.get((r or "").strip().lower(), 0)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in got if r["conv_id"] == conv), key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"] is not None, r["role"] or "", r["out_turn"]))
        text = "".join(r["rendered"] for r in mine)
        assert legal(text, end) and text.count("<|im_start|>") == text.count("<|im_end|>")
        if conv != 5:  # there the order of equal turns is free
            assert cost_of(mine) == cheapest(tuple(code(r["role"]) for r in mine), end)


def test_a_legal_conversation_is_unchanged(spark):
    df = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a")], "conv_id long, turn long, role string, text string")
    rows = sorted(C.repair(df).collect(), key=lambda r: r.turn)
    assert "".join(r.rendered for r in rows) == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\na<|im_end|>\n"
    assert {r.action for r in rows} == {"keep"} and C.repair(df.limit(0)).count() == 0


def test_query_over_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [r.asDict() for r in queries.op6_chat_repair(spark, sf).collect()]
    given = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    assert len(rows) == len(given)
    for conv in {r.conv_id for r in given}:
        mine = sorted((r for r in rows if r["conv_id"] == conv), key=lambda r: r["turn"])
        assert legal("".join(r["rendered"] for r in mine))
        assert cost_of(mine) == cheapest(tuple(C.ROLES.get(r["role"], 0) for r in mine))
