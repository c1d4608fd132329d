"""Chat formatting (operator 6): minimum-cost role repair and rendering.

Legal conversations are the words of an automaton: an optional system turn, then user and assistant
in turn, beginning with the user. Every input turn is kept, relabelled, or merged into the turn before
it; empty turns may be inserted before it. Dynamic programming over the automaton's states finds the
repair of least cost; of equal ones the one with the least action ranks, then with the lower states.

A conversation may be any part of the table, so it is not collected. The rows are sorted by range
over (conversation, turn). Within one range, a conversation's rows make a segment, and a segment's
effect is a matrix: for each entry and exit state the least cost and the number of turns made. These
matrices (at most one a conversation and range) are multiplied along the conversation, which fixes
each segment's entry and exit; the segments are then repaired and rendered on their own.

One output row per input row; its ``rendered`` pieces, in order, make the conversation's text.

Null text counts as empty, null or unknown roles as no legal role, null conversation ids as one
conversation; a null turn comes first, equal turns follow by role and text. ``<|`` inside a text is
written ``< |``, so that no text can end its turn. Empty tables give empty tables; other columns are not read.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import release, small_batches, written

START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ["", "system", "user", "assistant"]
NEXT = {START: [SYSTEM, USER], SYSTEM: [USER], USER: [ASSISTANT], ASSISTANT: [USER]}
ROLES = {"system": SYSTEM, "user": USER, "human": USER, "assistant": ASSISTANT, "bot": ASSISTANT, "gpt": ASSISTANT}
MERGE, RELABEL, INSERT = 2, 3, 4
#: Costs are counted in units above any sum of action ranks of a step; ranks settle ties.
UNIT = 1000
INF = np.int64(1) << 60


def _paths(state: int, most: int = 2):
    """Legal continuations of ``state`` by up to ``most`` inserted turns."""
    yield []
    for length in range(1, most + 1):
        for path in itertools.product(range(1, 4), repeat=length):
            if all(b in NEXT[a] for a, b in zip([state, *path], path)):
                yield list(path)


def _steps():
    """For each input role (0: none) and states s, t: (cost, action, inserted roles) of the best step, or None."""
    table = {}
    for role in range(4):
        for s in range(4):
            for t in range(1, 4):
                wrong = role != t
                options = []
                if s == t:
                    options.append((UNIT * (MERGE + RELABEL * wrong) + 1 + 2 * wrong, "merge_relabel" if wrong else "merge", []))
                for path in _paths(s):
                    if t in NEXT[path[-1] if path else s]:
                        options.append((UNIT * (INSERT * len(path) + RELABEL * wrong) + 3 * len(path) + 2 * wrong, "relabel" if wrong else "keep", path))
                table[role, s, t] = min(options, default=None, key=lambda o: (o[0], o[1], o[2]))
    return table


STEPS = _steps()
COST = np.array([[[STEPS[r, s, t][0] if t and STEPS[r, s, t] else INF for t in range(4)] for s in range(4)] for r in range(4)])
MADE = np.array([[[(len(STEPS[r, s, t][2]) + (not STEPS[r, s, t][1].startswith("merge"))) if t and STEPS[r, s, t] else 0 for t in range(4)] for s in range(4)] for r in range(4)])


def endings(end_with_assistant: bool) -> list[list[int] | None]:
    """Turns inserted after the last one, by state."""
    return [None, [USER, ASSISTANT] if end_with_assistant else [USER], [ASSISTANT] if end_with_assistant else [], []]


def segment_matrix(roles: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Least cost, and turns made by that repair, from each entry to each exit state."""
    cost = np.where(np.eye(4, dtype=bool), 0, INF)
    made = np.zeros((4, 4), np.int64)
    for role in roles:
        through = np.minimum(cost[:, :, None] + COST[role][None], INF)
        best = through.argmin(axis=1)
        entry, leave = np.indices((4, 4))
        cost, made = through[entry, best, leave], made[entry, best] + MADE[role][best, leave]
    return cost, made


def segment_path(roles: list[int], entry: int, leave: int) -> list[int]:
    """States after each turn on the best way from ``entry`` to ``leave``."""
    cost = np.full(4, INF)
    cost[entry] = 0
    back = []
    for role in roles:
        through = np.minimum(cost[:, None] + COST[role], INF)
        back.append(through.argmin(axis=0))
        cost = through.min(axis=0)
    states = [leave]
    for before in reversed(back):
        states.append(int(before[states[-1]]))
    return states[::-1][1:]


def link_segments(matrices: list[tuple[np.ndarray, np.ndarray]], end_with_assistant: bool) -> list[tuple[int, int, int]]:
    """(entry, exit, turns made before) of a conversation's segments on its best way."""
    cost = np.full(4, INF)
    cost[START] = 0
    back = []
    for matrix, _ in matrices:
        through = np.minimum(cost[:, None] + matrix, INF)
        back.append(through.argmin(axis=0))
        cost = through.min(axis=0)
    final = np.array([cost[s] + (UNIT * INSERT + 3) * len(e) if e is not None else INF for s, e in enumerate(endings(end_with_assistant))])
    state = int(final.argmin())
    ways = []
    for before in reversed(back):
        ways.append((int(before[state]), state))
        state = int(before[state])
    out, total = [], 0
    for (entry, leave), (_, made) in zip(ways[::-1], matrices):
        out.append((entry, leave, total))
        total += int(made[entry, leave])
    return out


def _by_key(batches, keys: list[str]):
    """Rows of sorted batches, as lists of dicts, by equal ``keys`` (across batches)."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for _, group in itertools.groupby(rows, key=lambda r: [r[k] for k in keys]):
        yield list(group)


def _emit(rows, fields: list[tuple[str, pa.DataType]], limit: int = 2000):
    """Record batches of at most ``limit`` of the dicts ``rows``."""
    rows = iter(rows)
    while part := list(itertools.islice(rows, limit)):
        yield pa.RecordBatch.from_pylist(part, schema=pa.schema(fields))


def _clean(text: str | None) -> str:
    return (text or "").replace("<|", "< |")


def _opened(role: int) -> str:
    return f"<|im_start|>{NAMES[role]}\n"


CLOSED = "<|im_end|>\n"


def _repaired(segment: list[dict], end_with_assistant: bool):
    roles = [r["code"] for r in segment]
    state, turn = segment[0]["entry"], segment[0]["before"]
    for row, role, after in zip(segment, roles, segment_path(roles, state, segment[0]["leave"])):
        _, action, inserted = STEPS[role, state, after]
        if action.startswith("merge"):
            piece = "\n" + _clean(row["text"])
        else:
            piece = (CLOSED if turn else "") + "".join(_opened(x) + CLOSED for x in inserted) + _opened(after) + _clean(row["text"])
            turn += len(inserted) + 1
        added = len(inserted)
        if row["is_last"]:
            end = endings(end_with_assistant)[after]
            piece += CLOSED + "".join(_opened(x) + CLOSED for x in end)
            added += len(end)
        yield {"conv_id": row["conv"], "turn": row["turn"], "role": row["role"], "out_turn": turn - 1, "out_role": NAMES[after],
               "action": action, "n_inserted": added, "rendered": piece}
        state = after


def repair(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           end_with_assistant: bool = False) -> DataFrame:
    """One row per row of ``conversations``: ``conv_id``, ``turn``, ``role``; ``out_turn`` and ``out_role``, the repaired turn that
    holds its text; ``action`` (keep, relabel, merge, merge_relabel); ``n_inserted``, empty turns made around it;
    ``rendered``, its piece of the conversation's text. Runs Spark jobs; the result reads their tables."""
    spark = conversations.sparkSession
    small_batches(spark)
    code = F.coalesce(*(F.when(F.lower(F.trim(F.col(role))) == name, F.lit(state)) for name, state in ROLES.items()), F.lit(0))
    rows = conversations.select(F.col(conv_id).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"),
                                F.col(text).cast("string").alias("text"), code.alias("code"))
    order = ["conv", "turn", "role", F.xxhash64("text"), "text"]
    ranged = rows.repartitionByRange(*order[:-1]).sortWithinPartitions(*order) \
        .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    turns = written(ranged, "chat-turns")

    flat = "conv long, part int, last long, cost array<long>, made array<long>"
    fields = [("conv", pa.int64()), ("part", pa.int32()), ("last", pa.int64()), ("cost", pa.list_(pa.int64())), ("made", pa.list_(pa.int64()))]

    def matrices(batches):
        def found():
            for segment in _by_key(batches, ["part", "conv"]):
                cost, made = segment_matrix([r["code"] for r in segment])
                yield {"conv": segment[0]["conv"], "part": segment[0]["part"], "last": segment[-1]["place"], "cost": cost.ravel().tolist(), "made": made.ravel().tolist()}
        yield from _emit(found(), fields)

    segments = turns.select("conv", "part", "place", "code").repartition("part").sortWithinPartitions("part", "place").mapInArrow(matrices, flat)

    linked = [("conv", pa.int64()), ("part", pa.int32()), ("entry", pa.int32()), ("leave", pa.int32()), ("before", pa.int64()), ("final", pa.int64())]

    def links(batches):
        def found():
            for group in _by_key(batches, ["conv"]):
                square = lambda x: np.array(x, np.int64).reshape(4, 4)
                for r, (entry, leave, before) in zip(group, link_segments([(square(r["cost"]), square(r["made"])) for r in group], end_with_assistant)):
                    yield {"conv": r["conv"], "part": r["part"], "entry": entry, "leave": leave, "before": before, "final": group[-1]["last"]}
        yield from _emit(found(), linked)

    ways = written(segments.repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(
        links, "conv long, part int, entry int, leave int, before long, final long"), "chat-ways")
    release(spark)

    out = [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("out_turn", pa.int64()), ("out_role", pa.string()),
           ("action", pa.string()), ("n_inserted", pa.int64()), ("rendered", pa.string())]

    def render(batches):
        yield from _emit((row for segment in _by_key(batches, ["part", "conv"]) for row in _repaired(segment, end_with_assistant)), out)

    joined = turns.join(ways.withColumnRenamed("conv", "c").withColumnRenamed("part", "p"), F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))) \
        .select("conv", "turn", "role", "text", "code", "part", "place", "entry", "leave", "before", (F.col("place") == F.col("final")).alias("is_last"))
    return joined.repartition("part").sortWithinPartitions("part", "place").mapInArrow(
        render, "conv_id long, turn long, role string, out_turn long, out_role string, action string, n_inserted long, rendered string")
