"""Chat formatting with the cheapest repair of illegal role sequences.

A legal conversation is an optional system message, then user and assistant in turn, from the user on.
Every turn, in order, is kept, given another role, or merged into the message before it, and an empty
message may be inserted before it; each has a cost. A dynamic program over the automaton's states
(the role of the last message) finds the cheapest repair; the repaired turns are then rendered.

Turns are dealt to ranges of (conversation, turn), so one long conversation may span many ranges. A run
of turns acts on the states as a matrix of least costs; the first and last run of each range are
multiplied through first (two small rows per range), which fixes the states at the range borders, and
then every range is repaired by itself.

Defined results: turns are ordered by turn (null first), then by a hash of role and text; null is a
conversation of its own; a null text is empty; roles are read without case and surrounding blanks, and
an unknown or null role always has to be replaced. Of equally cheap repairs the one that keeps, then
merges, then relabels, then inserts earliest from the end is taken. Columns of the input beyond the
four are not used.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import shuffle_partitions

# Roles, their other names, costs of the repairs, marks of the rendered form.
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = ("", "system", "user", "assistant")
OTHER_NAMES = {"human": "user", "prompter": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant"}
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, RELABEL_SYSTEM, INSERT = 1.0, 2.0, 4.0, 3.0
OPEN, CLOSE, JOINT = "<|im_start|>", "<|im_end|>\n", "\n\n"
FOREVER = float("inf")

REPAIRED = (
    "conv_id bigint, turn bigint, role string, new_role string, action string, inserted string, "
    "cost double, rendered string"
)


def role_number(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = OTHER_NAMES.get(name, name)
    return NAMES.index(name) if name in NAMES[1:] else START


def _relabel(role: int, new: int) -> float:
    """Costs of another role; instructions and talk are further apart than the two talkers."""
    if role == new:
        return 0.0
    return RELABEL_SYSTEM if SYSTEM in (role, new) else RELABEL


def _moves(role: int) -> list[tuple[int, int, float, str, int]]:
    """What may happen to a turn: state before, state after, cost, action and inserted role."""
    found = []
    for before in NEXT:
        if before != START:
            found.append((before, before, MERGE + _relabel(role, before), "merge", START))
        ways = [(x, START) for x in NEXT[before]]
        ways += [(x, y) for y in NEXT[before] for x in NEXT[y]]
        for new, empty in ways:
            action = "keep" if new == role else "relabel"
            found.append((before, new, _relabel(role, new) + INSERT * (empty != START), action, empty))
    rank = {"keep": 0, "merge": 1, "relabel": 2}
    return sorted(found, key=lambda m: (m[2], m[4] != START, rank[m[3]], m[0]))


MOVES = {role: _moves(role) for role in range(4)}


def run_costs(roles: list[int]) -> np.ndarray:
    """Least cost from every state to every state over a run of turns."""
    costs = np.where(np.eye(4, dtype=bool), 0.0, FOREVER)
    steps = {}
    for role in set(roles):
        step = np.full((4, 4), FOREVER)
        for before, after, cost, _, _ in MOVES[role]:
            step[before, after] = min(step[before, after], cost)
        steps[role] = step
    for role in roles:
        costs = (costs[:, :, None] + steps[role][None]).min(axis=1)
    return costs


def repair(roles: list[int], entry: int = START, exit_: int | None = None) -> list[tuple]:
    """The moves of the cheapest repair from the entry state (to the exit state, if given)."""
    costs = [FOREVER] * 4
    costs[entry] = 0.0
    back: list[list] = []
    for role in roles:
        best, chosen = [FOREVER] * 4, [None] * 4
        for move in MOVES[role]:
            cost = costs[move[0]] + move[2]
            if cost < best[move[1]]:
                best[move[1]], chosen[move[1]] = cost, move
        costs = best
        back.append(chosen)
    state = costs.index(min(costs)) if exit_ is None else exit_
    path = []
    for chosen in reversed(back):
        move = chosen[state]
        path.append(move)
        state = move[0]
    return path[::-1]


def _escaped(text: str | None) -> str:
    return (text or "").replace("<|im_", "<| im_")


def render(texts: list, moves: list[tuple], first: bool, last: bool) -> list[str]:
    """A piece per turn; the pieces of a conversation in order are its rendered form."""
    pieces = []
    for text, (_, new, _, action, empty) in zip(texts, moves, strict=True):
        if action == "merge":
            head = JOINT
        else:
            head = "" if first else CLOSE
            if empty != START:
                head += f"{OPEN}{NAMES[empty]}\n{CLOSE}"
            head += f"{OPEN}{NAMES[new]}\n"
        pieces.append(head + _escaped(text))
        first = False
    if last and pieces:
        pieces[-1] += CLOSE
    return pieces


def _key(conv_id, turn, tie) -> tuple:
    return conv_id is not None, conv_id or 0, turn is not None, turn or 0, tie


def ranged(turns: DataFrame, parts: int) -> tuple[DataFrame, int]:
    """Turns sorted within ranges numbered by ``part``, one range per task, and how many there are."""
    tie = F.xxhash64("role", "text")
    rows = turns.select("conv_id", "turn", "role", "text", tie.alias("tie"))
    order = ["conv_id", "turn", "tie"]
    firsts = (
        rows.select(*order)
        .repartitionByRange(parts, *order)
        .groupBy(F.spark_partition_id().alias("p"))
        .agg(F.min(F.struct(*order)).alias("first"))
        .collect()
    )
    cuts = sorted({_key(*r["first"]) for r in firsts})[1:]

    @F.pandas_udf("int")
    def part(conv: pd.Series, turn: pd.Series, own: pd.Series) -> pd.Series:
        def plain(x):
            return None if pd.isna(x) else int(x)

        keys = zip(conv.tolist(), turn.tolist(), own.tolist(), strict=True)
        return pd.Series([bisect_right(cuts, _key(plain(c), plain(t), o)) for c, t, o in keys], dtype="int32")

    # As text, so that large ids reach the function exactly even next to nulls.
    numbered = rows.withColumn("part", part(F.col("conv_id").cast("string"), F.col("turn").cast("string"), "tie"))
    return numbered, len(cuts) + 1


def _dealt(rows: DataFrame, parts: int) -> DataFrame:
    return rows.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "conv_id", "turn", "tie")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
    for key, run in groupby(rows, key=lambda r: r[:2]):
        yield key, list(run)


def _border_states(borders: list[dict]) -> dict[tuple[int, object], tuple[int, int | None, bool, bool]]:
    """Entry and exit state of the runs at range borders, and whether they begin and end theirs."""
    found = {}
    for _, chain in groupby(sorted(borders, key=lambda b: b["part"]), key=lambda b: (b["conv_id"],)):
        chain = list(chain)
        costs, back = np.full(4, FOREVER), []
        costs[START] = 0.0
        for piece in chain:
            table = costs[:, None] + np.array(piece["costs"]).reshape(4, 4)
            back.append(table.argmin(axis=0))
            costs = table.min(axis=0)
        state = int(costs.argmin())
        for i in range(len(chain) - 1, -1, -1):
            before = int(back[i][state])
            last = i == len(chain) - 1
            found[(chain[i]["part"], chain[i]["conv_id"])] = (before, state, i == 0, last)
            state = before
    return found


def repaired(turns: DataFrame, parts: int | None = None) -> DataFrame:
    """Per turn its role after the repair, the action, the role inserted before it, and its piece."""
    rows, parts = ranged(turns, parts or shuffle_partitions(turns.sparkSession))

    def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = []
        for (part, conv_id), run in _runs(batches):
            one = {"part": part, "conv_id": conv_id, "costs": run_costs([role_number(r[2]) for r in run]).ravel().tolist()}
            kept = [*kept[:1], one]  # the first and the latest
        if kept:
            schema = pa.schema([("part", pa.int32()), ("conv_id", pa.int64()), ("costs", pa.list_(pa.float64()))])
            yield pa.RecordBatch.from_pylist(kept, schema)

    keys = _dealt(rows.select("part", "conv_id", "role", "turn", "tie"), parts).select("part", "conv_id", "role")
    found = keys.mapInArrow(borders, "part int, conv_id bigint, costs array<double>").collect()
    states = _border_states([r.asDict() for r in found])

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for (part, conv_id), run in _runs(batches):
            entry, exit_, first, last = states.get((part, conv_id), (START, None, True, True))
            moves = repair([role_number(r[2]) for r in run], entry, exit_)
            pieces = render([r[4] for r in run], moves, first, last)
            for (_, _, role, turn, _), (_, new, cost, action, empty), piece in zip(run, moves, pieces, strict=True):
                yield conv_id, turn, role, NAMES[new], action, NAMES[empty] or None, cost, piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in REPAIRED.split(", ")]
        kinds = [pa.int64()] * 2 + [pa.string()] * 4 + [pa.float64(), pa.string()]
        done = results(batches)
        while chunk := list(islice(done, 1000)):
            arrays = [pa.array(c, k) for c, k in zip(zip(*chunk, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    whole = _dealt(rows, parts).select("part", "conv_id", "role", "turn", "text")
    return whole.mapInArrow(run, REPAIRED)
