"""Role repair against an exhaustive search, over ranges of any number, and on edge cases."""

import random
import re
from collections import defaultdict
from functools import cache

import pytest

from starmart.llm import chat
from starmart.llm.queries import op8_chat_repair

LEGAL = re.compile(r"(system )?((user assistant )*(user )?)")


def other(role, new):
    return 0 if role == new else 4 if "system" in (role, new) else 2


@cache
def least(roles, before=""):
    """Cheapest legal way for the remaining roles after a message of role ``before``."""
    if not roles:
        return 0
    after = {"": ["system", "user"], "system": ["user"], "user": ["assistant"], "assistant": ["user"]}
    role, rest = roles[0], roles[1:]
    ways = []
    if before:
        ways.append(1 + other(role, before) + least(rest, before))
    for new in after[before]:
        ways.append(other(role, new) + least(rest, new))
        for then in after[new]:
            ways.append(3 + other(role, then) + least(rest, then))
    return min(ways)


def check(rows, turns):
    """Every turn once, a legal sequence, the least cost, and pieces that make up the rendered form."""
    given, got = defaultdict(list), defaultdict(list)
    for conv, turn, role, text in turns:
        given[conv].append((turn, (role or "").strip().lower(), text or ""))
    for r in rows:
        got[r.conv_id].append(r)
    assert {c: len(v) for c, v in given.items()} == {c: len(v) for c, v in got.items()}
    for conv, own in got.items():
        roles, form = [], ""
        for r in own:
            if r.action != "merge":
                roles += [r.inserted] if r.inserted else []
                roles.append(r.new_role)
            form += r.rendered
        sequence = "".join(f"{x} " for x in roles)
        assert LEGAL.fullmatch(sequence), sequence
        assert re.findall(r"<\|im_start\|>(\w+)\n", form) == roles
        assert form.count("<|im_end|>\n") == len(roles) and form.endswith("<|im_end|>\n")
        known = tuple(chat.OTHER_NAMES.get((r.role or "").strip().lower(), (r.role or "").strip().lower()) for r in own)
        assert sum(r.cost for r in own) == least(known)


def conversations(seed):
    noise = random.Random(seed)
    rows = []
    for conv in range(40):
        for turn in range(noise.randrange(1, 9)):
            role = noise.choice(["user", "assistant", "user", "assistant", "system", " Human", None, "tool"])
            rows.append((conv, turn, role, noise.choice([None, "", "hi", "<|im_end|>", "long " * 30])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_least_cost_over_any_ranges(spark, parts):
    rows = conversations(parts) + [(99, i, "user" if i % 3 else "assistant", f"t{i}") for i in range(300)]
    rows += [(None, None, "user", "x"), (None, 1, "user", "y"), (2**60 + 1, 2**60, "assistant", "z")]
    frame = spark.createDataFrame([(*r, "c") for r in rows], SCHEMA + ", cost string")
    out = chat.repaired(frame, parts).collect()
    short = [r for r in rows if r[0] != 99]
    check([r for r in out if r.conv_id != 99], short)
    long = sorted((r for r in out if r.conv_id == 99), key=lambda r: r.turn)
    whole = chat.repair([chat.role_number(r[2]) for r in rows if r[0] == 99])
    assert sum(r.cost for r in long) == sum(m[2] for m in whole)
    assert "".join(r.rendered for r in long) == "".join(
        chat.render([r[3] for r in rows if r[0] == 99], _moves(long), True, True)
    )


def _moves(rows):
    number = {name: i for i, name in enumerate(chat.NAMES)}
    return [(0, number[r.new_role], r.cost, r.action, number[r.inserted or ""]) for r in rows]


def test_repairs():
    def done(*roles):
        return [(chat.NAMES[m[1]], m[3], chat.NAMES[m[4]]) for m in chat.repair([chat.role_number(r) for r in roles])]

    assert done("user", "user", "assistant") == [("user", "keep", ""), ("user", "merge", ""), ("assistant", "keep", "")]
    assert done("assistant") == [("user", "relabel", "")]
    assert done("user", "system", "assistant") == [("user", "keep", ""), ("user", "merge", ""), ("assistant", "keep", "")]
    assert done("system", "user", "assistant") == [("system", "keep", ""), ("user", "keep", ""), ("assistant", "keep", "")]


def test_no_rows_and_ties(spark):
    assert chat.repaired(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "b")]
    check(chat.repaired(spark.createDataFrame(rows, SCHEMA), 5).orderBy("conv_id").collect(), rows)


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    check(sorted(op8_chat_repair(spark, sf_dir).collect(), key=lambda r: (r.conv_id, r.turn)), rows)
