"""Turn repair against a search over the grammar's states, which shares nothing with the alignment."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from leadtide.llm import turns
from tests.llm.frames import SF

WHITE = " \t\n\x0b\x0c\r"
MOVES = {"": "us", "s": "u", "u": "a", "a": "u"}


def hurt(rows):
    """conv -> rows after damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0)) for c, rs in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        out.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit) by all states of the grammar, from the end."""
    marks = faults(rows)
    best = {"": (0, ""), "s": (10, "II"), "u": (5, "I"), "a": (0, "")}

    def with_insertions(b):
        for _ in range(3):
            for p in b:
                for x in MOVES[p]:
                    if x != "s":
                        b[p] = min(b[p], (b[x][0] + 5, "I" + b[x][1]))
        return b

    best = with_insertions(best)
    for (_, role, _), mark in zip(reversed(rows), reversed(marks)):
        now = {}
        for p in best:
            ways = [(best[p][0] + 2, "D" + best[p][1])]
            if mark not in ("b", "d"):
                more = 5 if mark == "t" else 0
                for x in MOVES[p]:
                    if role[:1] == x:
                        ways.append((best[x][0] + more, "K" + best[x][1]))
                    elif x != "s":
                        ways.append((best[x][0] + more + 1, "R" + best[x][1]))
            now[p] = min(ways)
        best = with_insertions(now)
    return best[""]


def brute(rows):
    out = []
    for conv, kept in hurt(rows).items():
        marks = faults(kept)
        known = [t for t, _, _ in kept if t is not None]
        cost, audit = cheapest(kept)
        said, state, at = [], "", 0
        for move in audit:
            if move == "I":
                state = "a" if state == "u" else "u"
                said.append({"u": "user:", "a": "assistant:"}[state])
                continue
            _, role, text = kept[at]
            at += 1
            if move == "D":
                continue
            if move == "R":
                role = "assistant" if state == "u" else "user"
            state = role[0]
            said.append(f"{role}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in said))
        out.append((
            conv, max(known) - min(known) + 1 - len(set(known)) if known else 0, marks.count("b"), marks.count("d"), marks.count("t"),
            sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(kept, kept[1:])), cost, audit,
            hashlib.sha256("\n".join(said).encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def got(frame):
    columns = ["conv_id", *turns.COUNTS, "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_whole_table_like_brute_force(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    assert got(turns.repair_digests(turns.damaged(table))) == brute([tuple(r) for r in table.collect()])


def odd_rows(n, seed):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "No!", "", " \t", "Why?", "well", None, "a.b", "é?", "x. \n"]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "user", "assistant"]
    rows = []
    for conv in [None, *range(n)]:
        role_of = rng.choice([roles, ["user", "assistant"], ["user"], ["system", "user", "assistant"]])
        for turn in range(rng.choice([1, 2, 3, 5, 9, 14])):
            rows.append((conv, None if turn == 0 and rng.random() < 0.2 else 3 * turn + rng.randrange(2), rng.choice(role_of), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("block", [1, 2, 9])
def test_odd_conversations_in_blocks_of_any_size(spark, monkeypatch, block):
    rows = odd_rows(60, 5) + [(1000, t, ["user", "assistant"][t % 2 if t % 7 else 0], f"turn {t}{'.' if t % 5 else ''}") for t in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    damaged = turns.damaged(frame)
    found = turns.verdicts(damaged, block)
    want = [w[:-1] for w in brute(rows)]
    columns = ["conv_id", *turns.COUNTS, "audit"]
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == want
    if block == 9:
        assert got(turns.repair_digests(damaged)) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_alignment_of_blocks_chained_like_the_search(seed):
    rng = random.Random(seed)
    for _ in range(250):
        codes = [4 * rng.choice([0, 1, 2, 1, 2, 3]) + rng.choice([0, 0, 0, 1, 3, 3]) for _ in range(rng.randrange(15))]
        cut = rng.randrange(1, 7)
        blocks = [np.array(codes[i : i + cut], np.int32) for i in range(0, len(codes), cut)]
        parts = [
            {"moves": [dict(p=p, q=q, cost=c, audit=a) for p, q, c, a in moves], "turns": [], "n": [0, 0, 0], "illegal": 0, "ends": [0, 0]}
            for moves in turns.align(blocks)
        ]
        rows = [(k, "suax"[c // 4], ["x" + str(k) + ".", " ", "", "y" + str(k)][c % 4]) for k, c in enumerate(codes)]
        verdict = turns.chain(parts)
        assert (verdict["cost"], verdict["audit"]) == cheapest(rows)


def test_a_conversation_beyond_a_band(spark):
    """Hundreds of system turns, one of which may stay."""
    codes = [0] * 40 + [4, 8] * 3 + [0] * 30 + [8]
    parts = [{"moves": [dict(p=p, q=q, cost=c, audit=a) for p, q, c, a in m], "turns": [], "n": [0, 0, 0], "illegal": 0, "ends": [0, 0]}
             for m in turns.align([np.array(codes, np.int32)])]
    verdict = turns.chain(parts)
    rows = [(k, "suax"[c // 4], f"x{k}.") for k, c in enumerate(codes)]
    assert (verdict["cost"], verdict["audit"]) == cheapest(rows)


def test_repaired_turns_and_clashing_names(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "So?"), (2, 0, "assistant", "Yes."), (3, 0, "system", "Be kind.")]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", audit int, h1 int, gone int")
    out = sorted(tuple(r) for r in turns.repaired(turns.as_they_are(frame)).collect())
    assert out == [(1, 0, "user", "Hi."), (1, 1, "assistant", "So?")]


def test_very_long_text_and_empty_table(spark):
    rows = [(1, 0, "user", "word " * 2_000_000 + "end."), (1, 1, "assistant", "ok. " * 10)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(turns.repair_digests(turns.damaged(frame))) == brute(rows)
    assert turns.repair_digests(turns.damaged(frame.limit(0))).count() == 0
    assert turns.repaired(turns.as_they_are(frame.limit(0))).count() == 0
