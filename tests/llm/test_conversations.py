"""Conversation repair against a best-first search over edits, with nulls, ties, repeats and conversations cut into blocks."""

import hashlib
import heapq
import random
import re

import pytest

from tidemill.llm import conversations, roles
from tidemill.llm.conversations import Repair

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
FULL = {"u": "user", "a": "assistant"}
SCHEMA = "conv_id long, turn long, role string, text string, row string, block long"


def cheapest(turns):
    """turns: (initial, forced, truncated, line). Best first by (cost, audit), so the first end popped is the answer."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, out = heapq.heappop(heap)
        if at == len(turns) and state in ("", "a"):
            return cost, audit, [x for x in out]
        if (at, state) in seen:
            continue
        seen.add((at, state))
        for t in "ua":
            if (state, t) in NEXT:
                heapq.heappush(heap, (cost + 2, audit + "I", at, NEXT[state, t], (*out, FULL[t] + ":")))
        if at < len(turns):
            initial, forced, truncated, (role, text) = turns[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state, out))
            if not forced:
                if (state, initial) in NEXT:
                    heapq.heappush(heap, (cost + truncated, audit + "K", at + 1, NEXT[state, initial], (*out, f"{role}:{text}")))
                for t in "ua":
                    if (state, t) in NEXT:
                        heapq.heappush(heap, (cost + 2 + truncated, audit + "R", at + 1, NEXT[state, t], (*out, f"{FULL[t]}:{text}")))
    raise AssertionError


def plain(rows):
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
    turns, seen, n = [], set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        blank, copy = not solid, (role, text) in seen
        seen.add((role, text))
        cut = not blank and not copy and solid[-1] not in ".!?"
        n["blank"] += blank
        n["duplicate"] += copy and not blank
        n["truncated"] += cut
        turns.append((role[:1] or " ", blank or copy, cut, (role, text)))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    cost, audit, lines = cheapest(turns)
    return (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def cases(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["a.", "b!", "c", "", " \t", None, "é?", "long " * 50 + ".", "x.\n", "a "]
    names = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "agent"]
    rows = []
    for conv in [None, *range(conversations)]:
        for turn in range(rng.randint(1, longest)):
            fresh = f"{rng.random()}." if rng.random() < 0.5 else rng.choice(texts)
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(names)
            row = (conv, rng.choice([turn, turn, turn, None, turn + 1, turn * 3]), role, fresh)
            rows += [row] * rng.choice([1, 1, 1, 1, 2, 3])
    return rows


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    found = {r.conv: tuple(r)[1:] for r in Repair(frame).summary().collect()}
    grouped = {}
    for conv, *rest in rows:
        grouped.setdefault(conv, []).append(tuple(rest))
    assert set(found) == set(grouped)
    for conv, mine in grouped.items():
        assert found[conv] == plain(mine), conv


def test_small(spark):
    check(spark, cases(1, 150, 9))


@pytest.mark.parametrize("size", [1, 3, 50])
def test_blocks(spark, monkeypatch, size):
    """Conversations of many blocks in many partitions, one of which holds most rows."""
    monkeypatch.setattr(conversations, "BLOCK_ROWS", size)
    rows = cases(size, 12, 40)
    rng = random.Random(size)
    rows += [(5, rng.randint(0, 400), rng.choice(["user", "assistant", "system"]), rng.choice(["same.", f"{i}.", f"{i}"])) for i in range(700)]
    check(spark, rows)


def test_turns(spark, monkeypatch):
    monkeypatch.setattr(conversations, "BLOCK_ROWS", 4)
    rows = cases(7, 20, 15)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    repair = Repair(frame, texts=True)
    shas = {r.conv: r.sha for r in repair.summary().collect()}
    lines = {}
    for r in sorted(repair.turns().collect(), key=lambda r: (r.block, r.position)):
        lines.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
        assert r.edit in ("keep", "rerole", "insert")
    for conv, sha in shas.items():
        assert sha == hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest()
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines.get(conv, [])))


def test_empty_and_single(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert Repair(frame).summary().count() == 0
    check(spark, [(1, None, None, None)])
    check(spark, [(1, 2, "system", "only.")])


def test_other_grammar():
    """The table is built from the rules; a grammar whose stacks grow is refused."""
    parser = roles.Parser((("C", "A"), ("A", "sua"), ("A", "Aua")))
    token = lambda c: roles.Token(c, True, False, 0)
    assert parser.solve(tuple(map(token, "sua"))) == (0, "KKK")
    assert parser.solve(tuple(map(token, "suauu"))) == (2, "KKKKR")
    with pytest.raises(ValueError):
        roles.Parser((("B", ""), ("B", "uBaB")))
