"""Cheapest repair of a sequence of roles: generalised LR parsing with edits.

The grammar becomes an SLR table. The parser keeps every stack that some sequence of
edits can reach; stacks share what lies below their tops, so they form a graph, and
equal tops merge into the one reached by the least (cost, audit). Two audits of equal
cost and equal top are never each other's beginning, because letters beyond the shorter
one could only be inserts and those cost, so the least audit so far stays least whatever
follows, and merging loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache
from typing import NamedTuple

END = "$"
#: Start symbol first: (s?(ua)+)? over the initials of system, user and assistant.
ROLE_GRAMMAR = (("C", ""), ("C", "sP"), ("C", "P"), ("P", "ua"), ("P", "Pua"))
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: The roles that rerole and insert can give, by initial.
GIVEN = {"u": "user", "a": "assistant"}
#: A grammar with more stacks than this is refused: blocks are solved from every stack that could precede them.
MOST_TOPS = 64


class Token(NamedTuple):
    """One turn: its initial, whether it may stay, whether keeping it costs; and how many copies behind it must go."""

    initial: str
    stays: bool
    truncated: bool
    copies: int


class Top:
    """A stack: its state and the stack below. Equal stacks are one object, made by ``Parser._push``."""

    __slots__ = ("state", "below", "index")

    def __init__(self, state: int, below: Top | None, index: int) -> None:
        self.state, self.below, self.index = state, below, index


def slr(grammar: tuple[tuple[str, str], ...]) -> tuple[list[dict[str, list]], dict[tuple[int, str], int]]:
    """Actions per state and terminal, and the goto table. Conflicts stay: the parser follows them all."""
    rules = (("", grammar[0][0]), *grammar)
    heads = {h for h, _ in grammar}

    def spread(items: Iterable[tuple[int, int]]) -> frozenset:
        out, queue = set(items), list(items)
        while queue:
            rule, dot = queue.pop()
            body = rules[rule][1]
            if dot < len(body) and body[dot] in heads:
                fresh = {(i, 0) for i, (h, _) in enumerate(rules) if h == body[dot]} - out
                out |= fresh
                queue += fresh
        return frozenset(out)

    empty: set[str] = set()
    first = {h: set() for h in heads}
    follow = {h: set() for h in heads} | {"": {END}}

    def first_of(body: str) -> set[str]:
        out = set()
        for x in body:
            out |= first[x] if x in heads else {x}
            if x not in empty:
                return out
        return out | {""}

    size = -1
    while size != (size := len(empty) + sum(map(len, first.values())) + sum(map(len, follow.values()))):
        for head, body in rules:
            if head and all(x in empty for x in body):
                empty.add(head)
            if head:
                first[head] |= first_of(body) - {""}
            for i, x in enumerate(body):
                if x in heads:
                    after = first_of(body[i + 1 :])
                    follow[x] |= (after - {""}) | (follow[head] if "" in after else set())
    states, actions, goto = [spread([(0, 0)])], [], {}
    for state in states:  # grows while it is read
        at: dict[str, list] = {}
        moves: dict[str, set] = {}
        for rule, dot in state:
            head, body = rules[rule]
            if dot < len(body):
                moves.setdefault(body[dot], set()).add((rule, dot + 1))
            elif rule == 0:
                at.setdefault(END, []).append(("accept", 0))
            else:
                for t in follow[head]:
                    at.setdefault(t, []).append(("reduce", rule - 1))
        for x, items in moves.items():
            target = spread(items)
            if target not in states:
                states.append(target)
            if x in heads:
                goto[len(actions), x] = states.index(target)
            else:
                at.setdefault(x, []).append(("shift", states.index(target)))
        actions.append(at)
    return actions, goto


class Parser:
    """Repairs token sequences. One per task; what it remembers is bounded."""

    def __init__(self, grammar: tuple[tuple[str, str], ...] = ROLE_GRAMMAR) -> None:
        self.grammar = grammar
        self.actions, self.goto = slr(grammar)
        self._known: dict[tuple[int, int], Top] = {}
        self.tops: list[Top] = []
        self._steps: dict[tuple[int, str], tuple[Top, ...]] = {}
        self.bottom = self._push(None, 0)
        self.solve = lru_cache(maxsize=20_000)(self._solve)
        self.everywhere = self._all_tops()

    def _push(self, below: Top | None, state: int) -> Top:
        key = (-1 if below is None else below.index, state)
        if key not in self._known:
            self._known[key] = Top(state, below, len(self.tops))
            self.tops.append(self._known[key])
        return self._known[key]

    def _reduced(self, top: Top, rule: int) -> Top:
        head, body = self.grammar[rule]
        for _ in body:
            top = top.below
        return self._push(top, self.goto[top.state, head])

    def _settled(self, top: Top) -> Top:
        """States that can only reduce by one rule do so at once, so that fewer tops differ."""
        while len(only := {a for every in self.actions[top.state].values() for a in every}) == 1 and next(iter(only))[0] == "reduce":
            top = self._reduced(top, next(iter(only))[1])
        return top

    def step(self, top: Top, terminal: str) -> tuple[Top, ...]:
        """All tops after ``terminal``; for the end, the tops that accept."""
        key = (top.index, terminal)
        if key not in self._steps:
            out, queue, seen = [], [top], {top.index}
            while queue:
                at = queue.pop()
                for kind, to in self.actions[at.state].get(terminal, ()):
                    if kind == "reduce":
                        nxt = self._reduced(at, to)
                        if nxt.index not in seen:
                            seen.add(nxt.index)
                            queue.append(nxt)
                    else:
                        out.append(at if kind == "accept" else self._settled(self._push(at, to)))
            if terminal not in GIVEN and not out:
                return ()  # any character may come as an initial: not remembered
            self._steps[key] = tuple(out)
        return self._steps[key]

    def _all_tops(self) -> list[Top]:
        """Every top that any sequence can reach, so that a block can be solved before what precedes it."""
        terminals = {x for _, body in self.grammar for x in body if x.islower()}
        reached = [self.bottom]
        for at in reached:  # grows while it is read
            for t in sorted(terminals):
                reached += [n for n in self.step(at, t) if n not in reached]
            if len(reached) > MOST_TOPS:
                raise ValueError("the grammar's stacks grow with the sequence")
        return reached

    def _insert(self, front: dict[Top, tuple[int, str]]) -> None:
        """Adds what inserts reach. Each costs, so the loop ends."""
        queue = list(front)
        while queue:
            at = queue.pop(0)
            cost, audit = front[at]
            made = (cost + INSERT_COST, audit + INSERT)
            for t in GIVEN:
                for nxt in self.step(at, t):
                    if nxt not in front or made < front[nxt]:
                        front[nxt] = made
                        queue.append(nxt)

    def run(self, tokens: Iterable[Token], start: Top) -> dict[Top, tuple[int, str]]:
        """The least (cost, audit) with which each top is reached from ``start`` after all tokens."""
        front = {start: (0, "")}
        for token in tokens:
            if token.stays:
                self._insert(front)
                after: dict[Top, tuple[int, str]] = {}
                more = TRUNCATED_COST if token.truncated else 0
                for top, (cost, audit) in front.items():
                    options = [(top, (cost + DELETE_COST, audit + DELETE))]
                    options += [(n, (cost + more, audit + KEEP)) for n in self.step(top, token.initial)]
                    options += [(n, (cost + more + REROLE_COST, audit + REROLE)) for t in GIVEN for n in self.step(top, t)]
                    for nxt, made in options:
                        if nxt not in after or made < after[nxt]:
                            after[nxt] = made
                front = after
            if token.copies:  # inserts come behind them: D precedes I
                gone = DELETE * token.copies
                front = {top: (cost + DELETE_COST * token.copies, audit + gone) for top, (cost, audit) in front.items()}
        return front

    def finish(self, front: dict[Top, tuple[int, str]]) -> tuple[int, str]:
        """The least (cost, audit) with which the sequence can end here."""
        closed = dict(front)
        self._insert(closed)
        return min(made for top, made in closed.items() if self.step(top, END))

    def _solve(self, tokens: tuple[Token, ...]) -> tuple[int, str]:
        return self.finish(self.run(tokens, self.bottom))

    def roles(self, tokens: Iterable[Token], audit: str, start: Top) -> list[tuple[int | None, str | None]]:
        """What is left after the edits: (token number or None for an insert, given role or None for the old one)."""
        out, top, edits = [], start, iter(audit)
        edit = next(edits, None)

        def given() -> str:
            nonlocal top
            initial = next(t for t in GIVEN if self.step(top, t))
            top = self.step(top, initial)[0]
            return GIVEN[initial]

        for number, token in enumerate(tokens):
            for copy in range(0 if token.stays else 1, 1 + token.copies):
                while edit == INSERT:
                    out.append((None, given()))
                    edit = next(edits, None)
                if edit == KEEP:
                    top = self.step(top, token.initial)[0]
                    out.append((number, None))
                elif edit == REROLE:
                    out.append((number, given()))
                edit = next(edits, None)
        while edit == INSERT:
            out.append((None, given()))
            edit = next(edits, None)
        return out
