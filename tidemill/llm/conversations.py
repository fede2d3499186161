"""Repair of conversation structure, by generalised LR parsing of the roles.

Turns are first reduced to what tells them apart: equal (conversation, turn, role, text)
are one row with a count, and each text of a conversation is shipped once. One range
shuffle puts the rows in order, so a conversation that holds a large share of all rows
lies in many partitions. A partition repairs what lies wholly inside it. A conversation
that crosses a border, or is longer than a block, is solved block by block from every
stack top that could precede the block; the blocks' (entry, exit) costs are then chained
and the chosen paths are rendered block by block. Only the final digest of such a
conversation is sequential; it is streamed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from operator import itemgetter
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemill.llm.roles import Parser, Token
from tidemill.session import cut_lineage

#: A block has at most so many rows, and is closed by the row that fills so many characters.
BLOCK_ROWS, BLOCK_CHARS = 2000, 4_000_000
#: Fixed value: the characters that leave a text blank.
BLANKS = " \t\n\x0b\x0c\r"
#: Pairs of initials that may follow each other.
LEGAL = {"su", "ua", "au"}
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
#: Fixed value: the character that stands for a null text or role.
NULL = " "
BATCH = 500

STATS = "first string, last string, low decimal(38,0), high decimal(38,0), turns long, blank long, duplicate long, truncated long, illegal long"
TURNS = "list array<struct<role:string, text:string, edit:string>>"


def _ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows in order within range partitions: the text of each first occurrence (kind 0) before its entry (kind 1)."""
    stripped = F.expr(f"trim(TRAILING '{BLANKS}' FROM text)")
    named = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("decimal(38,0)").alias("turn"),
        F.coalesce(F.col(role), F.lit(NULL)).alias("role"), F.coalesce(F.col(text), F.lit(NULL)).alias("text"),
    )
    named = named.select(
        "conv", F.col("turn").isNotNull().alias("known"), "turn", "role", "text", F.unhex(F.sha2("text", 256)).alias("digest"), stripped.alias("bare"))
    entry = ("conv", "known", "turn", "role", "digest")
    counted = named.groupBy(*entry, (F.col("bare") == "").alias("blank"), (~F.right("bare", F.lit(1)).isin(".", "!", "?")).alias("truncated")).agg(
        F.count(F.lit(1)).alias("n")
    )
    firsts = named.where("bare <> ''").groupBy("conv", "role", "digest").agg(F.min(F.struct("known", "turn")).alias("at"), F.any_value("text").alias("text"))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("blank", "boolean"), ("truncated", "boolean"), ("n", "long"))]
    both = firsts.select("conv", "at.known", "at.turn", "role", "digest", F.lit(0).alias("kind"), *nothing, "text").unionByName(
        counted.select(*entry, F.lit(1).alias("kind"), "blank", "truncated", "n", F.lit(None).cast("string").alias("text"))
    )
    # Written down because choosing the ranges reads it once more.
    return cut_lineage(both).repartitionByRange(*entry).sortWithinPartitions(*entry, "kind")


class Entry:
    """Equal turns of a conversation, the first of which may stay."""

    __slots__ = ("turn", "role", "text", "token", "blank")

    def __init__(self, turn, role: str, text: str | None, blank: bool, truncated: bool, n: int) -> None:
        stays = text is not None
        self.turn, self.role, self.text, self.blank = turn, role, text, blank
        self.token = Token(role[:1] or NULL, stays, stays and truncated, n - stays)


def _stats(entries: list[Entry]) -> dict:
    turns = [e.turn for e in entries if e.turn is not None]
    initials = [e.token.initial for e in entries]
    n = [e.token.stays + e.token.copies for e in entries]
    return {
        "first": initials[0], "last": initials[-1], "low": min(turns, default=None), "high": max(turns, default=None), "turns": len(set(turns)),
        "blank": sum(m for m, e in zip(n, entries) if e.blank), "duplicate": sum(e.token.copies for e in entries if not e.blank),
        "truncated": sum(e.token.truncated for e in entries),
        "illegal": sum(n) - len(n) + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:])),
    }


def _joined(before: dict, after: dict) -> dict:
    """Statistics of two neighbouring blocks as one; a turn on both sides of the border counts once."""
    lows = [x["low"] for x in (before, after) if x["low"] is not None]
    highs = [x["high"] for x in (before, after) if x["high"] is not None]
    shared = before["high"] is not None and before["high"] == after["low"]
    out = {k: before[k] + after[k] for k in ("blank", "duplicate", "truncated", "turns", "illegal")}
    out["illegal"] += before["last"] + after["first"] not in LEGAL
    out["turns"] -= shared
    return out | {"first": before["first"], "last": after["last"], "low": min(lows, default=None), "high": max(highs, default=None)}


def _summary(stats: dict, cost: int, audit: str) -> dict:
    gaps = 0 if stats["low"] is None else int(stats["high"] - stats["low"] + 1 - stats["turns"])
    return {"gaps": gaps, "cost": cost, "audit": audit} | {k: int(stats[k]) for k in ("blank", "duplicate", "truncated", "illegal")}


def _turns(parser: Parser, entries: list[Entry], audit: str, start) -> list[dict]:
    left = parser.roles([e.token for e in entries], audit, start)
    return [
        {"role": given or entries[i].role, "text": "" if i is None else entries[i].text, "edit": "insert" if i is None else "rerole" if given else "keep"}
        for i, given in left
    ]


def _lines(turns: Iterable[dict]) -> bytes:
    return "\n".join(f"{t['role']}:{t['text']}" for t in turns).encode()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield from batch.slice(at, BATCH).to_pylist()


def _batches(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Small batches, because a row can hold a block of texts."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 1 + len(row.get("list") or ()) + len(row.get("roles") or ())
        if size >= BATCH:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _solver(schema: StructType, texts: bool) -> Callable:
    """Conversations inside the partition, solved; of all others the blocks, with costs from each top to each."""
    arrow = to_arrow_schema(schema)

    def blocks(rows: Iterator[dict]) -> Iterator[tuple]:
        """(conv, entries, begins, ends): the partition cut into blocks. The partition's first conversation never begins in it, the last never ends."""
        opening = True
        for conv, group in _runs(rows):
            entries, chars, begins, text = [], 0, not opening, None
            opening = False
            for row in group:
                if row["kind"] == 0:
                    text = row["text"]
                    continue
                if len(entries) >= BLOCK_ROWS or chars >= BLOCK_CHARS:
                    yield conv, entries, begins, False
                    entries, chars, begins = [], 0, False
                entries.append(Entry(row["turn"], row["role"], text, row["blank"], row["truncated"], row["n"]))
                chars += len(text or "")
                text = None
            yield conv, entries, begins, True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, number = Parser(), 0
        everywhere = parser.everywhere
        places = {top: i for i, top in enumerate(everywhere)}
        part = TaskContext.get().partitionId()

        def solved() -> Iterator[dict]:
            nonlocal number
            for (conv, entries, begins, ends), last in _with_last(blocks(_rows(batches))):
                tokens = tuple(e.token for e in entries)
                if begins and ends and not last:
                    cost, audit = parser.solve(tokens)
                    turns = _turns(parser, entries, audit, parser.bottom)
                    yield {"conv": conv, "sha": hashlib.sha256(_lines(turns)).hexdigest(), "list": turns if texts else None} | _summary(_stats(entries), cost, audit)
                    continue
                number += 1
                paths = [
                    {"entry": places[entry], "exit": places[top], "cost": cost, "audit": audit}
                    for entry in everywhere for top, (cost, audit) in parser.run(tokens, entry).items()
                ]
                held = [{"role": e.role, "text": e.text, "truncated": e.token.truncated, "copies": e.token.copies} for e in entries]
                yield {"conv": conv, "block": part << 32 | number, "paths": paths, "roles": held} | _stats(entries)

        yield from _batches(solved(), arrow)

    return run


def _runs(rows: Iterator[dict]) -> Iterator[tuple]:
    return ((k, g) for k, g in groupby(rows, key=itemgetter("conv")))


def _with_last(items: Iterator) -> Iterator[tuple]:
    held = None
    for item in items:
        if held is not None:
            yield held[0], False
        held = (item,)
    if held is not None:
        yield held[0], True


def _chainer(schema: StructType) -> Callable:
    """Chains the blocks of a conversation: its cheapest repair, and the tops between which each block lies."""
    arrow = to_arrow_schema(schema)

    def chained(rows: Iterator[dict]) -> Iterator[dict]:
        parser = Parser()
        tops = parser.everywhere
        for conv, group in _runs(rows):
            front, settled, stats, back, ids = {0: (0, "")}, [], None, [], []
            for row in group:
                after: dict[int, tuple[int, str]] = {}
                via: dict[int, int] = {}
                for path in row["paths"]:
                    if path["entry"] in front:
                        cost, audit = front[path["entry"]]
                        made = (cost + path["cost"], audit + path["audit"])
                        if path["exit"] not in after or made < after[path["exit"]]:
                            after[path["exit"]], via[path["exit"]] = made, path["entry"]
                # What all paths have in common no longer takes part.
                shared = len(commonprefix([audit for _, audit in after.values()]))
                settled.append(next(iter(after.values()))[1][:shared])
                front = {top: (cost, audit[shared:]) for top, (cost, audit) in after.items()}
                back.append(via)
                ids.append(row["block"])
                stats = _joined(stats, row) if stats else row
            ways = []
            for top, made in front.items():
                try:
                    cost, audit = parser.finish({tops[top]: made})
                except ValueError:
                    continue
                ways.append((cost, audit, top, audit[len(made[1]) :]))
            cost, audit, top, tail = min(ways)
            chosen = []
            for via in reversed(back):
                chosen.append((via[top], top))
                top = via[top]
            whole = _summary(stats, cost, "".join(settled) + audit)
            for i, (block, (entry, leave)) in enumerate(zip(ids, reversed(chosen))):
                end = i == len(ids) - 1
                yield {"conv": conv, "id": block, "entry": entry, "leave": leave, "tail": tail if end else "", "number": i} | (whole if end else {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(chained(_rows(batches)), arrow)

    return run


def _renderer(schema: StructType) -> Callable:
    """The turns of each block, along its chosen path."""
    arrow = to_arrow_schema(schema)

    def rendered(rows: Iterator[dict]) -> Iterator[dict]:
        parser = Parser()
        tops = parser.everywhere
        for row in rows:
            entries = []
            for r in row["roles"]:
                entry = Entry(None, r["role"], r["text"], False, r["truncated"], r["copies"] + (r["text"] is not None))
                entries.append(entry)
            start, leave = tops[row["entry"]], tops[row["leave"]]
            audit = parser.run([e.token for e in entries], start)[leave][1] + row["tail"]
            yield {"conv": row["conv"], "number": row["number"], "list": _turns(parser, entries, audit, start)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(rendered(_rows(batches)), arrow)

    return run


def _digester(schema: StructType) -> Callable:
    """SHA-256 of each conversation, streamed over its blocks in order."""
    arrow = to_arrow_schema(schema)

    def digested(rows: Iterator[dict]) -> Iterator[dict]:
        for conv, group in _runs(rows):
            state, empty = hashlib.sha256(), True
            for row in group:
                if row["bytes"]:
                    state.update(row["bytes"] if empty else b"\n" + row["bytes"])
                    empty = False
            yield {"conv": conv, "sha": state.hexdigest()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(digested(_rows(batches)), arrow)

    return run


def _grouped(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions("conv", *order)


class Repair:
    """The repaired conversations of a table of turns.

    Turns are taken by number, nulls first, turns of one number by role and then by the
    digest of the text. A null role or text counts as one space. The first fault of a turn
    counts: *blank* (nothing but blanks), *duplicate* (role and text seen earlier in the
    conversation), *truncated* (its last character that is no blank is not one of ``.!?``).
    Blank and duplicate turns are deleted. Every other turn is kept at no cost, given the
    role user or assistant at 2, or deleted at 3; empty turns of either role are inserted
    anywhere at 2 each; truncated turns that stay cost 1 more. The edits are the cheapest
    after which the initials of the roles follow ``(s?(ua)+)?``, and among those the ones
    whose initials (D, I, K, R), in order, come first.

    A null conversation id is a conversation of its own. An empty role has no initial that
    fits. Repeated rows are duplicates. Texts and conversations may have any length, but
    the audit of one conversation must fit a string. Other columns are not looked at. An
    empty table gives an empty table.
    """

    def __init__(self, rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", texts: bool = False) -> None:
        kind = rows.schema[conv].dataType.simpleString()
        counts = ", ".join(f"{c} long" for c in COUNTS if c not in STATS.replace(",", " ").split())
        schema = rows.sparkSession.createDataFrame(
            [], f"conv {kind}, sha string, {counts}, audit string, {TURNS}, {STATS}, block long, "
            "paths array<struct<entry:int, exit:int, cost:long, audit:string>>, roles array<struct<role:string, text:string, truncated:boolean, copies:long>>",
        ).schema
        solved = cut_lineage(_ordered(rows, conv, turn, role, text).mapInArrow(_solver(schema, texts), schema))
        self.whole = solved.where("block IS NULL").select("conv", *COUNTS, "audit", "sha", "list")
        blocks = solved.where("block IS NOT NULL")
        chain = rows.sparkSession.createDataFrame(
            [], f"conv {kind}, id long, entry int, leave int, tail string, number long, audit string, " + ", ".join(f"{c} long" for c in COUNTS)
        ).schema
        narrow = _grouped(blocks.drop("roles", "list"), "block")
        self.chained = cut_lineage(narrow.mapInArrow(_chainer(chain), chain))
        parts = rows.sparkSession.createDataFrame([], f"conv {kind}, number long, {TURNS}").schema
        chosen = self.chained.select("id", "entry", "leave", "tail", "number")
        payload = blocks.select("conv", F.col("block").alias("id"), "roles")
        self.parts = cut_lineage(payload.join(chosen, "id").mapInArrow(_renderer(parts), parts))
        self.kind = kind

    def summary(self) -> DataFrame:
        """One row (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, sha) per conversation."""
        lines = F.concat_ws("\n", F.transform("list", lambda t: F.concat(t["role"], F.lit(":"), t["text"])))
        schema = self.parts.sparkSession.createDataFrame([], f"conv {self.kind}, sha string").schema
        shas = _grouped(self.parts.select("conv", "number", lines.cast("binary").alias("bytes")), "number").mapInArrow(_digester(schema), schema)
        long = self.chained.where("audit IS NOT NULL").select(F.col("conv").alias("__conv"), *COUNTS, "audit")
        crossing = shas.join(long, F.col("conv").eqNullSafe(F.col("__conv"))).select("conv", *COUNTS, "audit", "sha")
        return self.whole.select("conv", *COUNTS, "audit", "sha").unionByName(crossing)

    def turns(self) -> DataFrame:
        """One row (conv, block, position, role, text, edit) per turn that is left; needs ``texts=True``.

        Rows are in order by (block, position) within their conversation.
        """
        both = self.whole.select("conv", F.lit(0).cast("long").alias("block"), "list").unionByName(
            self.parts.select("conv", F.col("number").alias("block"), "list")
        )
        return both.select("conv", "block", F.posexplode("list").alias("position", "t")).select("conv", "block", "position", "t.role", "t.text", "t.edit")
