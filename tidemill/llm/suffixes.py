"""Suffix-array deduplication: bytes covered by a long string that occurs elsewhere too.

*Finding what to compare.* Every window of ``LENGTH`` bytes has an anchor, the gram of
``GRAM`` bytes with the least hash in it, and equal windows have it at the same place.
Anchors that occur once end there. The text around an anchor in which its windows lie
is a context; equal contexts are one from then on, whatever their number.

*Sorting.* The contexts of a shared anchor become strings of symbols, cut in both
directions from the anchor, which is one symbol itself. Their suffixes are sorted by
doubling: ranks of the first 1, 2, 4 ... symbols are refined until no string is longer,
all suffixes of a block at once. Neighbours whose common
prefix is long enough hold equal windows; windows that begin between two symbol
borders take the few bytes before the border into account.

*Large groups.* The contexts of an anchor with many different ones are dealt out to
several blocks; the windows that are single in their block then meet those of the
other blocks by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from tidemill.session import cut_lineage

LENGTH = 400
GRAM = 200
#: Bytes on either side of an anchor that its windows reach.
REACH = LENGTH - GRAM
#: Bytes of a symbol.
UNIT = 25
#: Contexts sorted together; those of one anchor that has more are dealt out to blocks.
BLOCK = 4096
LARGE = 65536
#: Bits of the sets that tasks test, whatever the number of members; no member fails the test.
FILTER_BITS = 24

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Hashes:
    """Polynomial hashes modulo 2**64 of all substrings of a text, and their powers, kept between texts."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            n = 2 * len(data) + 2
            self.up, self.down = np.full(n, BASE), np.full(n, INVERSE)
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.down[: len(data)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((prefix[end] - prefix[start]) * self.up[start] + (end - start).astype(np.uint64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    step = 1
    while step < width:
        move = min(step, width - step)
        values = np.minimum(values[: len(values) - move], values[move:])
        step += move
    return values


def anchors(data: np.ndarray, hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the anchors of all windows, their gram hashes and their context hashes."""
    n = len(data)
    if n < LENGTH:
        none = np.zeros(0, np.uint64)
        return none.astype(np.int64), none, none
    prefix = hashes.prefix(data)
    begin = np.arange(n - GRAM + 1)
    gram = hashes.of(prefix, begin, begin + GRAM)
    width = LENGTH - GRAM + 1
    least = _least(gram, width)
    edge = np.zeros(width - 1, np.uint64)
    # A gram is an anchor if it is as small as the least of some window around it.
    most = ~_least(~np.concatenate((edge, least, edge)), width)
    at = np.flatnonzero(gram == most)
    low, high = np.maximum(at - REACH, 0), np.minimum(at + LENGTH, n)
    context = _mix(hashes.of(prefix, low, high) + (at - low).astype(np.uint64) * BASE)
    return at, gram[at], context


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    v = values.view(np.int64)
    return (bits[(v & ((1 << FILTER_BITS) - 1)) >> 5] >> (v & 31).astype(np.uint32)) & 1 == 1


def _bits(values: DataFrame, column: str) -> Broadcast:
    low = F.col(column).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    one = F.expr(f"shiftleft(1L, cast({column} & 31 as int))")
    words = values.groupBy(F.shiftright(low, 5).cast("int").alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return values.sparkSession.sparkContext.broadcast(out)


def _scan(shared: Broadcast | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts (row, text) to anchors: gram hashes alone, or with place and context for those that may be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").cast(pa.binary())):
                at, gram, context = anchors(np.frombuffer(text.as_py() or b"", np.uint8), hashes)
                if shared is not None:
                    keep = _has(shared.value, gram)
                    at, gram, context = at[keep], gram[keep], context[keep]
                    for into, part in zip(out[1:], (context, np.full(len(at), row), at)):
                        into.append(part)
                out[0].append(gram)
            flat = [np.concatenate(c) if c else np.zeros(0, np.uint64) for c in out]
            if shared is None:
                yield pa.RecordBatch.from_arrays([_signed(flat[0])], names=["gram"])
            else:
                columns = [_signed(flat[0]), _signed(flat[1]), pa.array(flat[2].astype(np.int64)), pa.array(flat[3].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["gram", "context", "row", "at"])

    return run


def _cut(spots: Broadcast, large: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Texts to the contexts whose place may be asked for; ``deal`` tells the blocks of a large group apart, 0 elsewhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for start in range(0, batch.num_rows, 50):
                part = batch.slice(start, 50)
                grams, contexts, deals, before, texts = [], [], [], [], []
                for row, text in zip(part.column("row").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                    data = text or b""
                    at, gram, context = anchors(np.frombuffer(data, np.uint8), hashes)
                    keep = _has(spots.value, spot(np.full(len(at), row), at))
                    at, gram, context = at[keep], gram[keep], context[keep]
                    grams.append(gram)
                    contexts.append(context)
                    deals.append(np.where(_has(large.value, gram), (context & np.uint64(63)).astype(np.int32) + 1, 0))
                    before += np.minimum(at, REACH).tolist()
                    texts += [data[max(0, a - REACH) : a + LENGTH] for a in at.tolist()]
                columns = [_signed(np.concatenate(grams)), _signed(np.concatenate(contexts)), pa.array(np.concatenate(deals).astype(np.int32)), pa.array(before, pa.int32()), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["gram", "context", "deal", "before", "content"])

    return run


def spot(row: np.ndarray, at: np.ndarray) -> np.ndarray:
    return _mix(row.astype(np.int64).view(np.uint64) * BASE + at.astype(np.int64).view(np.uint64))


def suffix_array(symbols: list[int] | np.ndarray, starts: list[int] | np.ndarray) -> np.ndarray:
    """Order of all suffixes of several strings laid end to end; ``starts`` has their starts and the end.

    Suffixes end with their string; a string's end is below all symbols, and equal
    suffixes are neighbours in no certain order. Ranks of the first 1, 2, 4 ... symbols
    are refined until no string is longer, so the rounds grow with the logarithm of the
    longest string only.
    """
    symbols, starts = np.asarray(symbols, np.int64), np.asarray(starts, np.int64)
    n = len(symbols)
    length = np.diff(starts)
    end = np.repeat(starts[1:], length)
    place = np.arange(n)
    order, rank = _ranks(symbols)
    step, longest = 1, int(length.max(initial=0))
    while step < longest:
        behind = np.zeros(n, np.int64)
        inside = np.flatnonzero(place + step < end)
        behind[inside] = rank[inside + step]
        order, rank = _ranks(rank * np.int64(n + 1) + behind)
        step *= 2
    return order


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, and for each its place among the distinct ones, from 1."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else 0
    return order, rank


def repeated(groups: np.ndarray, before: np.ndarray, contents: list[bytes]) -> np.ndarray:
    """For each context, which windows occur in another context of its group: (contexts, REACH + 1), by bytes before the anchor."""
    m = len(contents)
    after = np.array([len(c) for c in contents], np.int64) - before - GRAM
    # Bytes before the anchor, ending at its column REACH, and after it.
    left, right = np.zeros((m, REACH), np.uint8), np.zeros((m, REACH), np.uint8)
    for i, c in enumerate(contents):
        b = int(before[i])
        left[i, REACH - b :] = np.frombuffer(c, np.uint8, b)
        right[i, : after[i]] = np.frombuffer(c, np.uint8, int(after[i]), b + GRAM)
    k = REACH // UNIT
    n_left, n_right = before // UNIT, -(-after // UNIT)
    # Symbols with their length as last byte sort as the bytes do, also where a text ends.
    units = np.zeros((m, 2 * k, UNIT + 1), np.uint8)
    units[:, :k, :UNIT] = left.reshape(m, k, UNIT)
    units[:, k:, :UNIT] = right.reshape(m, k, UNIT)
    units[:, :k, UNIT] = UNIT
    units[:, k:, UNIT] = np.clip(after[:, None] - np.arange(k) * UNIT, 0, UNIT)
    column = np.arange(2 * k)
    used = np.where(column < k, column >= k - n_left[:, None], column - k < n_right[:, None])
    distinct, rank = np.unique(np.ascontiguousarray(units[used]).view(f"S{UNIT + 1}").ravel(), return_inverse=True)
    grid = np.full((m, 2 * k + 1), -1, np.int64)
    bytes_of = np.zeros((m, 2 * k + 1), np.int64)
    inner = np.concatenate((column[:k], column[k:] + 1))
    mask = np.zeros((m, 2 * k + 1), bool)
    mask[:, inner] = used
    grid[mask] = rank
    bytes_of[mask] = units[used][:, UNIT]
    grid[:, k] = len(distinct) + np.unique(groups, return_inverse=True)[1]
    bytes_of[:, k] = GRAM
    mask[:, k] = True
    row, col = np.nonzero(mask)
    symbols, widths = grid[mask], bytes_of[mask]
    starts = np.concatenate(([0], np.cumsum(mask.sum(1))))
    order = suffix_array(symbols, starts)

    # Common bytes of neighbours: whole symbols, then the equal beginning of the first two that differ.
    ends = starts[row + 1]
    x, y = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(x), np.int64)
    going = np.ones(len(x), bool)
    table = distinct.view(np.uint8).reshape(-1, UNIT + 1) if len(distinct) else np.zeros((1, UNIT + 1), np.uint8)
    end_x, end_y = ends[order[:-1]], ends[order[1:]]
    for _ in range(2 * k + 1):
        going &= (x < end_x) & (y < end_y)
        live = np.flatnonzero(going)
        if not len(live):
            break
        a, b = symbols[x[live]], symbols[y[live]]
        same = a == b
        common[live[same]] += widths[x[live[same]]]
        last, a, b = live[~same], a[~same], b[~same]
        plain = (a < len(distinct)) & (b < len(distinct))
        last, a, b = last[plain], a[plain], b[plain]
        if len(last):
            differ = table[a, :UNIT] != table[b, :UNIT]
            equal = np.where(differ.any(1), differ.argmax(1), UNIT)
            common[last] += np.minimum(equal, np.minimum(table[a, UNIT], table[b, UNIT]))
        going[live[~same]] = False
        x[live[same]] += 1
        y[live[same]] += 1

    # Suffixes that begin at a border at or before the anchor, in sorted order.
    begins = np.flatnonzero(col[order] <= k)
    suffix = order[begins]
    who, depth = row[suffix], (k - col[suffix]) * UNIT
    out = np.zeros((m, REACH + 1), bool)
    value = np.zeros(len(suffix), np.uint64)
    for r in range(UNIT):
        if r:  # one more byte before the border
            at = REACH - depth - r
            value = value * BASE + np.where(at >= 0, left[who, np.maximum(at, 0)], 0).astype(np.uint64) + np.uint64(1)
        reach = depth + r
        fits = np.flatnonzero((reach <= before[who]) & (reach <= REACH) & (REACH - reach <= after[who]))
        if not len(fits):
            continue
        interval = np.concatenate(([0], np.cumsum(common < LENGTH - r)))[begins[fits]]
        key = _mix(value[fits] + interval.astype(np.uint64) * INVERSE)
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        hit = fits[count[inverse] > 1]
        out[who[hit], reach[hit]] = True
    return out


def _sorter() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Contexts sorted by (gram, deal) to their repeated windows; of dealt ones also the windows that other blocks may hold."""
    names = ["gram", "context", "windows", "window", "block", "reach"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32()]

    def sort(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, tuple] = {}
        for r in rows:
            seen.setdefault((r[0], r[1]), r)
        rows = list(seen.values())
        gram = np.array([r[0] for r in rows], np.int64)
        before = np.array([r[3] for r in rows], np.int64)
        found = repeated(gram, before, [r[4] for r in rows])
        packed = np.packbits(found, axis=1)
        hit = np.flatnonzero(found.any(1)).tolist()
        columns = [[rows[i][0] for i in hit], [rows[i][1] for i in hit], [packed[i].tobytes() for i in hit], [None] * len(hit), [None] * len(hit), [None] * len(hit)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
        hashes, known = Hashes(), set()
        for i, r in enumerate(rows):
            if not r[2]:
                continue
            data = np.frombuffer(r[4], np.uint8)
            begin = np.arange(0, len(data) - LENGTH + 1)
            reach = r[3] - begin
            begin, reach = begin[(reach >= 0) & (reach <= REACH)], reach[(reach >= 0) & (reach <= REACH)]
            # With its place: one window with two equal anchors must not be taken for two windows.
            window = _mix(hashes.of(hashes.prefix(data), begin, begin + LENGTH) + reach.astype(np.uint64) * INVERSE).view(np.int64)
            # A window that repeats in this block needs nothing more; one of its kind tells the other blocks.
            take = [j for j, (w, l) in enumerate(zip(window.tolist(), reach.tolist())) if not found[i, l] or not (w in known or known.add(w))]
            n = len(take)
            columns = [[r[0]] * n, [r[1]] * n, [None] * n, window[take].tolist(), [r[2]] * n, reach[take].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for r in zip(*(batch.column(n).to_pylist() for n in ("gram", "context", "deal", "before", "content"))):
                # A group stays together.
                if len(rows) >= BLOCK and (r[0], r[2]) != (rows[-1][0], rows[-1][2]):
                    yield from sort(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield from sort(rows)

    return run


def _remover() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept"]
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                part = batch.slice(start, 100)
                out = []
                for text, found in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("found").to_pylist()):
                    data = np.frombuffer(text or b"", np.uint8)
                    n = len(data)
                    begins = np.zeros(n + 1, bool)
                    for f in found or ():
                        at = f["at"]
                        if f["windows"] is None:
                            begins[max(0, at - REACH) : min(at, n - LENGTH) + 1] = True
                        else:
                            reach = np.flatnonzero(np.unpackbits(np.frombuffer(f["windows"], np.uint8), count=REACH + 1))
                            begins[at - reach] = True
                    change = begins.astype(np.int64)
                    change[LENGTH:] -= begins[: max(0, n + 1 - LENGTH)]
                    covered = np.cumsum(change)[:n] > 0
                    spans = int(np.count_nonzero(covered[1:] & ~covered[:-1])) + int(n > 0 and covered[0])
                    out.append((n, int(covered.sum()), spans, data[~covered].tobytes()))
                columns = [part.column("id"), *(pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary())))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, n_bytes, n_removed, n_spans, kept), one per row of ``docs``.

    Texts are bytes of UTF-8; a null text is empty. A byte goes if some string of
    ``LENGTH`` bytes over it begins anywhere else as well, in the same or another row,
    judged on the input. Repeated rows are occurrences of their own. Null ids stay; an
    empty table gives an empty table; other columns are not read. Equality of grams,
    contexts and the bytes before a border is that of 64-bit hashes. ``docs`` must give
    the same rows in the same order when read again, as files do. A text is scanned whole
    in one task, however long it is, and its grams are spread like all others.
    """
    kind = docs.select(key).schema[0].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    texts = rows.select("row", "text")
    often = texts.mapInArrow(_scan(None), "gram long").groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = cut_lineage(texts.mapInArrow(_scan(_bits(often, "gram")), "gram long, context long, row long, at int"))
    contexts = cut_lineage(
        held.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "at")).alias("place"))
    )
    several = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    asked = cut_lineage(contexts.join(several, "gram").select("gram", "m", "place.row", "place.at"))

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([_signed(spot(batch.column("row").to_numpy(), batch.column("at").to_numpy()))], names=["spot"])

    places = _bits(asked.select("row", "at").mapInArrow(spots, "spot long"), "spot")
    large = _bits(asked.where(F.col("m") > LARGE).select("gram").distinct(), "gram")
    parts = texts.mapInArrow(_cut(places, large), "gram long, context long, deal int, before int, content binary")
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = parts.repartition(n, "gram", "deal").sortWithinPartitions("gram", "deal")
    shape = "gram long, context long, windows binary, window long, block long, reach int"
    sorted_ = cut_lineage(dealt.mapInArrow(_sorter(), shape))

    single = sorted_.where("window is not null")
    across = single.groupBy("window").agg(F.min("block").alias("a"), F.max("block").alias("b")).where("a <> b").select("window")
    late = single.join(across, "window").groupBy("gram", "context").agg(F.collect_set("reach").alias("reach"))
    late = late.mapInArrow(_pack_reach, "gram long, context long, windows binary")
    everywhere = contexts.where("n > 1").select("gram", "context", F.lit(None).cast("binary").alias("windows"))
    once = contexts.where("n = 1").select("gram", "context")
    partly = sorted_.where("windows is not null").select("gram", "context", "windows").unionByName(late).join(once, ["gram", "context"])
    covers = everywhere.unionByName(partly)
    found = held.join(covers, ["gram", "context"]).groupBy("row").agg(F.collect_list(F.struct("at", "windows")).alias("found"))
    met = rows.join(found, "row", "left").select("id", "text", "found")
    return met.mapInArrow(_remover(), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def _pack_reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = []
        for reach in batch.column("reach").to_pylist():
            bits = np.zeros(REACH + 1, bool)
            bits[reach] = True
            packed.append(np.packbits(bits).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("gram"), batch.column("context"), pa.array(packed, pa.binary())], names=["gram", "context", "windows"])
