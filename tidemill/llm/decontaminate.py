"""Benchmark decontamination with templates.

Words become lower-case literals or typed placeholders (number, name, unit), so a
question with other numbers or names has the template of the original. Windows of
template tokens of the documents meet those of the benchmark in an equality join;
then the slots must be consistent: two slots hold one value in the document exactly
where they do in the benchmark.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemill.session import cut_lineage

#: Tokens in a window at least. Items that are shorter are one window of their own length.
WINDOW = 10
#: Literals that a window needs at least, and grows until it has them; placeholders alone say nothing.
LITERALS = 6
#: The set of benchmark windows that tasks test first has this many bits, whatever its number of entries.
FILTER_BITS = 24
#: Words that a task remembers.
REMEMBERED = 500_000

# Fixed values.
NUMBER_WORDS = set(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = set(
    "mm cm m km in ft yd mi mg g kg lb oz ml l s sec min h hr hrs ms hz khz mhz ghz kb mb gb tb w kw v a mph kmh km/h m/s "
    "percent dollars dollar cents euros euro pounds pound meters meter metres metre kilometers kilometer kilometres "
    "centimeters miles mile feet foot inches inch yards grams gram kilograms kilogram liters liter litres litre seconds "
    "second minutes minute hours hour days day weeks week months month years year degrees degree".split()
)
NUMBER = re.compile(r"[-+]?[^\w\s]?\d[\d.,:/]*(?:[^\W\d_]{0,3}|%|°[cf]?)")

STRIP = string.punctuation + "“”‘’«»¡¿…–—"
ENDS = (".", "!", "?", ":", ";", "…")
CAPITAL, END, NUM, UNIT, NONE = 1, 2, 4, 8, 16
FLAGS = np.uint64(0xFF)
NUM_TOKEN, NAME_TOKEN, UNIT_TOKEN = (np.uint64(xxhash.xxh64_intdigest(t, 7) & ~0xFF) for t in (b"<number>", b"<name>", b"<unit>"))
STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Lexicon(dict):
    """Word to its literal's hash with flags in the low byte; ``\\n`` is a mark without a token."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        if word == "\n":
            value = NONE | END
        else:
            letters = word.isalpha()  # nothing to strip, and no digit
            bare = word if letters else word.strip(STRIP)
            low = bare.lower()
            flags = END if not letters and word.rstrip("\"'”’»)]").endswith(ENDS) else 0
            if not bare:
                flags |= NONE
            if low in NUMBER_WORDS or not (letters or bare.isalpha()) and (NUMBER.fullmatch(low) or NUMBER.fullmatch(word.rstrip(".,;:!?"))):
                flags |= NUM
            if low in UNITS:
                flags |= UNIT
            if len(bare) > 1 and bare[0].isupper() and bare[1:].islower():
                flags |= CAPITAL
            value = xxhash.xxh64_intdigest(low.encode(), 7) & ~0xFF | flags
        self[word] = value
        return value


CUT = re.compile(r"\n|[^\s]+")


def template(text: str, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """Of each token: the hash of its literal, what it is for (a flag, 0 for a literal), whether it opens a sentence, and the raw word.

    A capitalised word is a name; where it opens a sentence it may be one or a literal.
    """
    words = CUT.findall(text)
    coded = np.fromiter(map(lexicon.__getitem__, words), np.uint64, len(words))
    flags = (coded & FLAGS).astype(np.uint8)
    opens = np.ones(len(words), bool)
    opens[1:] = (flags[:-1] & END) > 0
    # A mark of its own, such as a quote, does not hide that a sentence begins.
    real = (flags & NONE) == 0
    starts = np.maximum.accumulate(np.where(real, np.arange(len(words)), -1)) if len(words) else np.zeros(0, int)
    before = np.concatenate(([-1], starts[:-1])) if len(words) else starts
    ended = np.concatenate(([0], np.cumsum((flags & END) > 0)))
    opens |= ended[:-1] > ended[np.maximum(before, 0)]
    opens |= before < 0
    at = np.flatnonzero(real)
    flags, opens, coded = flags[at], opens[at], coded[at]
    number = (flags & NUM) > 0
    unit = (flags & UNIT) > 0
    unit[1:] &= number[:-1]
    unit[:1] = False
    name = ((flags & CAPITAL) > 0) & ~number & ~unit
    kinds = np.where(number, NUM, np.where(name, CAPITAL, np.where(unit, UNIT, 0))).astype(np.uint8)
    return coded & ~FLAGS, kinds, opens & name, [words[i] for i in at.tolist()]


def powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1), base, np.uint64), dtype=np.uint64)))


class Sums:
    """Hashes of any run of tokens from running sums; the powers grow with the longest text seen."""

    def __init__(self, step: np.uint64) -> None:
        self.step, self.inverse = step, np.uint64(pow(int(step), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(tokens):
            self.up, self.down = powers(self.step, 2 * len(tokens)), powers(self.inverse, 2 * len(tokens))
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(tokens * self.down[: len(tokens)], dtype=np.uint64)))

    def runs(self, sums: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = (sums[end] - sums[at]) * self.up[end - 1]
        return out ^ (out >> np.uint64(31))


class Texts:
    """The readings of a text as templates, and their windows.

    A window goes on from its first token until it has ``window`` tokens and ``literals``
    literals, so a passage of many slots has longer windows and not none.
    """

    def __init__(self, window: int, literals: int) -> None:
        self.window, self.literals, self.lexicon = window, literals, Lexicon()
        self.sums = [Sums(step) for step in STEP]

    def readings(self, text: str) -> tuple[np.ndarray, list[str], list[tuple[np.ndarray, np.ndarray, np.ndarray | None]]]:
        """Literals, raw words and (tokens, slots, which tokens make this reading another one); opening words are literals in one, names in the other."""
        plain, kinds, opening, words = template(text, self.lexicon)
        out = []
        for reading in (~opening, None) if opening.any() else (None,):
            tokens, slot = plain.copy(), kinds > 0 if reading is None else (kinds > 0) & reading
            for kind, token in ((NUM, NUM_TOKEN), (CAPITAL, NAME_TOKEN), (UNIT, UNIT_TOKEN)):
                tokens[slot & (kinds == kind)] = token
            out.append((tokens, slot, opening if reading is None and len(out) else None))
        return plain, words, out

    def ends(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the windows that are whole before the text ends."""
        found = np.concatenate(([0], np.cumsum(~slot)))
        at = np.arange(max(0, len(slot) - self.window + 1))
        end = np.maximum(at + self.window, np.searchsorted(found, found[at] + self.literals))
        good = end <= len(slot)
        return at[good], end[good]

    def fixed(self, slot: np.ndarray, length: int, literals: int) -> tuple[np.ndarray, np.ndarray]:
        found = np.concatenate(([0], np.cumsum(~slot)))
        at = np.arange(max(0, len(slot) - length + 1))
        at = at[found[at + length] - found[at] >= literals]
        return at, at + length


def pattern(values: list[str]) -> str:
    """Which slots hold one value: the same text for two windows means that a one-to-one renaming maps one to the other."""
    seen: dict[str, int] = {}
    return ",".join(str(seen.setdefault(v.strip(STRIP).lower(), len(seen))) for v in values)


SCHEMA = "form int, length int, hash long, proof long, slots string, at int"
#: Forms of an entry: a window, a whole short item as template, a whole item word by word.
PART, SHORT, EXACT = 0, 1, 2


def _windows(kind: pa.DataType, window: int, literals: int, lengths: dict[int, list[int]] | None = None, passes: Callable[[np.ndarray], np.ndarray] | None = None):
    """Rows (id, row, form, length, hash, proof, slots, at); ``lengths``, by form, are those of the items, and None makes the entries of items."""
    names = ("id", "row", "form", "length", "hash", "proof", "slots", "at")
    types = (kind, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32())

    def parts(texts: Texts, plain: np.ndarray, forms: list) -> Iterator[tuple]:
        """(form, tokens, slots, starts, ends) to be looked up or, of an item, to be indexed."""
        n, lacking = len(plain), False
        none = np.zeros(n, bool)
        for tokens, slot, other in forms:
            found = [(PART, *texts.ends(slot))]
            for length in lengths[SHORT] if lengths is not None else [n] if 0 < n < window else []:
                found.append((SHORT, *texts.fixed(slot, length, literals)))
            lacking |= not any(len(at) for _, at, _ in found)
            changed = None if other is None else np.concatenate(([0], np.cumsum(other)))
            for form, at, end in found:
                if changed is not None:  # where both readings are the same there is one entry
                    good = changed[end] > changed[at]
                    at, end = at[good], end[good]
                yield form, tokens, slot, at, end
        for length in lengths[EXACT] if lengths is not None else [n] if n and (lacking or n <= window) else []:
            yield EXACT, plain, none, *texts.fixed(none, length, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = Texts(window, literals)
        first, second = texts.sums
        for batch in batches:
            rows = []
            for key, number, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1)):
                plain, words, forms = texts.readings(text.as_py() or "")
                last, sums = None, None
                for form, tokens, slot, at, end in parts(texts, plain, forms):
                    if lengths is not None and form == PART and len(at):
                        good = end - at <= lengths[PART][-1] if lengths[PART] else np.zeros(len(at), bool)
                        at, end = at[good], end[good]
                    if not len(at):
                        continue
                    if tokens is not last:
                        last, sums = tokens, first.of(tokens)
                    hashes = first.runs(sums, at, end)
                    if passes is not None:
                        good = passes(hashes)
                        at, end, hashes = at[good], end[good], hashes[good]
                    for i, e, h in zip(at.tolist(), end.tolist(), hashes.view(np.int64).tolist()):
                        proof = second.runs(second.of(tokens[i:e]), np.zeros(1, int), np.array([e - i]))
                        values = [words[j] for j in range(i, e) if slot[j]]
                        rows.append((key, number, form, e - i, h, int(proof.view(np.int64)[0]), pattern(values), i))
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def find(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, literals: int = LITERALS
) -> DataFrame:
    """Rows (id, item, windows, first): documents that hold windows of a benchmark item.

    ``windows`` counts the document's windows that match, ``first`` is the token where
    the first one begins. Null or empty texts match nothing, on either side. A window
    grows beyond ``window`` tokens until it has ``literals`` literals. Every item with a
    token has an entry: one that is too short for a window must match as a whole, and
    where its literals are too few, word by word. Null ids and items are
    values like others; rows with one id count together. Empty tables give no rows.
    Texts are read whole. Columns besides key and text are not read.

    Tasks first test a window against a bit set of fixed size, which drops no match;
    what passes goes into the join, where adaptive execution splits a passage that
    many documents share.
    """
    spark = docs.sparkSession
    doc_field, item_field = docs.select(key).schema[0].dataType, benchmark.select(item).schema[0].dataType

    number = F.monotonically_increasing_id().alias("row")
    items = benchmark.select(F.col(item).alias("id"), F.col(item_text).alias("text"), number).mapInArrow(
        _windows(_arrow(item_field), window, literals), f"id {item_field.simpleString()}, row long, {SCHEMA}"
    )
    known = cut_lineage(items.select(F.col("id").alias("item"), "form", "length", "hash", "proof", "slots").distinct())
    low = F.col("hash").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = known.groupBy(F.shiftright(low, 5).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(hash & 31 as int))")).alias("bits")).collect()
    lengths: dict[int, list[int]] = {PART: [], SHORT: [], EXACT: []}
    for r in known.select("form", "length").distinct().orderBy("length").collect():
        lengths[r["form"]].append(r["length"])
    bits = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    for r in words:
        bits[r["word"]] = r["bits"]
    shared = spark.sparkContext.broadcast(bits)

    def passes(hashes: np.ndarray) -> np.ndarray:
        at = _bit(hashes)
        return (shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1

    found = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), number).mapInArrow(
        _windows(_arrow(doc_field), window, literals, lengths, passes), f"id {doc_field.simpleString()}, row long, {SCHEMA}"
    )
    # A window that several entries of an item match counts once.
    met = found.join(known, ["form", "length", "hash", "proof", "slots"]).groupBy("id", "item", "row", "at").agg(F.lit(1).alias("one"))
    return met.groupBy("id", "item").agg(F.count(F.lit(1)).alias("windows"), F.min("at").alias("first"))


def _arrow(field) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field)


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents in which ``find`` finds an item. Rows without an id are kept, because nothing names them."""
    hit = find(docs, benchmark, key, text, **options).select(F.col("id").alias("__hit")).distinct()
    return docs.join(hit, docs[key] == hit["__hit"], "left_anti")
