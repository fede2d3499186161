"""Line deduplication as an exact set-similarity join.

A line is the set of its words, ordered by rarity. Two sets with Jaccard similarity t
or more share two words in their prefixes, have similar sizes, and the shared words
stand early enough in both. An equality join on prefix words under these filters gives
candidates, and the similarity is computed from the sets.

A line goes when an earlier line is similar, so one witness is enough. Lines with
equal sets are one entry from the start. Each entry first meets the earliest holder of
each of its prefix words; groups of copies, however large, end there. Entries without
a witness meet a few holders of their frequent keys, and only those that are still
without one meet all earlier holders.

Every set has sketches of 64 and of 128 bits; a word flips one bit of each. A word that
only one of two sets has flips one bit of their difference, so sketches that differ in
more bits than similar sets can differ in words tell a pair apart where it meets.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.scratch import drop_tables, short_lived_shuffles
from tidemill.session import cut_lineage

SIMILARITY = 0.8
#: Counters for word frequencies; words share one by hash, so their number is fixed.
COUNTERS = 1 << 20
#: Bits of the sets that tasks test before a shuffle, whatever the number of members; no member fails the test.
FILTER_BITS = 24

#: Lines of more words than this are not indexed by pairs of words.
SHORT = 60
#: A key with so many holders is met by a few of them first, of which there are about ``FEW``.
HOT, FEW = 64, 16

SPACE = r"[\x20\x09-\x0D]+"
PLACE = ("doc", "version", "line")
#: The sketch of 64 bits, and the two halves of that of 128.
SMALL, WIDE = ("sketch",), ("low_sketch", "high_sketch")
SKETCHES = SMALL + WIDE


def frequencies(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Occurrences of words over all documents, by the low bits of their hash."""
    words = docs.select(F.explode(F.split(F.col(text), SPACE)).alias("w")).where("w <> ''")
    counter = F.xxhash64("w").bitwiseAND(F.lit(COUNTERS - 1)).cast("int")
    counted = words.groupBy(counter.alias("counter")).agg(F.count(F.lit(1)).alias("n")).toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[counted["counter"].to_numpy()] = counted["n"].to_numpy()
    return out


def _shared(threshold: float) -> int:
    """Words that the prefixes of two similar sets share at least; a prefix is one longer for the second.

    Different sets with one common word have a similarity of a half at most.
    """
    return 2 if threshold > 0.5 else 1


def _mix(h: np.ndarray, factor: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(factor)
    return h ^ (h >> np.uint64(32))


def _cut(counts: Broadcast, threshold: float, kind: pa.DataType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents (doc, version, text) to their lines: place, identity of the word set, its size, its prefix as 32-bit hashes, and its sketches."""
    names = [*PLACE, "entry", "size", "prefix", *SKETCHES]
    types = [kind, pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, digest = counts.value, xxhash.xxh64_intdigest
        for batch in batches:
            for start in range(0, batch.num_rows, 50):
                part = batch.slice(start, 50)
                at, lines, sizes, hashes = [], [], [], []
                for i, text in enumerate(part.column("text").cast(pa.binary()).to_pylist()):
                    for n, line in enumerate((text or b"").split(b"\n")):
                        if words := set(line.split()):
                            at.append(i)
                            lines.append(n)
                            sizes.append(len(words))
                            hashes += [digest(w, 42) for w in words]
                h = np.array(hashes, np.uint64)
                size = np.array(sizes, np.int64)
                first = np.cumsum(size) - size
                owner = np.repeat(np.arange(len(size)), size)
                rank = count[(h & np.uint64(COUNTERS - 1)).astype(np.int64)]
                h = h[np.lexsort((h, rank, owner))]
                entry = np.zeros(len(size), np.int64)
                sketches = [entry] * len(SKETCHES)
                if len(size):  # the sum does not depend on the order of the words
                    small, wide = np.uint64(1) << (h >> np.uint64(58)), np.uint64(1) << (h >> np.uint64(45) & np.uint64(63))
                    high = (h >> np.uint64(51) & np.uint64(1)).astype(bool)
                    sketches = [np.bitwise_xor.reduceat(x, first).view(np.int64) for x in (small, np.where(high, 0, wide), np.where(high, wide, 0))]
                    entry = _mix(np.add.reduceat(_mix(h, 0x9FB21C651E98DF25), first), 0xD6E8FEB86659FD93).view(np.int64)
                length = np.minimum(size, size - np.ceil(threshold * size - 1e-9).astype(np.int64) + _shared(threshold))
                ends = np.cumsum(length)
                taken = np.repeat(first - (ends - length), length) + np.arange(int(length.sum()))
                prefix = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(h[taken].view(np.int64).astype(np.int32)))
                where = part.select(["doc", "version"]).take(pa.array(at, pa.int64()))
                columns = [where.column(0).cast(types[0]), where.column(1), pa.array(lines, types[2]), pa.array(entry), pa.array(size, pa.int32()), prefix]
                columns += [pa.array(x) for x in sketches]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _bits(values: DataFrame, column: str) -> Broadcast:
    """A bit set of fixed size with every value of the column in it."""
    low = F.col(column).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    one = F.expr(f"shiftleft(1L, cast({column} & 31 as int))")
    words = values.groupBy(F.shiftright(low, 5).cast("int").alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return values.sparkSession.sparkContext.broadcast(out)


def _tested(rows: DataFrame, column: str, bits: Broadcast) -> DataFrame:
    """The rows whose value may be in the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column(column).to_numpy()
            yield batch.filter(pa.array((bits.value[(v & ((1 << FILTER_BITS) - 1)) >> 5] >> (v & 31).astype(np.uint32)) & 1 == 1))

    return rows.mapInArrow(run, rows.schema)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (order, content) for the places (order, doc, version, line) of ``wanted``."""
    wanted = cut_lineage(wanted.withColumn("spot", F.xxhash64(*PLACE)))
    cut = docs.select("doc", "version", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    near = _tested(cut.select(F.xxhash64(*PLACE).alias("spot"), *PLACE, "content"), "spot", _bits(wanted, "spot"))
    same = [F.col(f"t.{c}").eqNullSafe(F.col(f"w.{c}")) for c in PLACE]
    met = near.alias("t").join(wanted.alias("w"), [F.col("t.spot") == F.col("w.spot"), *same])
    # Rows with equal key and text give a line more than once.
    out = cut_lineage(met.select("w.order", "t.content").dropDuplicates(["order"]))
    drop_tables(wanted)
    return out


def _possible(t: float) -> Column:
    """Length and positional filter of a pair that shares a prefix word; never fails a similar pair."""
    x, y, i, j = F.col("size"), F.col("other_size"), F.col("place"), F.col("other_place")
    need = F.ceil((x + y) * F.lit(t / (1 + t)) - F.lit(1e-9))
    room = F.least(i, j) + 1 + F.least(x - i - 1, y - j - 1)
    return (F.least(x, y) >= F.greatest(x, y) * F.lit(t) - F.lit(1e-9)) & (room >= need)


def _close(t: float, *sketch: str) -> Column:
    """Whether a sketch, given by its parts, leaves a pair possible; never fails a similar pair, whose sets differ in few words."""
    x, y = F.col("size"), F.col("other_size")
    need = F.ceil((x + y) * F.lit(t / (1 + t)) - F.lit(1e-9))
    return _apart(*sketch) <= x + y - 2 * need


def _apart(*sketch: str) -> Column:
    return sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"other_{c}"))) for c in sketch), F.lit(0))


def _prefix_length(size: Column, t: float) -> Column:
    return F.least(size, size - F.ceil(size * F.lit(t) - F.lit(1e-9)) + F.lit(_shared(t)))


def _least_shared(t: float) -> Column:
    """Prefix words that a similar pair shares at least.

    Of the two prefixes one ends first in the order of words; the words of its line that
    it lacks are all that can be shared besides. Which one it is is not known here.
    """
    x, y = F.col("size"), F.col("other_size")
    need = F.ceil((x + y) * F.lit(t / (1 + t)) - F.lit(1e-9))
    return F.greatest(F.lit(_shared(t)), need - F.greatest(x - _prefix_length(x, t), y - _prefix_length(y, t))).cast("int")


def _pairs_of(prefix: str) -> Column:
    """Keys of every two words of a prefix, in their order."""
    two = F.transform(prefix, lambda w, i: F.transform(F.slice(prefix, i + 2, F.size(prefix)), lambda v: F.xxhash64(w, v)))
    return F.flatten(two)


@dataclass
class Index:
    """Rows (order, size, sketch..., key) of the keys that several entries have, the number of holders of each, and the pairs it is for."""

    held: DataFrame
    often: DataFrame
    #: Which pairs meet here, and how many keys they share at least.
    fits: Column
    least: Column

    def pairs(self, threshold: float, some: DataFrame, others: DataFrame) -> DataFrame:
        """``some`` with the earlier ones of ``others`` that have a key of theirs, a similar size and close sketches."""
        renamed = others.toDF(*(c if c == "key" else "other" if c == "order" else f"other_{c}" for c in others.columns))
        return some.join(renamed, "key").where(
            (F.col("other") < F.col("order"))
            & (F.least("size", "other_size") >= F.greatest("size", "other_size") * F.lit(threshold) - F.lit(1e-9))
            & _close(threshold, *SMALL)
            & (_close(threshold, *WIDE) if WIDE[0] in some.columns else F.lit(True))
            & self.fits
        )


def _indexes(entries: DataFrame, threshold: float) -> list[Index]:
    """Entries by the keys that similar ones share.

    Where a similar pair shares two words it shares a pair of words, of which few are in
    common use. The pairs of words of a prefix grow with its square, so lines of more than
    ``SHORT`` words meet by single words, and so does a shorter line with such a one.
    """
    least = _least_shared(threshold)
    short = SHORT if _shared(threshold) > 1 else 0
    longer = F.greatest("size", "other_size") > F.lit(short)

    def index(rows: DataFrame, fits: Column, least: Column) -> Index:
        often = cut_lineage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        return Index(cut_lineage(_tested(rows, "key", _bits(often, "key"))), often, fits, least)

    words = entries.where(F.col("size") >= F.lit(short * threshold - 1e-9)).select("order", "size", *SKETCHES, F.explode(F.col("prefix").cast("array<long>")).alias("key"))
    out = [index(words, longer, least)]
    if short:
        pairs = entries.where(F.col("size") <= F.lit(short)).select("order", "size", *SMALL, F.explode(_pairs_of("prefix")).alias("key"))
        out.append(index(pairs, ~longer, (least * (least - 1) / 2).cast("int")))
    return out


def _some_holders(index: Index, found: DataFrame, threshold: float) -> DataFrame:
    """Pairs (order, other) of an entry that is not in ``found`` and earlier ones among a few holders of its most frequent keys.

    Some ``FEW`` of the holders of each, drawn by hash, so there are no more pairs than keys
    times that number. In a group of similar lines most find a witness here, so the
    lines that then meet all earlier holders do not grow with the group.
    """
    hot = index.often.where(F.col("n") >= F.lit(HOT))
    held = _tested(index.held, "key", _bits(hot, "key"))
    drawn = held.join(hot, "key").where(F.pmod(F.xxhash64("order"), "n") < F.lit(FEW)).select(*index.held.columns)
    return index.pairs(threshold, held.join(found, "order", "left_anti"), drawn).select("order", "other").distinct()


def _holders(index: Index, found: DataFrame, threshold: float) -> DataFrame:
    """Pairs (order, other) of an entry that is not in ``found`` and every earlier one that shares enough keys."""
    met = index.pairs(threshold, index.held.join(found, "order", "left_anti"), index.held)
    met = met.groupBy("order", "other", index.least.alias("least")).agg(F.count(F.lit(1)).alias("n")).where("n >= least")
    return cut_lineage(met.select("order", "other"))


def _sets(pairs: DataFrame, entries: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (order, content) of the entries of pairs (order, other); only these texts are fetched."""
    wanted = pairs.select("order").unionByName(pairs.select(F.col("other").alias("order"))).distinct()
    return _texts(docs, entries.join(wanted, "order", "left_semi").select("order", "first.*"))


def _similar(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The ``order`` of pairs (order, other) whose similarity reaches the threshold."""
    both = pairs.join(sets, "order").join(sets.select(F.col("order").alias("other"), F.col("content").alias("other_content")), "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = []
            for a, b in zip(batch.column("content").cast(pa.binary()).to_pylist(), batch.column("other_content").cast(pa.binary()).to_pylist()):
                x, y = set(a.split()), set(b.split())
                shared = len(x & y)
                hit.append(shared >= threshold * (len(x) + len(y) - shared) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column("order").filter(pa.array(hit, pa.bool_()))], names=["order"])

    return cut_lineage(both.select("order", "content", "other_content").mapInArrow(run, "order long").distinct())


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """Rows (doc, version, line): lines to which an earlier line of the corpus is similar, judged on the input.

    Earlier is by key, then text hash, then line number from 0; ``version`` is the hash
    of the text. A null key is before all others. Lines are cut at ``\\n``; words are
    ``[^\\x20\\x09-\\x0D]+``, compared as they are. Lines without words are never
    removed. Rows with equal key and text count as one document. Null and empty texts
    and empty tables give no rows. Lines of any length are compared by all their words,
    a text of any number of lines is cut in one task. Identities of word sets are 64-bit hashes.
    """
    with short_lived_shuffles(docs.sparkSession):
        return _removed(docs, key, text, threshold)


def _removed(docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    spark = docs.sparkSession
    field = docs.select(key).schema[0].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    # A bounded number of counters.
    counts = spark.sparkContext.broadcast(frequencies(rows))
    kind = _arrow(docs.select(key).schema[0].dataType)
    shape = f"doc {field}, version long, line int, entry long, size int, prefix array<int>, sketch long, low_sketch long, high_sketch long"
    lines = cut_lineage(rows.mapInArrow(_cut(counts, threshold, kind), shape))
    grouped = lines.groupBy("entry").agg(
        F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n"), *(F.first(c).alias(c) for c in ("size", "prefix", *SKETCHES))
    )
    # Numbers that rise with the place: ranges of places are sorted, and row numbers rise over ranges.
    ranged = grouped.repartitionByRange("first").sortWithinPartitions("first")
    entries = cut_lineage(ranged.select(F.monotonically_increasing_id().alias("order"), "*"))

    # Most prefix words occur once; those cannot be shared and are not shuffled with their rows.
    exploded = entries.select("order", "size", F.posexplode("prefix").alias("place", "word")).withColumn("word", F.col("word").cast("long"))
    often = exploded.groupBy("word").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    held = _tested(exploded, "word", _bits(often, "word"))
    earliest = held.groupBy("word").agg(F.min(F.struct("order", "size", "place")).alias("pivot"), F.count(F.lit(1)).alias("m")).where("m > 1")
    earliest = earliest.select("word", F.col("pivot.order").alias("other"), F.col("pivot.size").alias("other_size"), F.col("pivot.place").alias("other_place"))
    shared = cut_lineage(held.join(earliest, "word"))

    # First the holder with which an entry shares most prefix words, if the whole prefixes share enough.
    met = shared.where((F.col("order") > F.col("other")) & _possible(threshold)).groupBy("order", "other").agg(F.count(F.lit(1)).alias("m"))
    pivots = met.groupBy("order").agg(F.max_by("other", F.struct("m", "other")).alias("other"))
    own = entries.select("order", "size", "prefix", *SKETCHES)
    both = pivots.join(own, "order").join(own.toDF("other", *(f"other_{c}" for c in own.columns[1:])), "other")
    in_both = F.size(F.filter("prefix", lambda w: F.array_contains("other_prefix", w)))
    near = _close(threshold, *SMALL) & _close(threshold, *WIDE)
    pivots = cut_lineage(both.where(near & (in_both >= _least_shared(threshold))).select("order", "other"))
    sets = _sets(pivots, entries, rows)
    found = _similar(pivots, sets, threshold)
    drop_tables(shared, sets)
    # Then a few holders of the keys that many entries have.
    indexes = _indexes(entries, threshold)
    some = cut_lineage(functools.reduce(DataFrame.unionByName, (_some_holders(x, found, threshold) for x in indexes)))
    sets = _sets(some, entries, rows)
    found = found.unionByName(_similar(some, sets, threshold))
    drop_tables(sets)
    # Then, for those that are left, every earlier holder: the one with the closest sketches, then the others.
    rest = functools.reduce(DataFrame.unionByName, [_holders(x, found, threshold) for x in indexes])
    drop_tables(*(table for x in indexes for table in (x.held, x.often)))
    rest = rest.join(pivots, ["order", "other"], "left_anti").join(some, ["order", "other"], "left_anti")
    own = entries.select("order", "size", *SKETCHES)
    both = rest.join(own, "order").join(own.toDF("other", *(f"other_{c}" for c in own.columns[1:])), "other")
    rest = cut_lineage(both.where(_close(threshold, *SMALL) & _close(threshold, *WIDE)).select("order", "other", _apart(*WIDE).alias("apart")))
    sets = _sets(rest, entries, rows)
    nearest = rest.groupBy("order").agg(F.min_by("other", F.struct("apart", "other")).alias("other"))
    late = _similar(nearest, sets, threshold)
    last = _similar(rest.join(late, "order", "left_anti").join(nearest, ["order", "other"], "left_anti").select("order", "other"), sets, threshold)
    drop_tables(sets)

    gone = found.unionByName(late).unionByName(last).select("order", F.lit(True).alias("gone"))
    judged = entries.select("order", "entry", "first", "n").join(gone, "order", "left").where((F.col("n") > 1) | F.col("gone"))
    out = lines.select(*PLACE, "entry").join(judged, "entry").where(F.col("gone").isNotNull() | (F.struct(*PLACE) != F.col("first")))
    result = cut_lineage(out.select(*PLACE).distinct())
    drop_tables(lines, entries, pivots, found, some, rest, late, last)
    return result


def _arrow(field) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field)


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with the lines of ``removed_lines`` taken out of its text, plus ``removed_lines``, their number.

    The other columns are unchanged, but an input column ``removed_lines`` is replaced.
    Every row stays, with an empty text if nothing is left; a null text stays null.
    """
    gone = removed_lines(docs, key, text, threshold).groupBy("doc", "version").agg(F.collect_set("line").alias("lines"))
    rows = docs.drop("removed_lines")
    met = rows.withColumns({"__key": F.col(key), "__version": F.xxhash64(text)}).join(
        gone.select(F.col("doc").alias("__doc"), F.col("version").alias("__of"), F.col("lines").alias("__lines")),
        F.col("__key").eqNullSafe(F.col("__doc")) & (F.col("__version") == F.col("__of")),
        "left",
    )
    kept = F.array_join(F.filter(F.split(text, "\n"), lambda x, i: ~F.array_contains("__lines", i)), "\n")
    left = F.when(F.col("__lines").isNull(), F.col(text)).otherwise(kept).alias(text)
    return met.select(*(left if c == text else rows[c] for c in rows.columns), F.coalesce(F.size("__lines"), F.lit(0)).alias("removed_lines"))
