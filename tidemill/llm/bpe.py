"""Byte-level BPE over a shuffle of distinct words.

Texts are cut into pre-tokens. The rows of a scan task form blocks of some megabytes;
a block's pre-tokens are its list of distinct words and, per document, the position of
each word in that list. The words go to the partition of their hash, where each
distinct word is encoded once, and their ids come back to the block, where documents
are put together by position. Words and positions are made by two passes over the
texts, so that positions are shuffled once and words twice; a block carries a digest of
its word list, and the two parts meet only if they come from the same rows.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

#: Bytes of text in a block, beyond its last document.
BLOCK_BYTES = 8 << 20
#: Words that a task remembers; beyond it the memory is emptied and a word may be encoded again.
REMEMBERED = 300_000


NAMES = ["block", "digest", "bucket", "ids", "payload"]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _pack(*parts: np.ndarray | bytes) -> bytes:
    data = [p if isinstance(p, bytes) else p.tobytes() for p in parts]
    head = np.array([len(parts), *map(len, data)], dtype=np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(data))


def _unpack(blob: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, n, 8)
    ends = 8 * (n + 1) + np.cumsum(sizes)
    return [data[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist())]


def _places(numbers: np.ndarray) -> tuple[bytes, bytes]:
    """Positions in order of appearance: the frequent ones are small and take one byte, the others three."""
    small = numbers < 255
    wide = numbers[~small].astype("<u4").view(np.uint8).reshape(-1, 4)
    return np.where(small, numbers, 255).astype(np.uint8).tobytes(), np.ascontiguousarray(wide.T).tobytes()


def _placed(first: bytes, wide: bytes) -> np.ndarray:
    out = np.frombuffer(first, np.uint8).astype(np.uint32)
    out[out == 255] = _numbers(wide)
    return out


def _planes(numbers: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which compresses better."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _splitter(pattern: str, buckets: int, kind: pa.DataType | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (block, digest, bucket, ids, payload) of each block: its documents if ``kind`` is given, else its words by bucket."""
    types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(kind or pa.int64()), pa.binary()]

    def block_rows(block: int, ids: list, counts: list[int], places: list[np.ndarray], words: dict[str, int]) -> pa.RecordBatch:
        encoded = [w.encode() for w in words]
        digest = int(np.array([xxhash.xxh3_64_intdigest(b"\0".join(encoded))], np.uint64).view(np.int64)[0])
        if kind is not None:
            rows = [(block, digest, None, ids, _pack(np.array(counts, np.int64), *_places(np.concatenate(places))))]
        else:
            by_bucket: dict[int, list] = {}
            for place, data in enumerate(encoded):
                by_bucket.setdefault(zlib.crc32(data) % buckets, []).append((place, data))
            rows = []
            for bucket, entries in by_bucket.items():
                at = np.array([p for p, _ in entries], np.uint32)
                sizes = np.array([len(d) for _, d in entries], np.uint32)
                steps = np.diff(at, prepend=np.uint32(0))
                rows.append((block, digest, bucket, None, _pack(_planes(steps), _planes(sizes), b"".join(d for _, d in entries))))
        columns = zip(*rows) if rows else [[]] * len(NAMES)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        block = TaskContext.get().partitionId() << 32
        ids, counts, places, words, size = [], [], [], {}, 0
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for i, key in enumerate(keys):
                text = batch.column(1)[i].as_py() or ""
                found = [words.setdefault(w, len(words)) for w in find(text)]
                if kind is not None:
                    ids.append(key)
                    counts.append(len(found))
                    places.append(np.array(found, np.uint32))
                size += len(text)
                if size >= BLOCK_BYTES:
                    yield block_rows(block, ids, counts, places, words)
                    block += 1
                    ids, counts, places, words, size = [], [], [], {}, 0
        if ids or words:
            yield block_rows(block, ids, counts, places, words)

    return run


def _encoder(pattern: str, ranks_path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Ids in place of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = None
        known: dict[bytes, bytes] = {}
        for batch in batches:
            payload = []
            for blob in batch.column("payload"):
                if encoding is None:
                    encoding = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=read_ranks(ranks_path), special_tokens={})
                at, sizes, data = _unpack(blob.as_py())
                tokens, start = [], 0
                for end in np.cumsum(_numbers(sizes)).tolist():
                    word = data[start:end]
                    start = end
                    found = known.get(word)
                    if found is None:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        found = known[word] = np.array(encoding.encode_ordinary(word.decode()), "<u4").tobytes()
                    tokens.append(found)
                counts = np.array([len(t) // 4 for t in tokens], np.uint32)
                payload.append(_pack(at, _planes(counts), _planes(np.frombuffer(b"".join(tokens), "<u4"))))
            yield batch.set_column(batch.schema.get_field_index("payload"), "payload", pa.array(payload, pa.binary()))

    return run


def _assembler(kind: pa.DataType) -> Callable[[pa.Table], pa.Table]:
    def run(block: pa.Table) -> pa.Table:
        docs = block.filter(pa.compute.is_valid(block["ids"]))
        words = block.filter(pa.compute.is_null(block["ids"]))
        at, counts, tokens = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
        for blob in words["payload"]:
            steps, *rest = map(_numbers, _unpack(blob.as_py()))
            for into, part in zip((at, counts, tokens), (np.cumsum(steps, dtype=np.uint32), *rest)):
                into.append(part)
        at, count, token = map(np.concatenate, (at, counts, tokens))
        begin = np.cumsum(count, dtype=np.int64) - count
        n = np.zeros(len(at), np.int64)
        first = np.zeros(len(at), np.int64)
        n[at], first[at] = count, begin
        ids, n_tokens, found = [], [], []
        for keys, blob in zip(docs["ids"], docs["payload"]):
            sizes, first_bytes, wide = _unpack(blob.as_py())
            places, start = _placed(first_bytes, wide), 0
            if len(places) and int(places.max()) >= len(at):
                raise ValueError("the input gave other rows when it was read again; write it down first")
            for key, size in zip(keys, np.frombuffer(sizes, np.int64).tolist()):
                own = places[start : start + size]
                start += size
                lengths = n[own]
                before = np.cumsum(lengths) - lengths
                index = np.repeat(first[own] - before, lengths) + np.arange(int(lengths.sum()))
                ids.append(key.as_py())
                n_tokens.append(len(index))
                found.append(token[index].astype("<u4").tobytes())
        return pa.table({"id": pa.array(ids, kind), "n_tokens": pa.array(n_tokens, pa.int64()), "ids": pa.array(found, pa.binary())})

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, n_tokens, ids): the ids of each whole text as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded for itself by the ranks of ``ranks_path`` (a
    public ``.tiktoken`` file every executor has); there are no special tokens. A null
    or empty text has no ids. There is one row per row of ``docs``: repeated rows
    and null ids stay, an empty table gives an empty table, other columns are not read.
    Text between matches, of which the usual patterns leave none, is dropped. ``docs``
    must give the same rows in the same order when read again, as files do.
    """
    field = docs.select(key).schema[0].dataType
    kind = pa.array([], from_spark(field)).type
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    shape = f"block long, digest long, bucket int, ids array<{field.simpleString()}>, payload binary"
    plain = "block long, digest long, bucket int, ids array<long>, payload binary"
    words = rows.select(F.lit(None).cast("long").alias("id"), "text").mapInArrow(_splitter(pattern, buckets, None), plain)
    encoded = words.repartition(buckets, "bucket").mapInArrow(_encoder(pattern, ranks_path), plain)
    placed = rows.mapInArrow(_splitter(pattern, buckets, kind), shape)
    parts = placed.unionByName(encoded.withColumn("ids", F.lit(None).cast(f"array<{field.simpleString()}>")))
    return parts.groupBy("block", "digest").applyInArrow(_assembler(kind), f"id {field.simpleString()}, n_tokens long, ids binary")


def from_spark(field):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field)


def decode(tokens: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """``tokens`` plus a binary column ``decoded``, which replaces one of that name.

    Every id is joined with the table of token bytes and the bytes are put together by
    position. The table has one row per token of the vocabulary, so its size is known and
    it is broadcast; the join needs no shuffle. Null ids decode to null, no ids to no
    bytes; an id outside the vocabulary fails the task.
    """
    spark = tokens.sparkSession
    ranks = read_ranks(ranks_path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for piece, rank in ranks.items():
        table[rank] = piece
    shared = spark.sparkContext.broadcast(table)
    kept = tokens.drop("decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = shared.value.__getitem__
        for batch in batches:
            for start in range(0, batch.num_rows, 256):  # bounds what is built at once
                part = batch.slice(start, 256)
                out = [None if b is None else b"".join(map(piece, np.frombuffer(b, "<u4").tolist())) for b in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], names=[*part.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(run, f"{fields}, decoded binary")
