"""Token ids as length-delimited binary records with an offset index.

A record is framed as: length (8 bytes, little-endian), masked CRC-32C of the length
(4), data, masked CRC-32C of the data (4); this is the framing that common record
readers know. The data is one flag byte (1: a key follows, 2: ids have four bytes
instead of two), the key (8 bytes) if there is one, and the ids. Each file has an
index file beside it with the offset of every record, its end as last entry, so that
a reader can take records in any order.
"""

from __future__ import annotations

import os
import random
import re
import struct
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tidemill.llm.files import Written, committed, open_folder, remove, write_manifest

SCHEMA = "key long, start long, n_tokens long, ids binary"
#: A task starts a new file beyond this many bytes, so that reads have partitions of bounded size.
FILE_BYTES = 16 << 20
BATCH_BYTES = 4 << 20
#: Words that a task remembers; beyond it the memory is emptied and a word may be encoded again.
REMEMBERED = 250_000

# The reversed CRC-32C polynomial, and the constant of the masked form.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

STRIDE = 1024


class Crc32c:
    """CRC-32C in numpy: tables give a byte's part by its distance from the end of a block."""

    def __init__(self) -> None:
        one = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1).astype(np.uint32)
        rows = [one]
        for _ in range(STRIDE - 1):
            rows.append(one[rows[-1] & 0xFF] ^ (rows[-1] >> 8))
        #: Row d: the effect of a byte with d bytes after it.
        self.by_distance = np.stack(rows)
        self.table = np.ascontiguousarray(self.by_distance[::-1]).ravel()
        self.at = np.arange(STRIDE, dtype=np.int64) * 256
        self.carry = [row.tolist() for row in self.by_distance[STRIDE - 4 :][::-1]]

    def __call__(self, data: bytes) -> int:
        a = np.frombuffer(data, np.uint8)
        if len(a) < 4:  # the register's start value reaches beyond the data
            crc, first = 0xFFFFFFFF, self.by_distance[0]
            for byte in data:
                crc = int(first[(crc ^ byte) & 0xFF]) ^ (crc >> 8)
            return crc ^ 0xFFFFFFFF
        # The start value is the same as inverting the first four bytes; zeros in front change nothing.
        padded = np.zeros(-(-len(a) // STRIDE) * STRIDE, np.uint8)
        at = len(padded) - len(a)
        padded[at:] = a
        padded[at : at + 4] ^= 0xFF
        crc = 0
        for start in range(0, len(padded), STRIDE << 10):  # bounds the table look-ups held at once
            blocks = padded[start : start + (STRIDE << 10)].reshape(-1, STRIDE).astype(np.int64)
            for part in np.bitwise_xor.reduce(self.table[blocks + self.at], axis=1).tolist():
                a0, a1, a2, a3 = self.carry
                crc = a0[crc & 0xFF] ^ a1[crc >> 8 & 0xFF] ^ a2[crc >> 16 & 0xFF] ^ a3[crc >> 24] ^ part
        return crc ^ 0xFFFFFFFF

    def masked(self, data: bytes) -> int:
        crc = self(data)
        return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(data: bytes, crc: Crc32c) -> bytes:
    length = struct.pack("<Q", len(data))
    return length + struct.pack("<I", crc.masked(length)) + data + struct.pack("<I", crc.masked(data))


def serialize(key: int | None, ids: np.ndarray) -> bytes:
    wide = len(ids) > 0 and int(ids.max()) > 0xFFFF
    head = bytes([(key is not None) | wide << 1])
    return head + (b"" if key is None else struct.pack("<q", key)) + ids.astype("<u4" if wide else "<u2").tobytes()


def deserialize(data: bytes) -> tuple[int | None, np.ndarray]:
    at = 9 if data[0] & 1 else 1
    key = struct.unpack_from("<q", data, 1)[0] if data[0] & 1 else None
    return key, np.frombuffer(data, "<u4" if data[0] & 2 else "<u2", offset=at).astype("<u4")


class RecordWriter(DataSourceArrowWriter):
    """Rows (key, ids) of a task, in their order, to files numbered by task and place."""

    def __init__(self, uri: str, overwrite: bool):
        self.uri, self.overwrite = uri, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = open_folder(self.uri)
        system.create_dir(folder, recursive=True)
        crc, files, out, offsets = Crc32c(), [], None, []

        def close() -> None:
            out.close()
            index = np.array(offsets, "<i8").tobytes()
            with system.open_output_stream(f"{folder}/{files[-1]['name'][:-4]}.idx", compression=None) as f:
                f.write(index + struct.pack("<I", crc.masked(index)))

        for batch in iterator:
            for key, ids in zip(batch.column("key"), batch.column("ids")):
                if out is None:
                    task = TaskContext.get().partitionId()
                    files.append({"name": f"part-{task:06d}-{len(files):06d}-{uuid.uuid4().hex}.rec", "task": task, "place": len(files), "tokens": 0})
                    out, offsets = system.open_output_stream(f"{folder}/{files[-1]['name']}", compression=None), [0]
                found = np.frombuffer(ids.as_py() or b"", "<u4")
                record = frame(serialize(key.as_py(), found), crc)
                out.write(record)
                offsets.append(offsets[-1] + len(record))
                files[-1]["tokens"] += len(found)
                if offsets[-1] >= FILE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        return Written(files)

    def commit(self, messages: list) -> None:
        """Files in the order of tasks; each learns how many ids come before it."""
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: (f["task"], f["place"]))
        start = 0
        for f in files:
            f["start"] = start
            start += f["tokens"]
        write_manifest(self.uri, files, self.overwrite)

    def abort(self, messages: list) -> None:
        files = [f for m in messages if m for f in m.files]
        remove(self.uri, files + [{"name": f["name"][:-4] + ".idx"} for f in files])


@dataclass
class RecordFile(InputPartition):
    name: str
    start: int


class RecordReader(DataSourceReader):
    def __init__(self, options: dict):
        self.uri = options["path"]
        self.seed = int(options["shuffle"]) if options.get("shuffle") else None

    def partitions(self) -> list:
        """One per file; with a seed in a random order."""
        found = [RecordFile(f["name"], f["start"]) for f in committed(self.uri)] or [RecordFile("", 0)]
        if self.seed is not None:
            random.Random(self.seed).shuffle(found)
        return found

    def read(self, partition: RecordFile) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        schema = pa.schema([("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        system, folder = open_folder(self.uri)
        crc = Crc32c()
        with system.open_input_stream(f"{folder}/{partition.name[:-4]}.idx", compression=None) as f:
            data = f.read()
        if struct.unpack("<I", data[-4:])[0] != crc.masked(data[:-4]):
            raise ValueError(f"index of {partition.name} is damaged")
        offsets = np.frombuffer(data[:-4], "<i8").tolist()
        rows, size = [], 0
        with system.open_input_stream(f"{folder}/{partition.name}", compression=None) as f:
            held = f.read()  # a file is no larger than FILE_BYTES and one record
        order = list(range(len(offsets) - 1))
        starts = self._starts(held, offsets, partition.start)
        if self.seed is not None:
            random.Random(f"{self.seed} {partition.name}").shuffle(order)
        for i in order:
            key, ids = deserialize(self._data(held[offsets[i] : offsets[i + 1]], crc, partition.name))
            rows.append((key, starts[i], len(ids), ids.tobytes()))
            size += 4 * len(ids) + 50
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    @staticmethod
    def _starts(held: bytes, offsets: list[int], start: int) -> list[int]:
        """Ids before each record, from the record lengths and flag bytes alone."""
        starts = []
        for at, end in zip(offsets, offsets[1:]):
            starts.append(start)
            flags = held[at + 12]
            start += (end - at - 17 - 8 * (flags & 1)) // (4 if flags & 2 else 2)
        return starts

    @staticmethod
    def _data(record: bytes, crc: Crc32c, name: str) -> bytes:
        length, check = struct.unpack_from("<QI", record)
        data = record[12:-4]
        if crc.masked(record[:8]) != check or length != len(data) or crc.masked(data) != struct.unpack("<I", record[-4:])[0]:
            raise ValueError(f"a record of {name} is damaged")
        return data


class RecordSource(DataSource):
    """``format("token_records")``; options path and, for reads, shuffle (a seed)."""

    @classmethod
    def name(cls) -> str:
        return "token_records"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> RecordReader:
        return RecordReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options["path"], overwrite)


# The characters that the tokenizer's pattern takes for white space.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


# After a run of letters and digits, and before white space, the pattern always ends a
# token, so these pieces have the ids they have inside the whole text. An underscore is
# a sign to the pattern but a letter to this module: such texts are cut at white space only.
# The first branch is the common case of the second.
PIECES = re.compile(f" ?\\w+|[{WHITE}]*[^\\w{WHITE}]*\\w+|[{WHITE}]*[^\\w{WHITE}]+|[{WHITE}]+")
CHUNKS = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
LETTERS = re.compile(r" ?[^\W\d_]+")


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte: itself where it is visible, else one from 256 on."""
    visible = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 256 and b != 173]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Known(dict):
    """Pieces of text to the bytes of their ids. Not part of a reference cycle, so it goes with its task."""

    def __init__(self, tokenizer) -> None:
        super().__init__()
        self.tokenizer, self.tokenize, self.alphabet = tokenizer, tokenizer.model.tokenize, byte_alphabet()
        self.space = self.alphabet[ord(" ")]
        self.packed = [struct.Struct(f"<{n}I").pack for n in range(64)]

    def __missing__(self, piece: str) -> bytes:
        bare = piece[1:] if piece[0] == " " else piece
        if bare.isascii() and bare.isalpha():  # one token of the pattern: straight to the merges
            ids = [t.id for t in self.tokenize(bare if bare is piece else self.space + bare)]
        elif LETTERS.fullmatch(piece):
            ids = [t.id for t in self.tokenize(piece.encode().decode("latin-1").translate(self.alphabet))]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        self[piece] = found = self.packed[len(ids)](*ids) if len(ids) < len(self.packed) else struct.pack(f"<{len(ids)}I", *ids)
        return found


def _tokenizer(path: str, end_id: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
        known, end = Known(tokenizer), struct.pack("<I", end_id)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                ids = []
                for text in part.column(1).to_pylist():
                    if text and any(token in text for token in added):  # pieces could cut the token apart
                        own = tokenizer.encode(text, add_special_tokens=False).ids
                        ids.append(struct.pack(f"<{len(own)}I", *own) + end)
                        continue
                    pieces = (CHUNKS if "_" in (text or "") else PIECES).findall(text or "")
                    ids.append(b"".join(map(known.__getitem__, pieces)) + end)
                    if len(known) >= REMEMBERED:
                        known.clear()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["key", "ids"])

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encodes each whole text, appends ``end_id`` and writes the records in ascending order of key.

    The tokenizer is a byte-level BPE file of the tokenizers library, and the ids are its
    own without added special tokens: a special token written in a text is one id. A null or empty
    text is a record of the end id alone. Null keys come first and stay null; rows with
    equal keys are in the order of their text's hash, so a key that holds many rows
    still spreads over tasks. A long text is cut into words as it is read, and its ids are
    one record. An empty table gives no file. Other columns are not read.
    """
    spark = docs.sparkSession
    spark.dataSource.register(RecordSource)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
    ordered = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")
    encoded = ordered.mapInArrow(_tokenizer(tokenizer_path, end_id), "key long, ids binary")
    encoded.write.format("token_records").mode("append").option("path", folder).save()


def read_tokens(spark: SparkSession, folder: str, shuffle: int | None = None) -> DataFrame:
    """Rows (key, start, n_tokens, ids); ``start`` is the number of ids in all records before it.

    Every checksum is verified. With ``shuffle`` files and the records inside each come
    in an order drawn from that seed.
    """
    spark.dataSource.register(RecordSource)
    reader = spark.read.format("token_records").option("path", folder)
    return (reader if shuffle is None else reader.option("shuffle", str(shuffle))).load()
