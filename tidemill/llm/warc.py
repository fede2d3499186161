"""WARC archives as a Python data source, and payload deduplication into revisit records.

Each record is a gzip member of its own. Its extra field holds the member's length (the
subfield ``sl``), so a reader can step over what it does not want. The reader inflates
a record's first bytes until the headers end, applies the pushed filters to them, and
inflates a payload only if the record is wanted and payloads are asked for.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull
from pyspark.sql.types import StructType

from tidemill.llm.files import Written, committed, open_folder, remove, write_manifest

SCHEMA = "record_id string, record_type string, target_uri string, payload_digest string, refers_to string, payload_bytes long, payload binary"
#: A task starts a new archive file beyond this many bytes, so that reads have partitions of bounded size.
FILE_BYTES = 64 << 20
#: Bytes handed to Spark in one Arrow batch, beyond its last record.
BATCH_BYTES = 4 << 20
DATE = "2000-01-01T00:00:00Z"
LEVEL = 3


def b32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(data: bytes) -> bytes:
    """One gzip member whose header names its own length."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, total, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _one_line(value: str) -> str:
    """A header value cannot hold line breaks; they are percent-encoded."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _record(row: dict) -> bytes:
    payload = row["payload"] or b""
    kind = row["record_type"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}"]
    if row["record_id"] is not None:
        head.append(f"WARC-Record-ID: <{_one_line(row['record_id'])}>")
    if row["target_uri"] is not None:
        head.append(f"WARC-Target-URI: {_one_line(row['target_uri'])}")
    head.append(f"WARC-Payload-Digest: sha1:{b32_sha1(payload)}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if row["refers_to"] is not None:
            head.append(f"WARC-Refers-To: <{_one_line(row['refers_to'])}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, uri: str, overwrite: bool):
        self.uri, self.overwrite = uri, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, folder = open_folder(self.uri)
        system.create_dir(folder, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in ("record_id", "record_type", "target_uri", "refers_to", "payload")}
                if out is None:
                    files.append({"name": f"part-{uuid.uuid4().hex}.warc.gz"})
                    out, size = system.open_output_stream(f"{folder}/{files[-1]['name']}", compression=None), 0
                member = _member(_record(row))
                out.write(member)
                size += len(member)
                if size >= FILE_BYTES:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        write_manifest(self.uri, [f for m in messages if m for f in m.files], self.overwrite)

    def abort(self, messages: list) -> None:
        remove(self.uri, [f for m in messages if m for f in m.files])


@dataclass
class WarcFile(InputPartition):
    name: str


class WarcReader(DataSourceReader):
    #: Columns that the headers alone decide.
    HEADERS = ("record_id", "record_type", "target_uri", "payload_digest", "refers_to")

    def __init__(self, options: dict):
        self.uri = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.verify = options.get("verify", "false").lower() == "true"
        self.wanted: list = []

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in self.HEADERS and isinstance(f, (EqualTo, In, IsNotNull)):
                self.wanted.append((name, None if isinstance(f, IsNotNull) else list(f.value) if isinstance(f, In) else [f.value]))
            else:
                yield f

    def partitions(self) -> list:
        """One per archive file; files are cut at a fixed size when written."""
        return [WarcFile(f["name"]) for f in committed(self.uri)] or [WarcFile("")]

    def _accepts(self, row: dict) -> bool:
        return all(row[n] is not None and (values is None or row[n] in values) for n, values in self.wanted)

    def read(self, partition: WarcFile) -> Iterator[pa.RecordBatch]:
        names = (*self.HEADERS, "payload_bytes", "payload")
        schema = pa.schema([(n, pa.string()) for n in self.HEADERS] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])
        rows, size = [], 0
        if partition.name:
            system, folder = open_folder(self.uri)
            with system.open_input_file(f"{folder}/{partition.name}") as f:
                for row in self._records(f):
                    rows.append(row)
                    size += len(row["payload"] or b"") + 500
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], schema=schema)

    def _records(self, f) -> Iterator[dict]:
        at, end = 0, f.size()
        while at < end:
            f.seek(at)
            head = f.read(2048)
            if head[:4] != b"\x1f\x8b\x08\x04" or head[12:14] != b"sl":
                raise ValueError(f"no record with a known length at byte {at}")
            length = struct.unpack_from("<I", head, 16)[0]
            if at + length > end:
                raise ValueError(f"the archive ends inside the record at byte {at}")
            body = head[24:length]
            inflate = zlib.decompressobj(-15)
            text = inflate.decompress(body, 4096)
            read = min(len(head), length)
            # The block of a record starts after the first empty line, its payload after the second.
            while text.count(b"\r\n\r\n", 0, 1 << 20) < 2 and not inflate.eof:
                more = inflate.unconsumed_tail
                if not more:
                    more = f.read(min(1 << 16, length - read))
                    read += len(more)
                    if not more:
                        raise ValueError(f"the record at byte {at} has no end of its headers")
                text += inflate.decompress(more, 1 << 16)
            at += length
            row, http_at = self._headers(text)
            if row is None or not self._accepts(row):
                continue
            row["payload"] = None
            stored = row["record_type"] == "response"
            if stored and (self.payload or self.verify):
                parts = [text, inflate.decompress(inflate.unconsumed_tail)]
                if read < length:
                    parts.append(inflate.decompress(f.read(length - read)))
                data = b"".join(parts)
                payload = data[http_at : http_at + row["payload_bytes"]]
                if self.verify and (len(payload) != row["payload_bytes"] or b32_sha1(payload) != row["payload_digest"]):
                    raise ValueError(f"payload of {row['record_id']} does not have its digest")
                row["payload"] = payload if self.payload else None
            yield row

    @staticmethod
    def _headers(text: bytes) -> tuple[dict | None, int]:
        first = text.index(b"\r\n\r\n")
        head = dict(line.split(": ", 1) for line in text[:first].decode().split("\r\n")[1:])
        if head["WARC-Type"] not in ("response", "revisit"):
            return None, 0
        second = text.index(b"\r\n\r\n", first + 4)
        http = dict(line.split(": ", 1) for line in text[first + 4 : second].decode().split("\r\n")[1:])

        def name(key: str) -> str | None:
            return head[key][1:-1] if key in head else None

        return {
            "record_id": name("WARC-Record-ID"),
            "record_type": head["WARC-Type"],
            "target_uri": head.get("WARC-Target-URI"),
            "payload_digest": head["WARC-Payload-Digest"].removeprefix("sha1:"),
            "refers_to": name("WARC-Refers-To"),
            "payload_bytes": int(http["Content-Length"]),
        }, second + 4


class WarcSource(DataSource):
    """``format("warc")``; options path, payload (default true) and verify (default false)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def revisits(pages: DataFrame, key: str = "page_id", payload: str = "payload", min_bytes: int = 0) -> DataFrame:
    """``pages`` plus record_type and refers_to.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the largest
    key is the response and the others revisit it; smaller ones are all responses. Rows
    that tie for the largest key are all responses, as is every row when no key is
    known; other rows without a key are revisits. Only digests are grouped, combined
    before the shuffle, and only digests that repeat are joined back.
    """
    marked = pages.withColumn("__digest", F.sha1(payload)).withColumn("__bytes", F.octet_length(payload))
    repeated = (
        marked.where(F.col("__bytes") >= min_bytes)
        .groupBy("__digest", "__bytes")
        .agg(F.max(key).alias("__response"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1 and __response is not null")
        .drop("__n")
    )
    joined = marked.join(repeated, ["__digest", "__bytes"], "left")
    again = F.col("__response").isNotNull() & ~F.col(key).eqNullSafe(F.col("__response"))
    return joined.select(
        *(pages[c] for c in pages.columns),
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("__response")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> None:
    """A record per row of ``pages``; the payload is the text in UTF-8, empty for null.

    Null urls and keys leave their header out. Repeated rows give a record each, texts
    of any length one record, an empty table no file. Other columns are not written.
    """
    spark = pages.sparkSession
    spark.dataSource.register(WarcSource)
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("target_uri"), F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    records = revisits(rows, min_bytes=min_bytes).select(
        urn(F.col("page_id")).alias("record_id"), "record_type", "target_uri", urn(F.col("refers_to")).alias("refers_to"), "payload"
    )
    records.write.format("warc").mode("append").option("path", folder).save()


def read_archives(spark: SparkSession, folder: str, payload: bool = True, verify: bool = False) -> DataFrame:
    """Records of the archives. Filters on header columns reach the reader and decide before a payload is inflated."""
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("warc").option("path", folder).option("payload", str(payload)).option("verify", str(verify)).load()


URN = "urn:page:"


def urn(key):
    return F.concat(F.lit(URN), key.cast("string"))


def key_of(record_id: str, kind: str = "long"):
    return F.substring(record_id, len(URN) + 1, 1 << 20).cast(kind)
