"""A folder of named tables as a Spark data source, called the way a warehouse connector is.

``spark.read.format("tidemill_store").option("folder", uri).option("dbtable", name)`` and
the same for writes, with mode ``append`` or ``overwrite``. A table is a set of Parquet
files that its newest manifest names. Tasks write files under names of their own; the
commit writes the next manifest under a number that must be free, so a table changes at
once or not at all, and of two writers one fails. Manifests hold the least and greatest
value of each column of a file: pushed comparisons skip files by them and are applied to
the rows of the others. Small files share a partition. Spark pushes filters to Python data
sources only with ``spark.sql.python.filterPushdown.enabled``; it then keeps the filters of
a loaded frame's last scan, so load the table anew for each query.

The module travels to the workers by value; they need pyarrow, but no copy of this package.
"""

from __future__ import annotations

import datetime
import decimal
import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "tidemill_store"
#: A partition reads files up to this many bytes together; a larger file is a partition of its own.
PACK_BYTES = 64 << 20
#: Comparisons that files can be skipped by: test(least, greatest, value) is true if a row may fit.
RANGES = {
    EqualTo: lambda low, high, v: low <= v <= high,
    GreaterThan: lambda low, high, v: high > v,
    GreaterThanOrEqual: lambda low, high, v: high >= v,
    LessThan: lambda low, high, v: low < v,
    LessThanOrEqual: lambda low, high, v: low <= v,
    In: lambda low, high, v: any(low <= x <= high for x in v),
}
TESTS = {EqualTo: "__eq__", GreaterThan: "__gt__", GreaterThanOrEqual: "__ge__", LessThan: "__lt__", LessThanOrEqual: "__le__"}


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """Hadoop's names of object stores are the same stores under the names that Arrow knows."""
    for hadoop, arrow in (("s3a://", "s3://"), ("s3n://", "s3://")):
        uri = arrow + uri.removeprefix(hadoop) if uri.startswith(hadoop) else uri
    return fs.FileSystem.from_uri(uri)


def _versions(uri: str) -> tuple[fs.FileSystem, str, list[int]]:
    system, folder = _open(uri)
    found = system.get_file_info(fs.FileSelector(f"{folder}/_versions", allow_not_found=True))
    return system, folder, sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json"))


def manifest(uri: str) -> dict:
    """The newest manifest of the table at ``uri``."""
    system, folder, known = _versions(uri)
    if not known:
        return {"version": 0, "schema": None, "files": []}
    with system.open_input_stream(f"{folder}/_versions/{known[-1]:010d}.json") as f:
        return json.loads(f.read())


def _plain(value):
    """A bound as JSON; None for types that are not compared."""
    if isinstance(value, (datetime.datetime, datetime.date)):
        return {"t": value.isoformat()}
    if isinstance(value, decimal.Decimal):
        return {"d": str(value)}
    return value if isinstance(value, (int, float, str)) else None


def _value(held):
    if isinstance(held, dict):
        if "d" in held:
            return decimal.Decimal(held["d"])
        return datetime.datetime.fromisoformat(held["t"]) if "T" in held["t"] else datetime.date.fromisoformat(held["t"])
    return held


@dataclass
class Files(WriterCommitMessage):
    files: list


@dataclass
class Pack(InputPartition):
    names: list


class StoreWriter(DataSourceArrowWriter):
    def __init__(self, uri: str, schema: StructType, overwrite: bool) -> None:
        self.uri, self.schema, self.overwrite = uri, schema, overwrite
        self.base = manifest(uri)["version"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        system, folder = _open(self.uri)
        system.create_dir(folder, recursive=True)
        name, out, rows, bounds = f"part-{uuid.uuid4().hex}.parquet", None, 0, {}
        for batch in iterator:
            out = out or pq.ParquetWriter(system.open_output_stream(f"{folder}/{name}"), batch.schema)
            out.write_batch(batch)
            rows += batch.num_rows
            for field, column in zip(batch.schema, batch.columns):
                if pa.types.is_nested(field.type) or pa.types.is_binary(field.type) or pa.types.is_boolean(field.type):
                    continue
                least, greatest = (x.as_py() for x in pc.min_max(column).values())
                if least is not None:
                    a, b = bounds.get(field.name, (least, greatest))
                    bounds[field.name] = (min(a, least), max(b, greatest))
        if out is None:
            return Files([])
        out.close()
        size = system.get_file_info(f"{folder}/{name}").size
        return Files([{"name": name, "rows": rows, "bytes": size, "bounds": {c: [_plain(a), _plain(b)] for c, (a, b) in bounds.items()}}])

    def commit(self, messages: list) -> None:
        system, folder = _open(self.uri)
        before = manifest(self.uri)
        if before["version"] != self.base:
            raise RuntimeError(f"another writer changed {self.uri}")
        fresh = [f for m in messages if m for f in m.files]
        body = {"version": self.base + 1, "schema": self.schema.json(), "files": ([] if self.overwrite else before["files"]) + fresh}
        system.create_dir(f"{folder}/_versions", recursive=True)
        final = f"{folder}/_versions/{self.base + 1:010d}.json"
        draft = f"{folder}/_versions/{uuid.uuid4().hex}.new"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps(body).encode())
        if system.get_file_info(final).type != fs.FileType.NotFound:
            raise RuntimeError(f"another writer changed {self.uri}")
        system.move(draft, final)

    def abort(self, messages: list) -> None:
        system, folder = _open(self.uri)
        for f in (f for m in messages if m for f in m.files):
            system.delete_file(f"{folder}/{f['name']}")


class StoreReader(DataSourceReader):
    def __init__(self, uri: str, schema: StructType) -> None:
        self.uri, self.schema, self.filters = uri, schema, []

    def pushFilters(self, filters: list) -> Iterator:
        for f in filters:
            if len(f.attribute) == 1 and (type(f) in RANGES or isinstance(f, IsNotNull)):
                self.filters.append(f)
            else:
                yield f

    def _may_hold(self, file: dict) -> bool:
        for f in self.filters:
            bounds = file["bounds"].get(f.attribute[0])
            if bounds and None not in bounds and type(f) in RANGES:
                low, high = map(_value, bounds)
                if not RANGES[type(f)](low, high, f.value):
                    return False
        return True

    def partitions(self) -> list[Pack]:
        packs, size = [], PACK_BYTES
        for file in sorted((f for f in manifest(self.uri)["files"] if self._may_hold(f)), key=lambda f: f["bytes"]):
            if size + file["bytes"] > PACK_BYTES:
                packs.append(Pack([]))
                size = 0
            packs[-1].names.append(file["name"])
            size += file["bytes"]
        return packs or [Pack([])]

    def read(self, partition: Pack) -> Iterator[pa.RecordBatch]:
        system, folder = _open(self.uri)
        test = None
        for f in self.filters:
            column = pc.field(f.attribute[0])
            one = column.is_valid() if isinstance(f, IsNotNull) else column.isin(list(f.value)) if isinstance(f, In) else getattr(column, TESTS[type(f)])(f.value)
            test = one if test is None else test & one
        target = to_arrow_schema(self.schema)
        for name in partition.names:
            with pq.ParquetFile(system.open_input_file(f"{folder}/{name}")) as file:
                for batch in file.iter_batches():
                    table = pa.Table.from_batches([batch]).select(target.names)
                    table = table.filter(test) if test is not None else table
                    yield from table.cast(target).to_batches()


class Store(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    @property
    def uri(self) -> str:
        return f"{self.options['folder'].rstrip('/')}/{self.options['dbtable']}"

    def schema(self) -> StructType:
        found = manifest(self.uri)["schema"]
        if found is None:
            raise ValueError(f"no table {self.options['dbtable']!r}")
        return StructType.fromJson(json.loads(found))

    def reader(self, schema: StructType) -> StoreReader:
        return StoreReader(self.uri, schema)

    def writer(self, schema: StructType, overwrite: bool) -> StoreWriter:
        return StoreWriter(self.uri, schema, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the source known to the session, whose setting for pushed filters its reader needs."""
    spark.dataSource.register(Store)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
