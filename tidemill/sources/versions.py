"""Tables that are published in versions: files first, then one switch.

A table is a folder. A publish writes its files to a folder of their own, then a manifest
with the number after the newest. The manifest appears by a rename that fails if its
number is taken, so readers see the old version or the new one and never a mixture, and
two writers cannot both win. A failed publish leaves files that no manifest names.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

PART = "__part"
#: Fixed value: the name Spark gives the part of null.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


class Conflict(RuntimeError):
    """Another writer published the version first."""


class VersionedTable:
    """A published table below ``root``, optionally in parts by the text of one column."""

    def __init__(self, spark: SparkSession, root: str, part_by: str | None = None) -> None:
        self.spark, self.root, self.part_by = spark, root.rstrip("/"), part_by
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._bytes = jvm.org.apache.commons.io.IOUtils

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/_versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """The newest manifest, or that of one version; an empty one before the first publish."""
        known = self.versions()
        if not known:
            return {"version": 0, "schema": None, "parts": []}
        stream = self._fs.open(self._path(f"{self.root}/_versions/{version or known[-1]:010d}.json"))
        try:
            return json.loads(self._bytes.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or an older one. Filters and columns reach the parquet scan."""
        found = self.manifest(version)
        if found["schema"] is None:
            raise ValueError(f"nothing is published below {self.root}")
        schema = StructType.fromJson(json.loads(found["schema"]))
        if not found["parts"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p['path']}" for p in found["parts"]])

    def publish(self, df: DataFrame) -> int:
        """Replaces the whole table; returns the new version."""
        before = self.manifest()
        return self._commit(before["version"], df.schema, self._write(df))

    def append(self, df: DataFrame) -> int:
        before = self.manifest()
        return self._commit(before["version"], df.schema, before["parts"] + self._write(df))

    def replace_from(self, df: DataFrame, start: str) -> int:
        """Replaces all parts from ``start`` on by the rows of ``df``, which must not lie before it.

        Only the new files are written; older parts are named again. The same rows again
        change nothing but the version.
        """
        if self.part_by is None:
            raise ValueError("only a table in parts has windows")
        before, fresh = self.manifest(), self._write(df)
        early = [p["value"] for p in fresh if p["value"] is None or p["value"] < start]
        if early:
            raise ValueError(f"rows before the window: {early[:3]}")
        kept = [p for p in before["parts"] if p["value"] is None or p["value"] < start]
        return self._commit(before["version"], df.schema, kept + fresh)

    def _write(self, df: DataFrame) -> list[dict]:
        name = f"data-{uuid.uuid4().hex}"
        if self.part_by is None:
            df.write.parquet(f"{self.root}/{name}")
            return [{"path": name, "value": None}]
        # Rows of a part go together into tasks of even size, so a large part has several.
        tagged = df.withColumn(PART, F.col(self.part_by).cast("string")).hint("rebalance", PART)
        tagged.write.partitionBy(PART).parquet(f"{self.root}/{name}")
        folders = [st.getPath().getName() for st in self._fs.listStatus(self._path(f"{self.root}/{name}")) if st.isDirectory()]
        values = {f: unquote(f.removeprefix(f"{PART}=")) for f in folders if f.startswith(f"{PART}=")}
        return [{"path": f"{name}/{f}", "value": None if v == NULL_PART else v} for f, v in sorted(values.items())]

    def _commit(self, before: int, schema: StructType, parts: list[dict]) -> int:
        version = before + 1
        final = self._path(f"{self.root}/_versions/{version:010d}.json")
        draft = self._path(f"{self.root}/_versions/.{uuid.uuid4().hex}")
        body = {"version": version, "schema": schema.json(), "parts": parts}
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(body).encode()))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise Conflict(f"version {version} of {self.root} exists")
        return version
