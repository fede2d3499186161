"""Where queries are registered, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tables:
    """Lazy access to the parquet tables of one data directory."""

    spark: SparkSession
    path: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def wide(self, name: str, *columns: str) -> DataFrame:
        """A scan for work that is heavy per row, on all cores.

        Files with fewer splits than there are cores would leave most idle, so
        their rows are dealt out; a table with enough splits is not shuffled.
        """
        scan = getattr(self, name)
        scan = scan.select(*columns) if columns else scan
        n = self.spark.sparkContext.defaultParallelism
        return scan if scan.rdd.getNumPartitions() >= n else scan.repartition(n)


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, path: str) -> DataFrame:
        return self.build(Tables(spark, path.rstrip("/")))


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated ``Tables -> DataFrame`` function under ``name``."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, sql)
        return build

    return register
