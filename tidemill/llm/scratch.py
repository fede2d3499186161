"""Intermediate files of a job with many steps: shuffles and tables go when they are no longer needed."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.files import open_folder

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of each query in the block when that query ends.

    For steps that end in a written table: nothing reads their shuffles again.
    """
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def drop_tables(*tables: DataFrame) -> None:
    """Deletes tables that ``cut_lineage`` wrote, once nothing will read them again."""
    for table in tables:
        for folder in {posixpath.dirname(f) for f in table.inputFiles()}:
            system, path = open_folder(folder)
            system.delete_dir(path)
