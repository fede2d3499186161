"""Sinks: tables, CSV, parquet, JDBC and connectors."""

from __future__ import annotations

from pyspark.sql import DataFrame


def overwrite_table(df: DataFrame, table: str, path: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_csv(df: DataFrame, path: str) -> None:
    """One file per task. Text that holds quotes or line breaks reads back with ``multiline``."""
    df.write.mode("overwrite").option("escape", '"').csv(path, header=True)


def write_parquet(df: DataFrame, path: str, reprocess: bool = False) -> None:
    """Overwrite on reprocess, else append. Appending twice doubles the rows; prefer a window replace."""
    df.write.mode("overwrite" if reprocess else "append").parquet(path)


def jdbc_frame(df: DataFrame, writers: int) -> DataFrame:
    """The rows in as many tasks as may write at once, each of which opens one connection."""
    return df.repartition(writers)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], writers: int = 10) -> None:
    jdbc_frame(df, writers).write.mode("overwrite").jdbc(url=url, table=table, properties=properties)


def write_connector(df: DataFrame, source: str, options: dict[str, str], table: str, mode: str = "overwrite", writers: int | None = None) -> None:
    """Named table of a connector, replaced or appended to; by ``writers`` tasks at once if given."""
    rows = df.repartition(writers) if writers else df
    rows.write.format(source).options(**options).option("dbtable", table).mode(mode).save()


def register_directory(df: DataFrame, table: str, path: str) -> None:
    """Write parquet files, then lay a table over the directory."""
    df.write.mode("overwrite").parquet(path)
    df.sparkSession.sql(f"CREATE TABLE IF NOT EXISTS {table} USING PARQUET LOCATION '{path}'")
