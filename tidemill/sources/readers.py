"""Scans: files with a given or inferred schema, tables, connectors, JDBC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

# Declared format -> Spark source. Table formats whose jar is absent are read
# through the files they consist of.
FORMATS = {
    "parquet": "parquet",
    "json": "json",
    "jsonl": "json",
    "orc": "orc",
    "csv": "csv",
    "iceberg": "iceberg",
}


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, multiline: bool = False
) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred in an extra pass.

    ``multiline`` allows line breaks in quoted fields; such a file cannot be
    split, so convert it to parquet once rather than scan it often.
    """
    reader = spark.read.option("header", True)
    if multiline:
        reader = reader.option("multiLine", True).option("escape", '"')
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_format(spark: SparkSession, path: str, fmt: str, schema: StructType | None = None) -> DataFrame:
    """Scan by declared format; an unknown name raises."""
    if fmt.lower() not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, known are {sorted(FORMATS)}")
    if fmt.lower() == "csv":
        return read_csv(spark, path, schema)
    reader = spark.read.format(FORMATS[fmt.lower()])
    return (reader.schema(schema) if schema else reader).load(path)


def read_connector(spark: SparkSession, source: str, options: dict[str, str], table: str) -> DataFrame:
    """Named table of a warehouse connector (data source V2)."""
    return spark.read.format(source).options(**options).option("dbtable", table).load()


def jdbc_options(
    url: str,
    query: str,
    properties: dict[str, str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Options of a parallel JDBC scan of a sub-select given as the table."""
    options = {"url": url, "dbtable": f"({query}) src", **properties}
    if partition_column:
        if bounds is None or partitions is None:
            raise ValueError("a partitioned scan needs bounds and a number of partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, query: str, properties: dict[str, str], **partitioning) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query, properties, **partitioning)).load()


def date_bounded(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows of the closed date range, lower-cased names.

    The bounds are literals of the column's own type, so the filter reaches
    the scan and prunes row groups.
    """
    dtype = dict(df.dtypes)[column]
    low: Column = F.lit(first).cast(dtype)
    after: Column = F.date_add(F.lit(last).cast("date"), 1).cast(dtype)
    return df.where((F.col(column) >= low) & (F.col(column) < after)).toDF(*[c.lower() for c in df.columns])
