"""Queries over sources and sinks. Each writes a whole table and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.plans.registry import Tables, query
from tidemill.session import scratch_path
from tidemill.sources import readers, store, writers

CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


def _name(stem: str) -> str:
    """Tables and views carry a run suffix, so sessions do not clash."""
    return f"{stem}_{uuid.uuid4().hex[:12]}"


def _then_drop(spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
    """Leave no table behind; the files of a table with its own path stay, and the plan reads those."""
    spark.sql(f"DROP TABLE {name}")
    return df


@query("src_csv_schema", CUSTOMER_SQL)
def csv_schema(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv-schema")
    writers.write_csv(t.customer, path)
    return readers.read_csv(t.spark, path, schema=t.customer.schema)


@query("src_csv_infer", "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_infer(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv-infer")
    writers.write_csv(t.part, path)
    return readers.read_csv(t.spark, path)


@query("src_csv_multiline", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_multiline(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv-multiline")
    writers.write_csv(t.documents, path)
    return readers.read_csv(t.spark, path, schema=t.documents.schema, multiline=True)


@query(
    "src_format_dispatch",
    """SELECT fmt, n_nationkey, n_name, n_regionkey
       FROM nation, (VALUES ('parquet'), ('json'), ('orc'), ('csv')) f(fmt)""",
)
def format_dispatch(t: Tables) -> DataFrame:
    nation, parts = t.nation, []
    for fmt in ("parquet", "json", "orc", "csv"):
        path = scratch_path(t.spark, f"fmt-{fmt}")
        nation.write.mode("overwrite").format(fmt).option("header", True).save(path)
        parts.append(
            readers.read_format(t.spark, path, fmt, schema=nation.schema).select(F.lit(fmt).alias("fmt"), "*")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("src_catalog_table", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def catalog_table(t: Tables) -> DataFrame:
    name = _name("supplier")
    writers.overwrite_table(t.supplier, name, scratch_path(t.spark, "catalog"))
    return _then_drop(t.spark, name, t.spark.table(name))


@query("sink_table_overwrite", "SELECT r_regionkey, r_name FROM region")
def table_overwrite(t: Tables) -> DataFrame:
    name, path = _name("region"), scratch_path(t.spark, "overwrite")
    writers.overwrite_table(t.region.withColumn("r_name", F.upper("r_name")), name, path)
    writers.overwrite_table(t.region, name, path)
    return _then_drop(t.spark, name, t.spark.table(name))


@query("sink_csv", "SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY 1")
def sink_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "sink-csv")
    counts = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n_orders"))
    writers.write_csv(counts, path)
    return readers.read_csv(t.spark, path, schema=counts.schema)


@query(
    "sink_parquet_mode",
    "SELECT s_suppkey, s_name FROM supplier UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def parquet_mode(t: Tables) -> DataFrame:
    """Overwrite replaces the first write, the append adds to it."""
    path = scratch_path(t.spark, "parquet-mode")
    rows = t.supplier.select("s_suppkey", "s_name")
    writers.write_parquet(rows.limit(0), path)
    writers.write_parquet(rows, path, reprocess=True)
    writers.write_parquet(rows, path)
    return t.spark.read.parquet(path)


@query("src_external_table", "SELECT n_regionkey, count(*) AS n_nations FROM nation GROUP BY 1")
def external_table(t: Tables) -> DataFrame:
    name = _name("nation_ext")
    writers.register_directory(t.nation, name, scratch_path(t.spark, "external"))
    out = t.spark.sql(f"SELECT n_regionkey, count(*) AS n_nations FROM {name} GROUP BY n_regionkey")
    return _then_drop(t.spark, name, out)


@query(
    "src_date_bounded",
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
       WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1998-04-01'""",
)
def date_bounded(t: Tables) -> DataFrame:
    return readers.date_bounded(t.orders, "o_orderdate", "1998-01-01", "1998-03-31").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


def views(spark: SparkSession, prefix: str) -> DataFrame:
    return spark.sql(f"SHOW VIEWS LIKE '{prefix}*'")


@query(
    "sql_temp_view_roundtrip",
    """SELECT n_name, count(*) AS n_customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def temp_view_roundtrip(t: Tables) -> DataFrame:
    prefix = _name("tv")
    t.customer.createOrReplaceTempView(f"{prefix}_customer")
    t.nation.createOrReplaceTempView(f"{prefix}_nation")
    if views(t.spark, prefix).count() != 2:
        raise RuntimeError("temp views are not listed")
    out = t.spark.sql(
        f"""SELECT n_name, count(*) AS n_customers
            FROM {prefix}_customer JOIN {prefix}_nation ON c_nationkey = n_nationkey GROUP BY n_name"""
    )
    for suffix in ("customer", "nation"):
        t.spark.catalog.dropTempView(f"{prefix}_{suffix}")
    return out


@query(
    "src_connector_table",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000 AND o_orderstatus IN ('F', 'P')",
)
def connector_table(t: Tables) -> DataFrame:
    """A named table of a connector, scanned with pushed filters."""
    store.register(t.spark)
    options = {"folder": scratch_path(t.spark, "store")}
    writers.write_connector(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), store.NAME, options, "orders", writers=4)
    orders = readers.read_connector(t.spark, store.NAME, options, "orders")
    return orders.where("o_totalprice > 300000 AND o_orderstatus IN ('F', 'P')").select("o_orderkey", "o_custkey", "o_totalprice")


@query("sink_connector_modes", "SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def connector_modes(t: Tables) -> DataFrame:
    """An overwrite replaces what was there, an append adds to it."""
    store.register(t.spark)
    options = {"folder": scratch_path(t.spark, "store")}
    customers = t.customer.select("c_custkey", "c_name", "c_acctbal")
    writers.write_connector(customers.withColumn("c_acctbal", F.lit(0.0)), store.NAME, options, "parties")
    writers.write_connector(customers, store.NAME, options, "parties")
    writers.write_connector(t.supplier.select("s_suppkey", "s_name", "s_acctbal").toDF(*customers.columns), store.NAME, options, "parties", mode="append")
    return readers.read_connector(t.spark, store.NAME, options, "parties")
