"""Queries over change capture, loads and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.operators import changes as cdc, reconcile
from tidemill.plans.registry import Tables, query
from tidemill.session import scratch_path
from tidemill.sources.readers import read_csv

RUN = "2024-10-01 06:00:00"
DATA = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def new_batch(t: Tables) -> DataFrame:
    """A customer extract with moved nations, changed segments and new keys; one in ten customers is missing."""
    key = F.col("c_custkey")
    fresh = t.supplier.select(
        (F.col("s_suppkey") + 100000000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
        F.lit("BUILDING").alias("c_mktsegment"),
    )
    known = t.customer.where(key % 10 != 9).select(
        "c_custkey",
        "c_name",
        F.when(key % 5 == 0, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey")).alias("c_nationkey"),
        "c_acctbal",
        F.when(key % 7 == 0, F.lit("MACHINERY")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    return known.unionByName(fresh)


BATCH_SQL = """batch AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN CAST((c_nationkey + 1) % 25 AS INTEGER) ELSE c_nationkey END AS c_nationkey,
    c_acctbal, CASE WHEN c_custkey % 7 = 0 THEN 'MACHINERY' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 10 <> 9
    UNION ALL SELECT s_suppkey + 100000000, s_name, s_nationkey, s_acctbal, 'BUILDING' FROM supplier)"""


@query(
    "cdc_row_hash",
    """WITH c AS (SELECT *, CASE WHEN c_custkey % 6 <> 0 THEN c_mktsegment END AS seg FROM customer)
       SELECT c_custkey, sha256(concat_ws('|', CAST(c_acctbal AS VARCHAR), c_name, seg)) AS legacy_hash,
              sha256(concat_ws('|', CAST(c_acctbal AS VARCHAR), c_name, coalesce(seg, '\\N'))) AS row_hash FROM c""",
)
def row_hash(t: Tables) -> DataFrame:
    rows = t.customer.withColumn("seg", F.when(F.col("c_custkey") % 6 != 0, F.col("c_mktsegment")))
    columns = ["seg", "c_name", "c_acctbal"]
    return rows.select(
        "c_custkey",
        F.decode(cdc.row_hash(columns, legacy=True), "UTF-8").alias("legacy_hash"),
        F.lower(F.hex(cdc.row_hash(columns))).alias("row_hash"),
    )


@query(
    "cdc_dim_audit",
    """SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR)) AS key_hash, sha256(CAST(c_nationkey AS VARCHAR)) AS t1_hash,
              sha256(concat_ws('|', CAST(c_acctbal AS VARCHAR), c_mktsegment, c_name)) AS t2_hash, false AS deleted,
              TIMESTAMP '2024-10-01 06:00:00' AS created_at, CAST(NULL AS TIMESTAMP) AS data_created_at FROM customer""",
)
def dim_audit(t: Tables) -> DataFrame:
    rows = cdc.dimension_audit(t.customer, ["c_custkey"], RUN, overwritten=["c_nationkey"])
    hexed = lambda c: F.lower(F.hex(c))
    return rows.select(
        "c_custkey",
        hexed("__BusinessKeyHash").alias("key_hash"),
        hexed("__Type1Hash").alias("t1_hash"),
        hexed("__Type2Hash").alias("t2_hash"),
        F.col("__DeletedFlag").alias("deleted"),
        F.col("__CreateDateTime").alias("created_at"),
        F.col("__DataCreationDateTime").alias("data_created_at"),
    )


@query(
    "cdc_fact_audit",
    """SELECT l_orderkey, l_linenumber, l_partkey, sha256(concat_ws('|', CAST(l_linenumber AS VARCHAR), CAST(l_orderkey AS VARCHAR))) AS fact_hash,
              false AS deleted, TIMESTAMP '2024-10-01 06:00:00' AS created_at FROM lineitem""",
)
def fact_audit(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return cdc.fact_audit(rows, ["l_orderkey", "l_linenumber"], RUN).select(
        *rows.columns,
        F.lower(F.hex("__FactKeyHash")).alias("fact_hash"),
        F.col("__DeletedFlag").alias("deleted"),
        F.col("__CreateDateTime").alias("created_at"),
    )


CLASSIFY_SQL = f"""WITH {BATCH_SQL}
    SELECT coalesce(b.c_custkey, c.c_custkey) AS c_custkey,
           CASE WHEN b.c_custkey IS NULL THEN 'deleted' WHEN c.c_custkey IS NULL THEN 'new'
                WHEN b.c_nationkey <> c.c_nationkey THEN 'type_i_changed'
                WHEN (b.c_name, b.c_acctbal, b.c_mktsegment) <> (c.c_name, c.c_acctbal, c.c_mktsegment) THEN 'type_ii_changed'
                ELSE 'unchanged' END AS change_type
    FROM batch b FULL JOIN customer c ON b.c_custkey = c.c_custkey"""


@query("cdc_classify", CLASSIFY_SQL)
def classify(t: Tables) -> DataFrame:
    stamp = lambda df: cdc.dimension_audit(df, ["c_custkey"], RUN, overwritten=["c_nationkey"])
    out = cdc.classify(stamp(new_batch(t)), stamp(t.customer), ["c_custkey"], with_deleted=True)
    return out.select("c_custkey", "change_type")


UPSERT_SQL = f"""WITH {BATCH_SQL}
    SELECT * FROM batch UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM batch)"""


@query("cdc_scd1_merge", UPSERT_SQL)
def scd1_merge(t: Tables) -> DataFrame:
    return cdc.upsert(t.customer, new_batch(t), ["c_custkey"])


SCD2_SQL = f"""WITH {BATCH_SQL},
    j AS (SELECT c.c_custkey AS ck, b.c_custkey AS bk, c.c_name AS cn, c.c_nationkey AS cnat, c.c_acctbal AS cbal, c.c_mktsegment AS cseg,
                 b.c_name AS bn, b.c_nationkey AS bnat, b.c_acctbal AS bbal, b.c_mktsegment AS bseg,
                 c.c_custkey IS NOT NULL AND b.c_custkey IS NOT NULL AND (c.c_name, c.c_acctbal, c.c_mktsegment) <> (b.c_name, b.c_acctbal, b.c_mktsegment) AS changed
          FROM customer c FULL JOIN batch b ON c.c_custkey = b.c_custkey)
    SELECT ck AS c_custkey, cn AS c_name, CASE WHEN bk IS NULL OR changed THEN cnat ELSE bnat END AS c_nationkey, cbal AS c_acctbal, cseg AS c_mktsegment,
           DATE '2020-01-01' AS valid_from, CASE WHEN changed THEN DATE '2024-10-01' END AS valid_to, NOT changed AS is_current
    FROM j WHERE ck IS NOT NULL
    UNION ALL
    SELECT bk, bn, bnat, bbal, bseg, DATE '2024-10-01', NULL, true FROM j WHERE changed OR ck IS NULL"""


@query("cdc_scd2_merge", SCD2_SQL)
def scd2_merge(t: Tables) -> DataFrame:
    first = cdc.scd2_open(t.customer, "2020-01-01")
    return cdc.scd2_merge(first, new_batch(t), ["c_custkey"], ["c_nationkey"], "2024-10-01")


@query(
    "pipe_scd_clients",
    f"""WITH m AS ({SCD2_SQL}), k AS ({CLASSIFY_SQL})
        SELECT change_type, is_current, count(*) AS n_rows, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM m JOIN k ON m.c_custkey = k.c_custkey GROUP BY ALL""",
)
def scd_clients(t: Tables) -> DataFrame:
    """The client load: audit, classify, merge twice (the second time changes nothing), report by change type."""
    stamp = lambda df: cdc.dimension_audit(df, ["c_custkey"], RUN, overwritten=["c_nationkey"])
    batch = new_batch(t)
    kinds = cdc.classify(stamp(batch), stamp(t.customer), ["c_custkey"], with_deleted=True)
    merged = cdc.scd2_merge(cdc.scd2_open(t.customer, "2020-01-01"), batch, ["c_custkey"], ["c_nationkey"], "2024-10-01")
    again = cdc.scd2_merge(merged, batch, ["c_custkey"], ["c_nationkey"], "2024-10-01")
    report = again.join(kinds.select("c_custkey", "change_type"), "c_custkey").groupBy("change_type", "is_current")
    return report.agg(
        F.count("*").alias("n_rows"), F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double").alias("balance")
    )


LATE_SQL = """(SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate, o_orderpriority
               FROM orders WHERE o_orderstatus = 'P')"""


def late_orders(t: Tables) -> DataFrame:
    """Orders that were pending, now finished and repriced."""
    return t.orders.where("o_orderstatus = 'P'").withColumns(
        {"o_orderstatus": F.lit("F"), "o_totalprice": F.col("o_totalprice") + 1}
    )


@query("load_upsert", f"SELECT * FROM {LATE_SQL} UNION ALL SELECT * FROM orders WHERE o_orderstatus <> 'P'")
def load_upsert(t: Tables) -> DataFrame:
    """Upsert from a staging table, written as a new version of the table."""
    staged = t.spark.read.parquet(cdc.write_version(late_orders(t), "staging"))
    return t.spark.read.parquet(cdc.write_version(cdc.upsert(t.orders, staged, ["o_orderkey"]), "orders"))


@query(
    "load_replace_window",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderdate < DATE '2001-01-01'
       UNION ALL SELECT o_orderkey, o_totalprice * 2 FROM orders WHERE o_orderdate >= DATE '2001-01-01' AND o_orderstatus <> 'P'""",
)
def replace_window(t: Tables) -> DataFrame:
    start = F.lit("2001-01-01").cast("timestamp_ntz")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    batch = rows.where((F.col("o_orderdate") >= start) & (F.col("o_orderstatus") != "P")).withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    once = cdc.replace_window(rows, batch, "o_orderdate", start)
    return cdc.replace_window(once, batch, "o_orderdate", start).select("o_orderkey", "o_totalprice")


@query(
    "load_replace_partitions",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, count(*) AS n, CAST(sum(CAST(CASE WHEN year(o_orderdate) >= 2000 THEN o_totalprice * 2 ELSE o_totalprice END AS DECIMAL(18,2))) AS DOUBLE) AS total
       FROM orders GROUP BY 1""",
)
def replace_partitions(t: Tables) -> DataFrame:
    """Two of seven year partitions are overwritten, the others are not touched."""
    path = scratch_path(t.spark, "orders-by-year")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("yr"))
    cdc.overwrite_partitions(rows, path, "yr")
    doubled = rows.where("yr >= 2000").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    cdc.overwrite_partitions(doubled, path, "yr")
    return t.spark.read.parquet(path).groupBy("yr").agg(
        F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )


@query(
    "load_lookback",
    """SELECT o_orderkey, '2001 Q2' AS start_quarter FROM orders WHERE strftime(o_orderdate, '%Y-%m') >= '2001-05'""",
)
def load_lookback(t: Tables) -> DataFrame:
    """Orders from the first day of the month that lies 90 days before 2001-07-31."""
    _, month, quarter = cdc.lookback("20010731", 90)
    first = F.lit(f"{month}-01").cast("timestamp_ntz")
    return t.orders.where(F.col("o_orderdate") >= first).select("o_orderkey", F.lit(quarter).alias("start_quarter"))


@query(
    "recon_compare",
    f"""WITH {BATCH_SQL},
        j AS (SELECT coalesce(c.c_custkey, b.c_custkey) AS k, c.c_custkey AS ck, b.c_custkey AS bk, c.c_nationkey AS cnat, b.c_nationkey AS bnat,
                     c.c_mktsegment AS cseg, b.c_mktsegment AS bseg FROM customer c FULL JOIN batch b ON c.c_custkey = b.c_custkey)
        SELECT k AS c_custkey, '*' AS column_name, CASE WHEN ck IS NULL THEN 'absent' ELSE 'present' END AS expected,
               CASE WHEN bk IS NULL THEN 'absent' ELSE 'present' END AS actual FROM j WHERE ck IS NULL OR bk IS NULL
        UNION ALL SELECT k, 'c_nationkey', CAST(cnat AS VARCHAR), CAST(bnat AS VARCHAR) FROM j WHERE cnat <> bnat
        UNION ALL SELECT k, 'c_mktsegment', cseg, bseg FROM j WHERE cseg <> bseg""",
)
def recon_compare(t: Tables) -> DataFrame:
    noisy = new_batch(t).withColumns(
        {"c_acctbal": F.col("c_acctbal") + 0.001, "c_name": F.concat(F.upper("c_name"), F.lit(" "))}
    )
    return reconcile.compare(noisy, t.customer, ["C_CUSTKEY"], tolerance=0.01)


@query(
    "recon_baseline",
    "SELECT o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1",
)
def recon_baseline(t: Tables) -> DataFrame:
    """A small output kept as one CSV file; the copy must not differ from it."""
    path = scratch_path(t.spark, "baseline")
    out = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("top"))
    reconcile.write_baseline(out, path)
    kept = read_csv(t.spark, path, schema=out.schema)
    if not reconcile.compare(kept, out, ["o_orderpriority"]).isEmpty():
        raise RuntimeError("baseline differs from the output")
    return kept
