"""Queries over data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidemill.operators import quality as dq
from tidemill.plans.registry import Tables, query


@query(
    "dq_value_range",
    "SELECT 'l_discount' AS column_name, count(*) FILTER (WHERE l_discount < 0.0 OR l_discount > 0.08) AS bad_rows FROM lineitem",
)
def value_range(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count_if(dq.outside("l_discount", 0.0, 0.08)).alias("bad_rows")).select(
        F.lit("l_discount").alias("column_name"), "bad_rows"
    )


NUMBERS = ["l_linenumber", "l_quantity", "l_discount", "l_tax"]


@query(
    "dq_null_zero_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE x IS NULL) AS nulls, count(*) FILTER (WHERE x = 0) AS zeros "
        f"FROM (SELECT CASE WHEN l_partkey % 41 <> 0 THEN {c} END AS x FROM lineitem)"
        for c in NUMBERS
    ),
)
def null_zero_counts(t: Tables) -> DataFrame:
    keep = F.col("l_partkey") % 41 != 0
    return dq.null_zero_counts(t.lineitem.select(*[F.when(keep, F.col(c)).alias(c) for c in NUMBERS]), NUMBERS)


@query(
    "dq_allowed_values",
    """SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""",
)
def allowed_values(t: Tables) -> DataFrame:
    bad = t.orders.where(dq.not_allowed("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]))
    return bad.groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query(
    "dq_rate",
    """SELECT count(*) FILTER (WHERE r IS NULL) AS null_rows, count(*) FILTER (WHERE r < 0.01 OR r > 0.09) AS range_rows,
              count(*) FILTER (WHERE r IS NULL OR r < 0.01 OR r > 0.09) AS bad_rows
       FROM (SELECT CASE WHEN l_partkey % 31 <> 0 THEN l_discount END AS r FROM lineitem)""",
)
def rate(t: Tables) -> DataFrame:
    rows = t.lineitem.select(F.when(F.col("l_partkey") % 31 != 0, F.col("l_discount")).alias("r"))
    return rows.agg(
        F.count_if(F.col("r").isNull()).alias("null_rows"),
        F.count_if(dq.outside("r", 0.01, 0.09)).alias("range_rows"),
        F.count_if(dq.bad_rate("r", 0.01, 0.09)).alias("bad_rows"),
    )


@query("dq_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicates(t: Tables) -> DataFrame:
    return dq.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "dq_suite",
    """WITH r AS (SELECT 'quantity range' AS label, count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50) AS bad_rows FROM lineitem
            UNION ALL SELECT 'discount rate', count(*) FILTER (WHERE l_discount IS NULL OR l_discount < 0 OR l_discount > 0.09) FROM lineitem
            UNION ALL SELECT 'flag allowed', count(*) FILTER (WHERE l_returnflag NOT IN ('R', 'N')) FROM lineitem
            UNION ALL SELECT 'key not null', count(*) FILTER (WHERE l_orderkey IS NULL) FROM lineitem
            UNION ALL SELECT 'line unique', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
            UNION ALL SELECT 'schema', 1)
       SELECT label, bad_rows, CASE WHEN bad_rows = 0 THEN 'passed' ELSE 'failed' END AS status FROM r""",
)
def suite(t: Tables) -> DataFrame:
    declared = StructType([StructField("l_orderkey", LongType()), StructField("l_linenumber", LongType()), StructField("l_tax", DoubleType())])
    return dq.suite(
        t.lineitem,
        [
            dq.Check("quantity range", dq.outside("l_quantity", 1, 50)),
            dq.Check("discount rate", dq.bad_rate("l_discount", 0.0, 0.09)),
            dq.Check("flag allowed", dq.not_allowed("l_returnflag", ["R", "N"])),
            dq.Check("key not null", F.col("l_orderkey").isNull()),
        ],
        unique={"line unique": ["l_orderkey", "l_linenumber"]},
        schema=declared,
    )


MIXED_SQL = """CASE event_id % 8 WHEN 0 THEN regexp_extract(props, '([0-9]+)', 1) WHEN 1 THEN CAST(value AS VARCHAR)
    WHEN 2 THEN strftime(ts, '%Y/%m/%d') WHEN 3 THEN strftime(ts, '%m-%d-%Y') WHEN 4 THEN strftime(ts, '%m.%d.%Y')
    WHEN 5 THEN event_type WHEN 6 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END"""
FORMATS_SQL = ["%Y/%m/%d", "%m/%d/%Y", "%Y", "%m.%d.%Y", "%m/%Y/%d", "%m-%d-%Y"]


@query(
    "profile_parseable",
    f"""WITH m AS (SELECT {MIXED_SQL} AS mixed, CASE WHEN event_id % 3 = 0 THEN '02/30/2024' ELSE strftime(ts, '%m/%d/%Y') END AS day FROM events)
        SELECT column_name, count(x) AS n_values, count(TRY_CAST(x AS DECIMAL(38,10))) AS n_numbers,
               count(coalesce({', '.join(f"CASE WHEN length(x) = {n} THEN try_strptime(x, '{f}') END" for f, n in zip(FORMATS_SQL, (10, 10, 4, 10, 10, 10)))},
                     CASE WHEN x LIKE '____-__-__%' THEN TRY_CAST(x AS TIMESTAMP) END)) AS n_dates
        FROM (SELECT 'mixed' AS column_name, mixed AS x FROM m UNION ALL SELECT 'day', day FROM m) GROUP BY 1""",
)
def parseable(t: Tables) -> DataFrame:
    slot = F.col("event_id") % 8
    mixed = (
        F.when(slot == 0, F.regexp_extract("props", "([0-9]+)", 1))
        .when(slot == 1, F.col("value").cast("string"))
        .when(slot == 2, F.date_format("ts", "yyyy/MM/dd"))
        .when(slot == 3, F.date_format("ts", "MM-dd-yyyy"))
        .when(slot == 4, F.date_format("ts", "MM.dd.yyyy"))
        .when(slot == 5, F.col("event_type"))
        .when(slot == 6, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    )
    day = F.when(F.col("event_id") % 3 == 0, F.lit("02/30/2024")).otherwise(F.date_format("ts", "MM/dd/yyyy"))
    return dq.parse_profile(t.wide("events", "event_id", "props", "value", "ts", "event_type").select(mixed.alias("mixed"), day.alias("day")), ["mixed", "day"])
