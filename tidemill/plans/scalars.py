"""Queries over the scalar function families the operators use."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions.columns import rounded
from tidemill.plans.registry import Tables, query


@query(
    "fn_string",
    """SELECT p_partkey, upper(trim(p_name)) AS up, lower(p_brand) AS low, concat_ws('-', p_brand, p_type) AS joined, substr(p_name, 1, 4) AS head,
              CAST(length(p_name) AS INTEGER) AS len, regexp_replace(p_name, ' +', '_', 'g') AS squeezed, regexp_matches(p_name, '^red') AS red,
              format('{:.2f}', p_retailprice) || '%' AS pct, reverse(p_type) AS back, split_part(p_brand, '#', 2) AS code, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded FROM part""",
)
def strings(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        F.upper(F.trim("p_name")).alias("up"),
        F.lower("p_brand").alias("low"),
        F.concat_ws("-", "p_brand", "p_type").alias("joined"),
        F.substring("p_name", 1, 4).alias("head"),
        F.length("p_name").alias("len"),
        F.regexp_replace("p_name", " +", "_").alias("squeezed"),
        F.col("p_name").rlike("^red").alias("red"),
        F.concat(F.regexp_replace(F.format_number("p_retailprice", 2), ",", ""), F.lit("%")).alias("pct"),
        F.reverse("p_type").alias("back"),
        F.split_part("p_brand", F.lit("#"), F.lit(2)).alias("code"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
    )


@query(
    "fn_date",
    """SELECT o_orderkey, CAST(date_trunc('quarter', d) AS DATE) AS q_start, last_day(CAST(d - INTERVAL 7 MONTH AS DATE)) AS month_end, CAST(d + 45 AS DATE) AS later,
              CAST(dayofyear(d) AS INTEGER) AS doy, CAST(weekofyear(d) AS INTEGER) AS week, CAST(year(d) * 100 + month(d) AS INTEGER) AS ym, CAST(date_diff('day', DATE '1970-01-01', d) AS INTEGER) AS epoch_day
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def date_functions(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.trunc(d, "quarter").alias("q_start"),
        F.last_day(F.add_months(d, -7)).alias("month_end"),
        F.date_add(d, 45).alias("later"),
        F.dayofyear(d).alias("doy"),
        F.weekofyear(d).alias("week"),
        (F.year(d) * 100 + F.month(d)).alias("ym"),
        F.unix_date(d).alias("epoch_day"),
    )


@query(
    "fn_math",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(CAST(l_extendedprice AS DECIMAL(24,8)), 1) AS DOUBLE) AS rounded, l_extendedprice / nullif(l_tax, 0) AS ratio,
              greatest(l_discount, l_tax) AS most, least(l_discount, l_tax) AS least, CAST(floor(l_extendedprice) AS BIGINT) AS whole, CAST(ceil(l_quantity / 7) AS BIGINT) AS packs,
              abs(l_tax - l_discount) AS gap, l_quantity * l_quantity AS squared, CAST(l_quantity AS BIGINT) % 7 AS rest FROM lineitem""",
)
def math(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        rounded("l_extendedprice", 1).alias("rounded"),
        F.try_divide("l_extendedprice", "l_tax").alias("ratio"),
        F.greatest("l_discount", "l_tax").alias("most"),
        F.least("l_discount", "l_tax").alias("least"),
        F.floor("l_extendedprice").alias("whole"),
        F.ceil(F.col("l_quantity") / 7).alias("packs"),
        F.abs(F.col("l_tax") - F.col("l_discount")).alias("gap"),
        F.try_multiply("l_quantity", "l_quantity").alias("squared"),
        (F.col("l_quantity").cast("bigint") % 7).alias("rest"),
    )


@query(
    "fn_null_and_cast",
    """SELECT event_id, nullif(user_id % 3, 0) AS zero_to_null, coalesce(nullif(user_id % 3, 0), -1) AS filled, value BETWEEN 10 AND 20 AS mid, event_type IN ('view', 'click') AS seen,
              TRY_CAST(regexp_extract(props, '([0-9]+)', 1) || CASE WHEN event_id % 2 = 0 THEN '' ELSE 'q' END AS INTEGER) AS k, CAST(value AS DECIMAL(18,2)) AS amount FROM events""",
)
def null_and_cast(t: Tables) -> DataFrame:
    part = F.col("user_id") % 3
    text = F.concat(F.regexp_extract("props", "([0-9]+)", 1), F.when(F.col("event_id") % 2 == 0, "").otherwise("q"))
    return t.events.select(
        "event_id",
        F.nullif(part, F.lit(0)).alias("zero_to_null"),
        F.coalesce(F.nullif(part, F.lit(0)), F.lit(-1)).alias("filled"),
        F.col("value").between(10, 20).alias("mid"),
        F.col("event_type").isin("view", "click").alias("seen"),
        F.when(text.rlike("^[0-9]+$"), text.try_cast("int")).alias("k"),
        F.col("value").cast("decimal(18,2)").alias("amount"),
    )


@query(
    "fn_array_and_hash",
    """SELECT p_partkey, array_to_string(list_sort(string_split(p_name, ' ')), ',') AS sorted, string_split(p_name, ' ')[2] AS second, string_split(p_name, ' ')[9] AS beyond,
              array_to_string(list_concat(list_concat(string_split(p_name, ' ')[1:1], ['x']), string_split(p_name, ' ')[2:]), ' ') AS inserted, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n,
              sha256(p_name) AS sha, md5(p_brand) AS md5 FROM part""",
)
def array_and_hash(t: Tables) -> DataFrame:
    words = F.split("p_name", " ")
    return t.part.select(
        "p_partkey",
        F.array_join(F.array_sort(words), ",").alias("sorted"),
        F.get(words, F.lit(1)).alias("second"),
        F.get(words, F.lit(8)).alias("beyond"),
        F.array_join(F.array_insert(words, 2, F.lit("x")), " ").alias("inserted"),
        F.size(words).alias("n"),
        F.sha2("p_name", 256).alias("sha"),
        F.md5("p_brand").alias("md5"),
    )
