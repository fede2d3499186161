"""Queries over projections, filters and derived columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions import labels
from tidemill.functions.columns import dbl, money
from tidemill.operators import columns as ops
from tidemill.operators.ordered import exact_quantiles
from tidemill.plans.registry import Tables, query

# Label maps the results must carry.
SEGMENT_LABELS = [("BUILDING", "Building Trade"), ("AUTOMOBILE", "Motor Trade"), ("MACHINERY", "Plant")]
PRIORITY_LABELS = [("1-URGENT", "Tier 1"), ("2-HIGH", "Tier 1"), ("3-MEDIUM", "Tier 2")]
TYPE_LABELS = [
    ("purchase", "Purchase"),
    ("click", "CALL"),
    ("view", "CALL"),
    ("signup", "VISIT"),
]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "proj_cast",
    """SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name AS customer_name,
              CAST(c_acctbal AS DECIMAL(18,2)) AS credit_limit, CAST(c_nationkey AS BIGINT) AS nation_id
       FROM customer""",
)
def proj_cast(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("account_id"),
        F.col("c_name").alias("customer_name"),
        money("c_acctbal").alias("credit_limit"),
        F.col("c_nationkey").cast("bigint").alias("nation_id"),
    )


@query(
    "filter_conjunction",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice IS NOT NULL""",
)
def filter_conjunction(t: Tables) -> DataFrame:
    return (
        t.orders.where(F.col("o_orderstatus") == "F")
        .where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
        .where(F.col("o_totalprice").isNotNull())
        .select("o_orderkey", "o_totalprice")
    )


@query(
    "dq_error_log",
    """WITH o AS (SELECT CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS cust, * FROM orders)
       SELECT DISTINCT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'High Value Transaction (>400000)'
                                        ELSE 'Missing Customer ID' END AS error_message
       FROM o WHERE o_totalprice > 400000 OR cust IS NULL""",
)
def error_log(t: Tables) -> DataFrame:
    orders = t.orders.withColumn("cust", F.when(F.col("o_orderkey") % 97 != 0, F.col("o_custkey")))
    high = F.col("o_totalprice") > 400000
    return (
        orders.where(high | F.col("cust").isNull())
        .withColumn("error_message", labels.first_match([(high, "High Value Transaction (>400000)")], "Missing Customer ID"))
        .select("o_orderkey", "error_message")
        .distinct()
    )


@query(
    "expr_notional",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate,
              CAST(round(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(12,2))
                         * CAST(1 + l_tax AS DECIMAL(12,4)), 2) AS DOUBLE) AS notional_usd
       FROM lineitem""",
)
def expr_notional(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("fx", 1 + F.col("l_tax"))
    return ops.notional("l_quantity", "l_extendedprice", "fx", "notional_usd")(lines).select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "notional_usd"
    )


@query(
    "expr_net_amount",
    """WITH r AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS ret
                  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
       SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) - coalesce(ret, 0) AS DOUBLE) AS net_amount
       FROM orders LEFT JOIN r ON o_orderkey = l_orderkey""",
)
def net_amount(t: Tables) -> DataFrame:
    returned = (
        t.lineitem.where(F.col("l_returnflag") == "R")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(money("l_extendedprice")).alias("ret"))
    )
    return t.orders.join(returned, "o_orderkey", "left").select(
        "o_orderkey", dbl(money("o_totalprice") - F.coalesce("ret", F.lit(0))).alias("net_amount")
    )


@query(
    "case_size_band",
    """SELECT event_id, CASE WHEN v IS NULL THEN 'unknown' WHEN v < 50 THEN 'small' WHEN v < 500 THEN 'medium'
                             ELSE 'large' END AS size_band
       FROM (SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN value END AS v FROM events)""",
)
def case_size_band(t: Tables) -> DataFrame:
    amount = F.when(F.col("event_id") % 11 != 0, F.col("value"))
    return t.events.select("event_id", labels.size_band(amount).alias("size_band"))


@query(
    "case_review_flag",
    """SELECT o_orderkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' AND o_totalprice > 3000 THEN 'REVIEW' ELSE 'OK' END AS flag
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def case_review_flag(t: Tables) -> DataFrame:
    kind = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "CREDIT")
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", labels.review_flag(kind, F.col("o_totalprice")).alias("flag"))


@query(
    "case_int_band",
    """SELECT p_partkey, CASE WHEN s < 18 THEN 'Under 18' WHEN s < 25 THEN '18-24' WHEN s < 35 THEN '25-34'
              WHEN s < 45 THEN '35-44' WHEN s < 55 THEN '45-54' WHEN s < 65 THEN '55-64' ELSE '65+' END AS band,
              CASE WHEN s IS NULL THEN 'n/a' WHEN s < 18 THEN 'Under 18' WHEN s < 25 THEN '18-24' WHEN s < 35 THEN '25-34'
              WHEN s < 45 THEN '35-44' WHEN s < 55 THEN '45-54' WHEN s < 65 THEN '55-64' ELSE '65+' END AS band_null_safe
       FROM (SELECT p_partkey, CASE WHEN p_partkey % 13 <> 0 THEN p_size * 2 END AS s FROM part)""",
)
def case_int_band(t: Tables) -> DataFrame:
    age = F.when(F.col("p_partkey") % 13 != 0, F.col("p_size") * 2)
    return t.part.select(
        "p_partkey",
        labels.age_band(age).alias("band"),
        labels.age_band(age, null_label="n/a").alias("band_null_safe"),
    )


@query(
    "case_recency",
    """SELECT o_orderkey, CASE WHEN d <= 7 THEN 'Last 7 days' WHEN d <= 30 THEN 'Last 30 days' WHEN d <= 90 THEN 'Last 90 days'
              WHEN d <= 365 THEN 'Last year' ELSE 'Older' END AS recency
       FROM (SELECT o_orderkey, DATE '2001-07-31' - CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def case_recency(t: Tables) -> DataFrame:
    as_of = F.lit("2001-07-31").cast("date")
    return t.orders.select("o_orderkey", labels.recency_band(F.col("o_orderdate"), as_of).alias("recency"))


@query(
    "period_quarter_label",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN year(o_orderdate) || ' Q' || quarter(o_orderdate) END AS time_period
       FROM orders""",
)
def period_quarter_label(t: Tables) -> DataFrame:
    date = F.when(F.col("o_orderkey") % 10 != 0, F.to_date("o_orderdate"))
    return t.orders.select("o_orderkey", labels.quarter_label(date).alias("time_period"))


@query(
    "period_classify",
    """SELECT o_orderkey, 'Q' || quarter(o_orderdate) AS calendar_quarter,
              CASE WHEN month(o_orderdate) <= 6 THEN 'H1' ELSE 'H2' END AS fiscal_half,
              CASE WHEN month(o_orderdate) <= 4 THEN 'R1' WHEN month(o_orderdate) <= 8 THEN 'R2' ELSE 'R3' END AS business_round,
              year(o_orderdate) || ' Q' || quarter(o_orderdate) AS period_label
       FROM orders""",
)
def period_classify(t: Tables) -> DataFrame:
    return ops.time_periods("o_orderdate")(t.orders).select(
        "o_orderkey", "calendar_quarter", "fiscal_half", "business_round", "period_label"
    )


@query(
    "map_value_label",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Building Trade' WHEN 'AUTOMOBILE' THEN 'Motor Trade'
              WHEN 'MACHINERY' THEN 'Plant' END AS segment_label FROM customer""",
)
def map_value_label(t: Tables) -> DataFrame:
    return ops.value_label("c_mktsegment", SEGMENT_LABELS, "segment_label")(t.customer).select("c_custkey", "segment_label")


@query(
    "map_label_default",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Tier 1' WHEN o_orderpriority = '3-MEDIUM' THEN 'Tier 2'
              WHEN o_orderpriority = '5-LOW' THEN 'Internal' ELSE 'Unknown' END AS tier FROM orders""",
)
def map_label_default(t: Tables) -> DataFrame:
    mapping = PRIORITY_LABELS + [("5-LOW", "Internal")]
    return ops.value_label("o_orderpriority", mapping, "tier", default="Unknown")(t.orders).select("o_orderkey", "tier")


@query(
    "map_type_label",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN 'Purchase' WHEN 'click' THEN 'CALL' WHEN 'view' THEN 'CALL'
              WHEN 'signup' THEN 'VISIT' ELSE 'Other' END AS type_label FROM events""",
)
def map_type_label(t: Tables) -> DataFrame:
    return ops.value_label("event_type", TYPE_LABELS, "type_label", default="Other")(t.events).select("event_id", "type_label")


@query(
    "case_tier",
    """SELECT c_custkey, CASE WHEN c_acctbal < 1000 THEN 'Tier 3' WHEN c_acctbal < 4000 THEN 'Tier 2'
              WHEN c_acctbal < 8000 THEN 'Tier 1' ELSE 'Tier 0' END AS aum_tier FROM customer""",
)
def case_tier(t: Tables) -> DataFrame:
    steps = [(1000, "Tier 3"), (4000, "Tier 2"), (8000, "Tier 1")]
    return t.customer.select("c_custkey", labels.tier(F.col("c_acctbal"), steps, "Tier 0").alias("aum_tier"))


@query(
    "cols_normalise",
    """SELECT p_partkey AS part_key, p_name AS part_name_text, p_retailprice AS retail_price_usd FROM part""",
)
def cols_normalise(t: Tables) -> DataFrame:
    awkward = t.part.select("p_partkey", "p_name", "p_retailprice").toDF(
        "Part Key", " Part/Name (text)", "Retail-Price (USD)"
    )
    return ops.normalise_names(awkward)


@query("cols_suffix_lower", "SELECT n_nationkey AS nationkey_src, n_name AS name_src FROM nation")
def cols_suffix_lower(t: Tables) -> DataFrame:
    upper = t.nation.select("n_nationkey", "n_name").toDF("NATIONKEY", "NAME")
    return upper.transform(ops.lower_names).transform(ops.suffix_names("_src"))


@query("cols_drop_audit", "SELECT s_suppkey, s_name FROM supplier")
def cols_drop_audit(t: Tables) -> DataFrame:
    stamped = t.supplier.select("s_suppkey", "s_name", F.lit(True).alias("__flag"), F.col("s_acctbal").alias("__was"))
    return ops.drop_audit(stamped)


EVENT_NULLS = """(SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type,
                         CASE WHEN event_id % 7 <> 0 THEN value END AS value,
                         CASE WHEN event_id % 3 <> 0 THEN user_id END AS user_id FROM events)"""


def events_with_nulls(t: Tables) -> DataFrame:
    """Events with nulls by rule, because the test tables hold none."""
    return t.events.select(
        "event_id",
        F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("event_type"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("user_id"),
    )


@query(
    "null_fill",
    f"""SELECT event_id, coalesce(event_type, '-') AS event_type, coalesce(value, 0.0) AS value,
               coalesce(user_id, -1) AS user_id FROM {EVENT_NULLS}""",
)
def null_fill(t: Tables) -> DataFrame:
    return (
        events_with_nulls(t)
        .transform(ops.fill_column("user_id", -1))
        .transform(ops.fill_strings("-"))
        .transform(ops.fill_numbers(0.0))
        .select("event_id", "event_type", "value", F.col("user_id").cast("bigint").alias("user_id"))
    )


@query("null_drop_keys", f"SELECT * FROM {EVENT_NULLS} WHERE user_id IS NOT NULL AND event_type IS NOT NULL")
def null_drop_keys(t: Tables) -> DataFrame:
    return events_with_nulls(t).transform(ops.drop_null_keys(["user_id", "event_type"]))


@query(
    "cast_type_map",
    """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, l_partkey, CAST(l_quantity AS INTEGER) AS l_quantity,
              CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, CAST(l_shipdate AS DATE) AS l_shipdate,
              TRY_CAST(l_returnflag AS INTEGER) AS l_returnflag FROM lineitem""",
)
def cast_type_map(t: Tables) -> DataFrame:
    rows = t.wide("lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag")
    return rows.transform(
        ops.impose_types(
            {
                "l_orderkey": "string",
                "l_quantity": "int",
                "l_extendedprice": "decimal(18,2)",
                "l_shipdate": "date",
                "l_returnflag": "int",
                "not_there": "int",
            }
        )
    )


@query(
    "dq_valid_reject",
    """WITH f AS (SELECT event_id, regexp_extract(props, '([0-9]+)', 1) || CASE WHEN event_id % 17 = 0 THEN 'x' ELSE '' END AS k,
                         CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN '2024-02-31' ELSE strftime(ts, '%Y-%m-%d') END AS day FROM events)
       SELECT event_id, TRY_CAST(k AS INTEGER) AS k, TRY_CAST(day AS DATE) AS day,
              nullif(concat_ws('; ', CASE WHEN TRY_CAST(k AS INTEGER) IS NULL THEN 'k unreadable' END,
                        CASE WHEN day IS NULL THEN 'day missing' WHEN TRY_CAST(day AS DATE) IS NULL THEN 'day unreadable' END), '') AS reason
       FROM f""",
)
def valid_reject(t: Tables) -> DataFrame:
    """Valid rows have no reason, rejected ones say which column failed."""
    spoilt = F.when(F.col("event_id") % 17 == 0, F.lit("x")).otherwise(F.lit(""))
    feed = t.wide("events", "event_id", "props", "ts").select(
        "event_id",
        F.concat(F.regexp_extract("props", "([0-9]+)", 1), spoilt).alias("k"),
        F.when(F.col("event_id") % 19 == 0, F.lit(None))
        .when(F.col("event_id") % 23 == 0, F.lit("2024-02-31"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("day"),
    )
    return ops.split_valid(feed, {"k": "int", "day": "date"}, ["k", "day"]).withColumnRenamed("__reason", "reason")


@query("ts_truncate", "SELECT event_id, date_trunc('hour', ts) AS ts FROM events")
def ts_truncate(t: Tables) -> DataFrame:
    return (
        t.events.select("event_id", "ts")
        .transform(ops.truncate_times(["ts", "absent"], "hour"))
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    )


@query("str_clean", "SELECT doc_id, lower(trim('  ' || source || ' ')) AS source, trim(lang || ' ') AS lang FROM documents")
def str_clean(t: Tables) -> DataFrame:
    padded = t.documents.select(
        "doc_id",
        F.concat(F.lit("  "), F.upper("source"), F.lit(" ")).alias("source"),
        F.concat("lang", F.lit(" ")).alias("lang"),
    )
    return padded.transform(ops.clean_strings(["source"])).transform(ops.trim_strings)


@query(
    "audit_stamp",
    """SELECT n_nationkey, TIMESTAMP '2024-10-01 06:00:00' AS created_at, TIMESTAMP '2024-10-01 06:00:00' AS updated_at,
              'etl' AS created_by FROM nation""",
)
def audit_stamp(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey").transform(ops.audit_stamps("2024-10-01 06:00:00", "etl"))


@query(
    "date_lag",
    """SELECT o_orderkey, min(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS min_lag,
              max(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE))) AS max_lag
       FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def date_lag(t: Tables) -> DataFrame:
    joined = t.orders.select("o_orderkey", "o_orderdate").join(
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate"), "o_orderkey"
    )
    lagged = joined.transform(ops.date_lag("l_shipdate", "o_orderdate", "lag"))
    return lagged.groupBy("o_orderkey").agg(
        F.min("lag").cast("bigint").alias("min_lag"), F.max("lag").cast("bigint").alias("max_lag")
    )


@query(
    "date_core",
    """SELECT o_orderkey, d AS txn_date, strftime(d, '%Y-%m') AS year_month, CAST(d + INTERVAL 1 MONTH AS DATE) AS one_month_later,
              'Q' || quarter(d) AS quarter, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
              CAST(date_trunc('month', d) AS DATE) AS month_start
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def date_core(t: Tables) -> DataFrame:
    return t.orders.transform(ops.date_parts("o_orderdate")).select(
        "o_orderkey", "txn_date", "year_month", "one_month_later", "quarter", "day_of_week", "day_name", "month_start"
    )


@query(
    "chain_transform",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'R' THEN 'Sale' WHEN 'N' THEN 'Purchase' ELSE 'Other' END AS flag_label,
              CAST(round(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(12,2))
                   * CAST(coalesce(CASE WHEN l_linenumber <> 3 THEN l_tax END, 1.0) AS DECIMAL(12,4)), 2) AS DOUBLE) AS notional_usd,
              date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS lag_days
       FROM lineitem""",
)
def chain_transform(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumns(
        {
            "fx": F.when(F.col("l_linenumber") != 3, F.col("l_tax")),
            "opened": F.lit("1995-01-01").cast("date"),
        }
    )
    return (
        lines.transform(ops.fill_column("fx", 1.0))
        .transform(ops.notional("l_quantity", "l_extendedprice", "fx", "notional_usd"))
        .transform(ops.value_label("l_returnflag", [("R", "Sale"), ("N", "Purchase")], "flag_label", "Other"))
        .transform(ops.date_lag("l_shipdate", "opened", "lag_days"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            "flag_label",
            "notional_usd",
            F.col("lag_days").cast("bigint").alias("lag_days"),
        )
    )


@query(
    "filter_regex_len",
    """SELECT p_partkey, p_name FROM part
       WHERE NOT regexp_matches(lower(p_name), 'widget|bolt') AND length(p_brand) IN (7, 8)""",
)
def filter_regex_len(t: Tables) -> DataFrame:
    return t.part.where(
        ~F.lower("p_name").rlike("widget|bolt") & F.length("p_brand").isin(7, 8)
    ).select("p_partkey", "p_name")


@query(
    "feat_winsorise",
    """SELECT o_orderkey, least(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.995) FROM orders)) AS clipped FROM orders""",
)
def winsorise(t: Tables) -> DataFrame:
    limit = exact_quantiles(t.orders, "o_totalprice", {"p995": 0.995})
    return t.orders.select("o_orderkey", F.least("o_totalprice", limit.scalar()).alias("clipped"))


@query(
    "feat_one_hot",
    "SELECT c_custkey, " + ", ".join(f"CAST(c_mktsegment = '{s}' AS INTEGER) AS {s.lower()}" for s in SEGMENTS) + " FROM customer",
)
def one_hot(t: Tables) -> DataFrame:
    return t.customer.transform(ops.one_hot("c_mktsegment", SEGMENTS)).select("c_custkey", *[s.lower() for s in SEGMENTS])


QUARTER_SUMS = ", ".join(
    f"sum(CASE WHEN quarter(o_orderdate) = {q} THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS q{q}" for q in (1, 2, 3, 4)
)


@query(
    "feat_rowwise",
    f"""WITH s AS (SELECT o_custkey, {QUARTER_SUMS} FROM orders GROUP BY 1),
        d AS (SELECT o_custkey, CAST(q1 AS DOUBLE) AS q1, CAST(q2 AS DOUBLE) AS q2, CAST(q3 AS DOUBLE) AS q3, CAST(q4 AS DOUBLE) AS q4 FROM s)
        SELECT o_custkey, greatest(q1, q2, q3, q4) AS max_q, (q1 + q2 + q3 + q4) / 4 AS mean_q,
               CASE WHEN q1 = 0 THEN 0.0 ELSE q4 / q1 END AS ratio, greatest((q4 - q1) * 12, 0.0) AS projected,
               CAST(q1 >= 500000 OR q2 >= 500000 AS INTEGER) AS over_limit,
               CASE WHEN trunc(q4) > trunc(q3 / 2) THEN 1 WHEN trunc(q4) < trunc(q3 / 2) THEN -1 ELSE 0 END AS growth
        FROM d""",
)
def rowwise(t: Tables) -> DataFrame:
    quarter = F.quarter("o_orderdate")
    sums = t.orders.groupBy("o_custkey").agg(
        *[dbl(F.sum(F.when(quarter == q, money("o_totalprice")).otherwise(F.lit(0)))).alias(f"q{q}") for q in (1, 2, 3, 4)]
    )
    q1, q2, q3, q4 = (F.col(f"q{q}") for q in (1, 2, 3, 4))
    return sums.select(
        "o_custkey",
        F.greatest(q1, q2, q3, q4).alias("max_q"),
        ((q1 + q2 + q3 + q4) / 4).alias("mean_q"),
        ops.safe_ratio(q4, q1).alias("ratio"),
        F.greatest((q4 - q1) * 12, F.lit(0.0)).alias("projected"),
        ((q1 >= 500000) | (q2 >= 500000)).cast("int").alias("over_limit"),
        ops.growth_sign(q4, q3 / 2).alias("growth"),
    )
