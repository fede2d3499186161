"""Queries over aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions.columns import dbl, money, month_label, rounded
from tidemill.operators import aggregates as agg
from tidemill.operators.joins import with_group_total
from tidemill.plans.columns import events_with_nulls
from tidemill.plans.registry import Tables, query
from tidemill.plans.scans import _name
from tidemill.plans.spend import MONTHLY_SPEND_SQL, accounts_of, monthly_spend, transactions_of

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "agg_group_multi",
    """SELECT o_custkey, c_name, c_mktsegment, c_nationkey, strftime(o_orderdate, '%Y-%m') AS ym, o_orderpriority,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean, max(o_totalprice) AS top
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def group_multi(t: Tables) -> DataFrame:
    """Six keys, of which the customer decides three: sum by the other three, then join them on."""
    sums = t.orders.groupBy("o_custkey", month_label("o_orderdate").alias("ym"), "o_orderpriority").agg(
        F.sum(money("o_totalprice")).alias("s"), F.count("*").alias("n"), F.max("o_totalprice").alias("top")
    )
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "c_nationkey")
    grouped = sums.join(who, "o_custkey")
    return grouped.withColumns({"total": dbl("s"), "mean": dbl("s") / F.col("n")}).drop("s")


@query(
    "agg_conditional",
    """SELECT l_suppkey, count(*) AS n_lines, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
              CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS returned_value,
              CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS open_value
       FROM lineitem GROUP BY 1""",
)
def conditional(t: Tables) -> DataFrame:
    price = money("l_extendedprice")
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        dbl(F.sum(F.when(F.col("l_returnflag") == "R", price).otherwise(0))).alias("returned_value"),
        dbl(F.sum(F.when(F.col("l_linestatus") == "O", price).otherwise(0))).alias("open_value"),
    )


@query(
    "agg_distinct",
    """SELECT l_suppkey, l_returnflag, count(*) AS n, count(DISTINCT l_partkey) AS n_parts,
              CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty FROM lineitem GROUP BY ALL""",
)
def distinct_count(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(
        F.count("*").alias("n"),
        F.count_distinct("l_partkey").alias("n_parts"),
        dbl(F.sum(money("l_quantity"))).alias("qty"),
    )


@query(
    "agg_collect_set",
    """SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderpriority)), ',') AS priorities,
              CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date, count(*) AS n
       FROM orders GROUP BY 1""",
)
def collect_set(t: Tables) -> DataFrame:
    """The set is bounded by the five priorities there are."""
    return t.orders.groupBy("o_custkey").agg(
        F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"),
        F.to_date(F.min("o_orderdate")).alias("first_date"),
        F.to_date(F.max("o_orderdate")).alias("last_date"),
        F.count("*").alias("n"),
    )


PIVOT_NAMES = {p: "p" + p[0] for p in PRIORITIES}


@query(
    "agg_pivot",
    "SELECT o_custkey, "
    + ", ".join(
        f"CAST(sum(CASE WHEN o_orderpriority = '{p}' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS {n}"
        for p, n in PIVOT_NAMES.items()
    )
    + " FROM orders GROUP BY 1",
)
def pivot(t: Tables) -> DataFrame:
    return agg.pivot_sum(t.orders, ["o_custkey"], "o_orderpriority", PRIORITIES, money("o_totalprice"), PIVOT_NAMES)


@query(
    "agg_pivot_mean",
    "SELECT user_id, "
    + ", ".join(
        f"nullif(count(*) FILTER (WHERE event_type = '{v}'), 0) AS n_{v}, "
        f"CAST(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = '{v}') AS DOUBLE) / "
        f"nullif(count(*) FILTER (WHERE event_type = '{v}'), 0) AS mean_{v}"
        for v in TYPES
    )
    + " FROM events GROUP BY 1",
)
def pivot_mean(t: Tables) -> DataFrame:
    amount = money("value")
    return agg.pivot_table(
        t.events,
        ["user_id"],
        "event_type",
        {"n": F.count(F.lit(1)), "mean": dbl(F.sum(amount)) / F.count(amount)},
    )


@query(
    "agg_rollup",
    """SELECT p_brand, l_returnflag, l_linestatus, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS n,
              CASE grouping_id(p_brand, l_returnflag, l_linestatus) WHEN 7 THEN 'Grand Total' WHEN 3 THEN 'Brand Subtotal'
                   WHEN 1 THEN 'Flag Subtotal' ELSE 'Detail' END AS level
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ROLLUP (p_brand, l_returnflag, l_linestatus)""",
)
def rollup(t: Tables) -> DataFrame:
    """Summed per part before the join and to the detail after it, so the rollup expands a few hundred rows."""
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    by_part = t.lineitem.groupBy("l_partkey", "l_returnflag", "l_linestatus").agg(
        F.sum(money("l_extendedprice")).alias("s"), F.count("*").alias("k")
    )
    detail = by_part.join(parts, "l_partkey").groupBy("p_brand", "l_returnflag", "l_linestatus").agg(
        F.sum("s").alias("s"), F.sum("k").alias("k")
    )
    return agg.rollup_levels(
        detail,
        ["p_brand", "l_returnflag", "l_linestatus"],
        {"total": dbl(F.sum("s")), "n": F.sum("k")},
        ["Grand Total", "Brand Subtotal", "Flag Subtotal", "Detail"],
    ).orderBy(
        F.col("p_brand").asc_nulls_last(), F.col("l_returnflag").asc_nulls_last(), F.col("l_linestatus").asc_nulls_last()
    )


@query(
    "agg_guarded_ratio",
    """WITH m AS (SELECT l_suppkey AS k, year(l_shipdate) || ' Q' || quarter(l_shipdate) AS q, strftime(l_shipdate, '%Y-%m') AS ym,
                    count(*) FILTER (WHERE l_returnflag <> 'R') AS good, count(*) FILTER (WHERE l_returnflag = 'R' AND l_linenumber > 3) AS tickets,
                    count(*) AS responses FROM lineitem GROUP BY ALL),
            s AS (SELECT *, sum(responses) OVER (PARTITION BY k, q) AS rq FROM m)
       SELECT k AS store_id, q AS quarter, ym AS year_month, CASE WHEN tickets = 0 THEN 0.0 ELSE
              CAST(round(CAST(CAST(good AS DOUBLE) / tickets * 100 AS DECIMAL(24,8)), 4) AS DOUBLE) END AS score,
              CASE WHEN rq / 4 < 30 THEN 'Y' ELSE 'N' END AS penalty FROM s""",
)
def guarded_ratio(t: Tables) -> DataFrame:
    keys = ["store_id", "quarter"]
    monthly = (
        t.lineitem.select(
            F.col("l_suppkey").alias("store_id"),
            F.concat(F.year("l_shipdate").cast("string"), F.lit(" Q"), F.quarter("l_shipdate").cast("string")).alias("quarter"),
            month_label("l_shipdate").alias("year_month"),
            (F.col("l_returnflag") == "R").alias("bad"),
            "l_linenumber",
        )
        .groupBy(*keys, "year_month")
        .agg(
            F.count_if(~F.col("bad")).alias("good"),
            F.count_if(F.col("bad") & (F.col("l_linenumber") > 3)).alias("tickets"),
            F.count("*").alias("responses"),
        )
    )
    totals = with_group_total(monthly, keys, {"responses_quarter": F.sum("responses")})
    return totals.select(
        *keys,
        "year_month",
        agg.guarded_percent(F.col("good"), F.col("tickets")).alias("score"),
        F.when(F.col("responses_quarter") / 4 < 30, "Y").otherwise("N").alias("penalty"),
    )


DAILY_SQL = """(SELECT c_nationkey AS store_id, CAST(o_orderdate AS DATE) AS day, count(*) AS n,
        sum(CAST(o_totalprice AS DECIMAL(18,2))) AS rev, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS mean,
        count(DISTINCT o_custkey) AS custs FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def store_orders(t: Tables) -> DataFrame:
    stores = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("store_id"))
    return t.orders.join(stores, "o_custkey").select(
        "store_id", F.to_date("o_orderdate").alias("day"), money("o_totalprice").alias("amount"), "o_custkey"
    )


def daily_store(t: Tables) -> DataFrame:
    return store_orders(t).groupBy("store_id", "day").agg(
        F.count("*").alias("n"),
        F.sum("amount").alias("rev"),
        (dbl(F.sum("amount")) / F.count("*")).alias("mean"),
        F.count_distinct("o_custkey").alias("custs"),
    )


@query(
    "agg_daily_monthly",
    f"""SELECT store_id, strftime(day, '%Y-%m') AS year_month, CAST(sum(n) AS BIGINT) AS order_count, CAST(sum(rev) AS DOUBLE) AS total_revenue,
               CAST(round(CAST(avg(mean) AS DECIMAL(24,8)), 2) AS DOUBLE) AS avg_order_value, CAST(sum(custs) AS BIGINT) AS customer_days
        FROM {DAILY_SQL} GROUP BY ALL""",
)
def daily_monthly(t: Tables) -> DataFrame:
    """Mean of daily means and sum of daily distinct counts, as the reports define them."""
    return daily_store(t).groupBy("store_id", month_label("day").alias("year_month")).agg(
        F.sum("n").alias("order_count"),
        dbl(F.sum("rev")).alias("total_revenue"),
        rounded(F.avg("mean"), 2).alias("avg_order_value"),
        F.sum("custs").alias("customer_days"),
    )


@query(
    "agg_daily_monthly_exact",
    """SELECT c_nationkey AS store_id, strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS order_count,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_order_value, count(DISTINCT o_custkey) AS unique_customers
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def daily_monthly_exact(t: Tables) -> DataFrame:
    """The exact mean and distinct count, from base rows."""
    return store_orders(t).groupBy("store_id", month_label("day").alias("year_month")).agg(
        F.count("*").alias("order_count"),
        (dbl(F.sum("amount")) / F.count("*")).alias("avg_order_value"),
        F.count_distinct("o_custkey").alias("unique_customers"),
    )


@query(
    "profile_nulls",
    """WITH e AS (SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type,
                         CASE WHEN event_id % 7 <> 0 THEN value END AS value, CASE WHEN event_id % 3 <> 0 THEN user_id END AS user_id FROM events),
            c AS (SELECT 'event_id' AS column_name, count(*) - count(event_id) AS null_count, count(*) AS n FROM e
                  UNION ALL SELECT 'event_type', count(*) - count(event_type), count(*) FROM e
                  UNION ALL SELECT 'value', count(*) - count(value), count(*) FROM e
                  UNION ALL SELECT 'user_id', count(*) - count(user_id), count(*) FROM e)
       SELECT column_name, null_count, CAST(round(CAST(null_count * 100.0 / n AS DECIMAL(24,8)), 1) AS DOUBLE) AS null_pct FROM c""",
)
def profile_nulls(t: Tables) -> DataFrame:
    return agg.null_profile(events_with_nulls(t))


@query(
    "profile_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(count({c}) AS DOUBLE) AS n, CAST(round(CAST(avg({c}) AS DECIMAL(24,8)), 4) AS DOUBLE) AS mean,
            CAST(round(CAST(stddev({c}) AS DECIMAL(24,8)), 4) AS DOUBLE) AS stddev, CAST(min({c}) AS DOUBLE) AS min,
            CAST(max({c}) AS DOUBLE) AS max FROM customer"""
        for c in ("c_custkey", "c_nationkey", "c_acctbal")
    ),
)
def profile_describe(t: Tables) -> DataFrame:
    return agg.describe_numbers(t.customer)


@query("agg_counts", "SELECT c_mktsegment, c_nationkey, count(*) AS n FROM customer GROUP BY ALL")
def counts(t: Tables) -> DataFrame:
    return t.customer.groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("n"))


@query(
    "agg_lookup_nunique",
    """SELECT l_suppkey, count(DISTINCT p_brand) AS n_brands FROM lineitem JOIN part ON l_partkey = p_partkey
       WHERE l_quantity > 0 GROUP BY 1""",
)
def lookup_nunique(t: Tables) -> DataFrame:
    """Pairs are made distinct before the lookup, so it joins far fewer rows."""
    pairs = t.lineitem.where("l_quantity > 0").select("l_suppkey", "l_partkey").distinct()
    brands = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return pairs.join(brands, "l_partkey").groupBy("l_suppkey").agg(F.count_distinct("p_brand").alias("n_brands"))


LEDGER_SQL = """ledger AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, l_returnflag, l_quantity, n_name AS manager, p_type AS strategy,
         CAST(round(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(12,2)), 2) AS DECIMAL(24,2)) AS notional
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey)"""


def ledger_view(t: Tables) -> str:
    """Temp view of lines with part, supplier and nation; the SQL reports read it."""
    view = _name("ledger")
    names = {n: f"{view}_{n}" for n in ("lineitem", "part", "supplier", "nation")}
    for table, name in names.items():
        getattr(t, table).createOrReplaceTempView(name)
    t.spark.sql(
        f"""SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, l_returnflag, l_quantity, n_name AS manager, p_type AS strategy,
                   CAST(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(24,2)) AS notional
            FROM {names['lineitem']} LEFT JOIN {names['part']} ON l_partkey = p_partkey
            LEFT JOIN {names['supplier']} ON l_suppkey = s_suppkey LEFT JOIN {names['nation']} ON s_nationkey = n_nationkey"""
    ).createOrReplaceTempView(view)
    return view


BOOK = """SELECT manager, strategy, count(DISTINCT l_suppkey) AS portfolios, count(*) AS trades,
          CAST(round(CAST(CAST(sum(notional) AS DOUBLE) / 1e6 AS DECIMAL(24,8)), 2) AS DOUBLE) AS notional_m_usd
          FROM {view} WHERE l_returnflag IN ('R', 'N') GROUP BY manager, strategy"""


@query("sql_book_of_business", f"WITH {LEDGER_SQL} {BOOK.format(view='ledger')}")
def book_of_business(t: Tables) -> DataFrame:
    return t.spark.sql(BOOK.format(view=ledger_view(t)))


ACTIVITY = """SELECT {month} AS year_month, count(*) AS trades, count(DISTINCT l_suppkey) AS active_portfolios,
              CAST(sum(CASE WHEN l_returnflag = 'N' THEN notional ELSE 0 END) AS DOUBLE) / 1e6 AS buy_m,
              CAST(sum(CASE WHEN l_returnflag = 'R' THEN notional ELSE 0 END) AS DOUBLE) / 1e6 AS sell_m
              FROM {view} GROUP BY 1"""


MONTH_SQL = "strftime(l_shipdate, '%Y-%m')"


@query("sql_monthly_activity", f"WITH {LEDGER_SQL} {ACTIVITY.format(view='ledger', month=MONTH_SQL)}")
def monthly_activity(t: Tables) -> DataFrame:
    return t.spark.sql(ACTIVITY.format(view=ledger_view(t), month="date_format(l_shipdate, 'yyyy-MM')"))


ASSETS = """SELECT l_partkey, l_returnflag, count(*) AS txn_count, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_shares,
            CAST(sum(notional) AS DOUBLE) AS total_notional, CAST(sum(notional) AS DOUBLE) / count(*) AS avg_notional
            FROM {view} WHERE l_returnflag IN ('R', 'N') GROUP BY l_partkey, l_returnflag"""


@query("sql_asset_summary", f"WITH {LEDGER_SQL} {ASSETS.format(view='ledger')}")
def asset_summary(t: Tables) -> DataFrame:
    return t.spark.sql(ASSETS.format(view=ledger_view(t)))


AUDIT = """
SELECT 'summary' AS part, CAST(NULL AS BIGINT) AS account_id, count(*) AS n_rows, count(DISTINCT account_id) AS n_accounts,
       count(DISTINCT year_month) AS n_months, CAST(sum(flagged_transactions) AS BIGINT) AS flagged, CAST(NULL AS DOUBLE) AS spend
FROM {view}
UNION ALL
SELECT * FROM (
  SELECT 'top', account_id, count(*), CAST(1 AS BIGINT), count(DISTINCT year_month), CAST(sum(flagged_transactions) AS BIGINT),
         CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) AS spend
  FROM {view} GROUP BY account_id ORDER BY spend DESC, account_id LIMIT 10) top_accounts
UNION ALL
SELECT * FROM (
  SELECT 'flagged', account_id, count(*), CAST(1 AS BIGINT), count(DISTINCT year_month), CAST(sum(flagged_transactions) AS BIGINT),
         CAST(sum(CAST(total_spend AS DECIMAL(18,2))) AS DOUBLE) AS spend
  FROM {view} WHERE flagged_transactions > 0 GROUP BY account_id ORDER BY spend DESC, account_id LIMIT 15) flagged_accounts
"""


@query("sql_result_audit", f"WITH spend AS ({MONTHLY_SPEND_SQL}) {AUDIT.format(view='spend')}")
def result_audit(t: Tables) -> DataFrame:
    """Audit of the monthly spend table: totals, the ten largest accounts, flagged accounts."""
    view = _name("spend")
    monthly_spend(accounts_of(t), transactions_of(t)).createOrReplaceTempView(view)
    return t.spark.sql(AUDIT.format(view=view))


@query(
    "agg_issue_by_code",
    """WITH e AS (SELECT event_type AS code, event_id, user_id AS file_id, CASE WHEN event_id % 4 <> 0 THEN props END AS description FROM events)
       SELECT code, count(*) AS occurrences, count(DISTINCT file_id) AS n_files,
              arg_min(description, event_id) FILTER (WHERE description IS NOT NULL) AS description FROM e GROUP BY 1""",
)
def issue_by_code(t: Tables) -> DataFrame:
    """Occurrences, affected files and the first text that is not empty.

    Affected files are counted, not collected: the list of a frequent code
    would grow without bound. ``issue_files`` gives it as rows.
    """
    issues = t.events.select(
        F.col("event_type").alias("code"),
        "event_id",
        F.col("user_id").alias("file_id"),
        F.when(F.col("event_id") % 4 != 0, F.col("props")).alias("description"),
    )
    return issues.groupBy("code").agg(
        F.count("*").alias("occurrences"),
        F.count_distinct("file_id").alias("n_files"),
        F.min_by("description", F.when(F.col("description").isNotNull(), F.col("event_id"))).alias("description"),
    )


@query("agg_issue_files", "SELECT DISTINCT event_type AS code, user_id AS file_id FROM events")
def issue_files(t: Tables) -> DataFrame:
    return t.events.select(F.col("event_type").alias("code"), F.col("user_id").alias("file_id")).distinct()


STATUS_SQL = """CASE WHEN value < 8 THEN 'pending' WHEN value < 30 THEN 'done' ELSE 'in_review' END"""


@query(
    "agg_status_fold",
    f"""WITH e AS (SELECT user_id AS f, event_type AS code, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS line, event_id, {STATUS_SQL} AS st FROM events),
        l AS (SELECT f, code, line, arg_max(st, (CAST(st <> 'pending' AS INTEGER), event_id)) AS st, count(*) AS n FROM e GROUP BY ALL),
        c AS (SELECT f, code, CASE WHEN count(DISTINCT st) = 1 THEN min(st) ELSE 'in_progress' END AS code_status, CAST(sum(n) AS BIGINT) AS occurrences FROM l GROUP BY ALL),
        g AS (SELECT f, CASE WHEN count(DISTINCT st) = 1 THEN min(st) ELSE 'in_progress' END AS file_status FROM l GROUP BY ALL)
        SELECT c.f AS file_id, code, code_status, occurrences, file_status FROM c JOIN g ON c.f = g.f""",
)
def status_fold(t: Tables) -> DataFrame:
    """Line status, then code status and file status, each folded from the level below."""
    status = F.when(F.col("value") < 8, "pending").when(F.col("value") < 30, "done").otherwise("in_review")
    issues = t.events.select(
        F.col("user_id").alias("file_id"),
        F.col("event_type").alias("code"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("line"),
        "event_id",
        status.alias("st"),
    )
    lines = issues.groupBy("file_id", "code", "line").agg(
        F.max_by("st", F.struct((F.col("st") != "pending").alias("settled"), "event_id")).alias("st"),
        F.count("*").alias("n"),
    )
    one = agg.fold_status(F.min("st"), F.count_distinct("st"))
    codes = lines.groupBy("file_id", "code").agg(one.alias("code_status"), F.sum("n").alias("occurrences"))
    files = lines.groupBy("file_id").agg(one.alias("file_status"))
    return codes.join(files, "file_id")


@query(
    "agg_typed_counts",
    "WITH d AS (SELECT user_id AS file_id, "
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{v}') AS n_{v}" for v in TYPES)
    + """, count(*) AS n_total FROM events GROUP BY 1),
       i AS (SELECT user_id AS file_id, count(*) AS n_issues FROM events WHERE value > 200 GROUP BY 1)
       SELECT d.*, coalesce(n_issues, 0) AS n_issues FROM d LEFT JOIN i ON d.file_id = i.file_id""",
)
def typed_counts(t: Tables) -> DataFrame:
    """Counts by type and of issues in one pass; the issue count needs no join."""
    return t.events.groupBy(F.col("user_id").alias("file_id")).agg(
        *[F.count_if(F.col("event_type") == v).alias(f"n_{v}") for v in TYPES],
        F.count("*").alias("n_total"),
        F.count_if(F.col("value") > 200).alias("n_issues"),
    )


@query(
    "agg_inventory",
    """SELECT coalesce(nullif(lang, 'es'), 'Unknown') AS technology, coalesce(source, '') AS extension, count(*) AS n_files,
              CAST(sum(n_chars) AS BIGINT) AS total_chars
       FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY ALL""",
)
def inventory(t: Tables) -> DataFrame:
    """Files and size by technology and extension; ignored documents are left out."""
    ignored = t.labels.where("toxic = 1").select("doc_id")
    kept = t.documents.select("doc_id", "lang", "source", "n_chars").join(ignored, "doc_id", "left_anti")
    return kept.groupBy(
        F.coalesce(F.nullif("lang", F.lit("es")), F.lit("Unknown")).alias("technology"),
        F.coalesce("source", F.lit("")).alias("extension"),
    ).agg(F.count("*").alias("n_files"), F.sum("n_chars").alias("total_chars"))
