"""Customer ingest, order summary, store metrics, store ratings, trade enrichment and cross-stage report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.columns import dbl, money, month_label, rounded
from tidemill.functions.labels import quarter_label
from tidemill.operators import changes as cdc, columns as cols, joins, quality as dq
from tidemill.operators.aggregates import guarded_percent
from tidemill.plans.registry import Tables, query
from tidemill.session import scratch_path
from tidemill.sources.readers import date_bounded, read_csv
from tidemill.sources.versions import VersionedTable
from tidemill.sources.writers import write_csv

RUN = "2024-10-01 06:00:00"


def ingest_customers(raw: DataFrame) -> DataFrame:
    """Clean names, build the full name, stamp, drop rows without a key."""
    cleaned = raw.transform(cols.clean_strings(["first_name", "last_name"]))
    named = cleaned.withColumns(
        {
            "full_name": F.upper(F.concat_ws(" ", "first_name", "last_name")),
            "ingested_at": F.lit(RUN).cast("timestamp_ntz"),
        }
    )
    return named.transform(cols.drop_null_keys(["customer_id"]))


@query(
    "pipe_customer_ingest",
    """SELECT CAST(c_custkey AS BIGINT) AS customer_id, 'customer' AS first_name, split_part(c_name, '#', 2) AS last_name, c_acctbal AS credit_limit,
              'CUSTOMER ' || split_part(c_name, '#', 2) AS full_name, TIMESTAMP '2024-10-01 06:00:00' AS ingested_at FROM customer WHERE c_custkey % 50 <> 0""",
)
def pipe_customer_ingest(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customers-csv")
    feed = t.customer.select(
        F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")).alias("customer_id"),
        F.concat(F.lit("\t "), F.split_part("c_name", F.lit("#"), F.lit(1)), F.lit(" ")).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("c_acctbal").alias("credit_limit"),
    )
    feed = feed.withColumn("first_name", F.regexp_replace("first_name", "\t", " "))
    write_csv(feed, path)
    return ingest_customers(read_csv(t.spark, path, schema=feed.schema))


@query(
    "pipe_order_summary",
    """SELECT c_custkey AS customer_id, c_name AS full_name, count(*) AS total_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_order_amount, count(*) FILTER (WHERE o_orderstatus = 'F') AS completed_orders,
              TIMESTAMP '2024-10-01 06:00:00' AS created_at, TIMESTAMP '2024-10-01 06:00:00' AS updated_at, 'etl' AS created_by
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def pipe_order_summary(t: Tables) -> DataFrame:
    """Orders are summed per customer before the join, which then carries one row each."""
    sums = t.orders.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count("*").alias("total_orders"),
        dbl(F.sum(money("o_totalprice"))).alias("total_amount"),
        F.count_if(F.col("o_orderstatus") == "F").alias("completed_orders"),
    )
    names = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"))
    out = sums.join(names, "customer_id").withColumn("avg_order_amount", F.col("total_amount") / F.col("total_orders"))
    return out.transform(cols.audit_stamps(RUN, "etl"))


def store_daily(orders: DataFrame, stores: DataFrame) -> DataFrame:
    """Orders, revenue, mean value and customers per store and day."""
    daily = (
        orders.join(stores, "store_id")
        .groupBy("store_id", "store_name", "order_date")
        .agg(
            F.count("order_id").alias("order_count"),
            dbl(F.sum(money("order_total"))).alias("total_revenue"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )
    return daily.withColumns(
        {
            "avg_order_value": F.col("total_revenue") / F.col("order_count"),
            "revenue_per_customer": F.col("total_revenue") / F.col("unique_customers"),
        }
    )


def orders_by_store(t: Tables, orders: DataFrame) -> DataFrame:
    home = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("store_id"))
    return orders.join(home, "o_custkey").select(
        "store_id",
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("order_total"),
    )


@query(
    "pipe_store_metrics",
    """WITH d AS (SELECT n_nationkey AS store_id, n_name AS store_name, CAST(o_orderdate AS DATE) AS order_date, count(*) AS order_count,
            CAST(sum(CAST(CASE WHEN o_orderdate >= DATE '2001-05-01' THEN o_totalprice ELSE o_totalprice + 10 END AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue, count(DISTINCT o_custkey) AS unique_customers
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_orderdate >= DATE '2001-01-01' GROUP BY ALL)
       SELECT *, total_revenue / order_count AS avg_order_value, total_revenue / unique_customers AS revenue_per_customer FROM d""",
)
def pipe_store_metrics(t: Tables) -> DataFrame:
    """Daily metrics of a look-back window, laid over an earlier version of the table."""
    stores = t.nation.select(F.col("n_nationkey").alias("store_id"), F.col("n_name").alias("store_name"))
    window = date_bounded(t.orders, "o_orderdate", "2001-05-01", "2001-12-31")
    before = date_bounded(t.orders, "o_orderdate", "2001-01-01", "2001-12-31").withColumn(
        "o_totalprice", F.col("o_totalprice") + 10
    )
    table = store_daily(orders_by_store(t, before), stores)
    batch = store_daily(orders_by_store(t, window), stores)
    return cdc.upsert(table, batch, ["store_id", "order_date"])


#: First quarter of the window that the ratings job replaces.
KPI_WINDOW = "2001 Q1"


def stars(score: Column, cuts: list[Column], higher_is_better: bool) -> Column:
    """5 to 1 by four cuts, the best first; null for a null score."""
    reached = [score >= c if higher_is_better else score <= c for c in cuts]
    chain = F.when(score.isNull(), F.lit(None))
    for points, test in zip((5, 4, 3, 2), reached):
        chain = chain.when(test, points)
    return chain.otherwise(1).cast("int")


def kpi_ratings(info: DataFrame, responses: DataFrame, speed: DataFrame, accuracy: DataFrame, thresholds: DataFrame, min_responses: int = 30) -> DataFrame:
    """Star ratings per store and quarter.

    Months in which a store was closed are left out. A score with too few
    responses is marked; stores without a score keep a null star that counts 0.
    """
    keys = ["store_id", "quarter"]
    closed = info.where("temp_closure = 'Y'").select("store_id", "year_month").distinct()
    open_only = lambda df: df.join(closed, ["store_id", "year_month"], "left_anti")
    csat = open_only(responses).groupBy(*keys).agg(
        F.sum("total_responses").alias("n"), F.sum("positive_responses").alias("good"), F.sum("total_tickets").alias("tickets")
    )
    csat = csat.select(
        *keys,
        guarded_percent(F.col("good"), F.col("tickets")).alias("csat_score"),
        F.when(F.col("n") / 4 < min_responses, "Y").otherwise("N").alias("csat_penalty"),
    )
    sos = open_only(speed).groupBy(*keys).agg(F.sum("total_wait_seconds").alias("w"), F.sum("order_count").alias("n"))
    sos = sos.select(*keys, rounded(F.try_divide(dbl("w"), dbl("n")), 0).alias("avg_wait_seconds"))
    acc = open_only(accuracy).groupBy(*keys).agg(F.sum("inaccurate_orders").alias("bad"), F.sum("total_orders").alias("n"))
    acc = acc.select(*keys, guarded_percent(F.col("bad"), F.col("n")).alias("inaccuracy_rate"))
    stores = info.select("store_id", "region", "quarter").distinct()
    rated = joins.lookup_chain(stores, [(csat, keys), (sos, keys), (acc, keys), (thresholds, ["region", "quarter"])])
    cuts = lambda name: [F.col(f"{name}_{k}star") for k in (5, 4, 3, 2)]
    rated = rated.withColumns(
        {
            "csat_star": stars(F.col("csat_score"), cuts("csat"), True),
            "sos_star": stars(F.col("avg_wait_seconds"), cuts("sos"), False),
            "accuracy_star": stars(F.col("inaccuracy_rate"), cuts("accuracy"), False),
        }
    )
    weight = {"csat_star": 40, "sos_star": 35, "accuracy_star": 25}
    total = sum((F.coalesce(c, F.lit(0)) * w for c, w in weight.items()), F.lit(0))
    return rated.withColumn("overall_star", total / F.lit(100.0))


LINE_SQL = """l AS (SELECT l_suppkey AS store_id, year(l_shipdate) || ' Q' || quarter(l_shipdate) AS quarter, strftime(l_shipdate, '%Y-%m') AS ym, month(l_shipdate) AS m,
        l_returnflag AS f, l_linenumber AS ln, CAST(l_quantity AS BIGINT) AS q, s_nationkey % 5 AS region FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
    o AS (SELECT * FROM l WHERE store_id % 12 + 1 <> m),
    k AS (SELECT store_id, quarter, count(*) AS n, count(*) FILTER (WHERE f <> 'R') AS good, count(*) FILTER (WHERE f = 'R' AND ln > 2) AS tickets,
            sum(q) AS w, count(*) FILTER (WHERE f = 'A' AND ln = 1) AS bad FROM o GROUP BY ALL),
    s AS (SELECT DISTINCT store_id, quarter, CAST(region AS INTEGER) AS region FROM l),
    p AS (SELECT s.*, CASE WHEN n IS NULL THEN NULL WHEN tickets = 0 THEN 0.0 ELSE CAST(round(CAST(CAST(good AS DOUBLE) / tickets * 100 AS DECIMAL(24,8)), 4) AS DOUBLE) END AS csat,
            CASE WHEN n / 4 < 30 THEN 'Y' WHEN n IS NOT NULL THEN 'N' END AS penalty, CAST(round(CAST(CAST(w AS DOUBLE) / n AS DECIMAL(24,8)), 0) AS DOUBLE) AS wait,
            CAST(round(CAST(CAST(bad AS DOUBLE) / n * 100 AS DECIMAL(24,8)), 4) AS DOUBLE) AS inacc FROM s LEFT JOIN k ON s.store_id = k.store_id AND s.quarter = k.quarter),
    z AS (SELECT *, CAST(CASE WHEN csat IS NULL THEN NULL WHEN csat >= 300 + region THEN 5 WHEN csat >= 270 + region THEN 4 WHEN csat >= 240 + region THEN 3 WHEN csat >= 200 + region THEN 2 ELSE 1 END AS INTEGER) AS cs,
            CAST(CASE WHEN wait IS NULL THEN NULL WHEN wait <= 24 THEN 5 WHEN wait <= 25 THEN 4 WHEN wait <= 26 THEN 3 WHEN wait <= 27 + region THEN 2 ELSE 1 END AS INTEGER) AS ss,
            CAST(CASE WHEN inacc IS NULL THEN NULL WHEN inacc <= 3 THEN 5 WHEN inacc <= 4 THEN 4 WHEN inacc <= 5 THEN 3 WHEN inacc <= 6 THEN 2 ELSE 1 END AS INTEGER) AS ac FROM p)"""


@query(
    "pipe_kpi_stars",
    f"""WITH {LINE_SQL} SELECT store_id, quarter, region, csat AS csat_score, penalty AS csat_penalty, wait AS avg_wait_seconds, inacc AS inaccuracy_rate,
        cs AS csat_star, ss AS sos_star, ac AS accuracy_star, (coalesce(cs, 0) * 40 + coalesce(ss, 0) * 35 + coalesce(ac, 0) * 25) / 100 AS overall_star FROM z""",
)
def pipe_kpi_stars(t: Tables) -> DataFrame:
    """Suppliers as stores: flags as answers, quantities as waiting, first lines as errors."""
    home = t.supplier.select(F.col("s_suppkey").alias("store_id"), (F.col("s_nationkey") % 5).cast("int").alias("region"))
    lines = t.lineitem.select(
        F.col("l_suppkey").alias("store_id"),
        quarter_label(F.col("l_shipdate")).alias("quarter"),
        month_label("l_shipdate").alias("year_month"),
        F.month("l_shipdate").alias("m"),
        "l_returnflag",
        "l_linenumber",
        F.col("l_quantity").cast("bigint").alias("q"),
    )
    # One row per store and month carries every measure of the three feeds.
    monthly = lines.groupBy("store_id", "quarter", "year_month", "m").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("l_returnflag") != "R").alias("positive_responses"),
        F.count_if((F.col("l_returnflag") == "R") & (F.col("l_linenumber") > 2)).alias("total_tickets"),
        F.sum("q").alias("total_wait_seconds"),
        F.count_if((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 1)).alias("inaccurate_orders"),
    )
    monthly = monthly.withColumns({c: F.col("n") for c in ("total_responses", "order_count", "total_orders")})
    info = monthly.join(home, "store_id").withColumn(
        "temp_closure", F.when(F.col("store_id") % 12 + 1 == F.col("m"), "Y").otherwise("N")
    )
    r = F.col("region")
    cuts = {f"csat_{k}star": v + r for k, v in {5: 300, 4: 270, 3: 240, 2: 200}.items()}
    cuts |= {"sos_5star": F.lit(24), "sos_4star": F.lit(25), "sos_3star": F.lit(26), "sos_2star": 27 + r}
    cuts |= {f"accuracy_{k}star": F.lit(v) for k, v in {5: 3, 4: 4, 3: 5, 2: 6}.items()}
    thresholds = info.select("region", "quarter").distinct().withColumns(cuts)
    out = kpi_ratings(info, monthly, monthly, monthly, thresholds)
    names = ["store_id", "quarter", "region", "csat_score", "csat_penalty", "avg_wait_seconds", "inaccuracy_rate"]
    out = out.select(*names, "csat_star", "sos_star", "accuracy_star", "overall_star")
    table = VersionedTable(t.spark, scratch_path(t.spark, "kpi-stars"), part_by="quarter")
    table.publish(out)
    # The load of a look-back window: its quarters are replaced, the others stay as they are.
    table.replace_from(table.read().where(F.col("quarter") >= KPI_WINDOW), KPI_WINDOW)
    return table.read()


@query(
    "pipe_trade_enrich",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(coalesce(CASE WHEN l_linenumber <> 3 THEN l_discount END, 1.0) AS DECIMAL(12,4)), 2) AS DOUBLE) AS notional_usd,
              CASE l_returnflag WHEN 'N' THEN 'Purchase' WHEN 'R' THEN 'Sale' ELSE 'Other' END AS type_label, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS settlement_lag_days,
              CASE WHEN l_suppkey % 3 = 0 THEN 'Tier 1' WHEN l_suppkey % 3 = 1 THEN 'Internal' ELSE 'Unknown' END AS broker_tier, p_type AS asset_class, p_brand AS sector, n_name AS strategy
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def pipe_trade_enrich(t: Tables) -> DataFrame:
    """A chain of transforms with checks on columns and keys in between."""
    trades = t.lineitem.withColumns(
        {
            "fx": F.when(F.col("l_linenumber") != 3, F.col("l_discount")),
            "broker": F.when(F.col("l_suppkey") % 3 == 0, "First Bank").when(F.col("l_suppkey") % 3 == 1, "Internal").otherwise("n/a"),
        }
    )
    opened = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    assets = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("asset_class"), F.col("p_brand").alias("sector"))
    books = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("strategy")
    )
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    return (
        dq.columns_present(trades, [*keys, "l_returnflag"])
        .transform(lambda df: dq.no_nulls_in_flow(df, keys))
        .transform(cols.fill_column("fx", 1.0))
        .transform(cols.notional("l_quantity", "l_extendedprice", "fx", "notional_usd"))
        .transform(cols.value_label("l_returnflag", [("N", "Purchase"), ("R", "Sale")], "type_label", "Other"))
        .transform(cols.value_label("broker", [("First Bank", "Tier 1"), ("Internal", "Internal")], "broker_tier", "Unknown"))
        .transform(lambda df: joins.lookup_chain(df, [(opened, "l_orderkey"), (assets, "l_partkey"), (books, "l_suppkey")]))
        .transform(cols.date_lag("l_shipdate", "o_orderdate", "settlement_lag_days"))
        .transform(lambda df: dq.columns_present(df, ["notional_usd", "asset_class", "sector", "strategy"]))
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "notional_usd", "type_label", "settlement_lag_days",
            "broker_tier", "asset_class", "sector", "strategy",
        )
    )


@query(
    "pipe_cross_stage",
    """WITH g AS (SELECT p_type AS strategy, r_name AS area, l_returnflag AS txn_type, count(*) AS trades, count(DISTINCT l_suppkey) AS books,
              CAST(sum(CAST(l_quantity AS DECIMAL(12,2)) * CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS notional, CAST(max(l_shipdate) AS DATE) AS last_trade
         FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey
         LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)
       SELECT *, (SELECT count(*) FROM part) AS n_assets, (SELECT count(*) FROM supplier) AS n_books FROM g""",
)
def pipe_cross_stage(t: Tables) -> DataFrame:
    """Trades joined through every dimension, by strategy and area, next to the inventory counts."""
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("strategy"))
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    books = t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("r_name").alias("area")
    )
    trades = joins.lookup_chain(
        t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag", "l_quantity", "l_extendedprice", "l_shipdate"),
        [(part, "l_partkey"), (books, "l_suppkey")],
    )
    exact = F.col("l_quantity").cast("decimal(12,2)") * F.col("l_extendedprice").cast("decimal(12,2)")
    grouped = trades.groupBy("strategy", "area", F.col("l_returnflag").alias("txn_type")).agg(
        F.count("*").alias("trades"),
        F.count_distinct("l_suppkey").alias("books"),
        dbl(F.sum(exact)).alias("notional"),
        F.to_date(F.max("l_shipdate")).alias("last_trade"),
    )
    return grouped.withColumns(
        {"n_assets": t.part.agg(F.count("*")).scalar(), "n_books": t.supplier.agg(F.count("*")).scalar()}
    )
