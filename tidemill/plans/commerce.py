"""E-commerce job: five outputs from five inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions.columns import dbl, money
from tidemill.functions.labels import first_match
from tidemill.operators.windows import top_by_rank
from tidemill.plans.registry import Tables, query


def with_returns(transactions: DataFrame, returns: DataFrame) -> DataFrame:
    """Net amount per transaction. Returns are summed first, so two of them do not double a sale."""
    back = returns.groupBy("transaction_id").agg(F.sum(money("return_amount")).alias("return_amount"))
    amount = money("transaction_amount")
    return transactions.join(back, "transaction_id", "left").select(
        "transaction_id",
        "customer_id",
        "transaction_date",
        amount.alias("amount"),
        F.coalesce("return_amount", F.lit(0).cast("decimal(18,2)")).alias("returned"),
    )


def daily_sales(transactions: DataFrame, returns: DataFrame) -> DataFrame:
    sales = with_returns(transactions, returns).groupBy(F.col("transaction_date").alias("sale_date"))
    return sales.agg(
        dbl(F.sum("amount")).alias("total_revenue"),
        F.count("transaction_id").alias("total_transactions"),
        dbl(F.sum("returned")).alias("total_returned_revenue"),
    )


def customer_value(customers: DataFrame, transactions: DataFrame, returns: DataFrame) -> DataFrame:
    spend = (
        with_returns(transactions, returns)
        .where("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(dbl(F.sum("amount")).alias("t"), dbl(F.sum(F.col("amount") - F.col("returned"))).alias("n"))
    )
    return customers.join(spend, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "country",
        F.coalesce("t", F.lit(0.0)).alias("total_spend"),
        F.coalesce("n", F.lit(0.0)).alias("net_spend"),
    )


def top_categories(transactions: DataFrame, products: DataFrame, k: int = 5) -> DataFrame:
    """Sales are counted per product first, so the catalog joins one row per product."""
    sold = transactions.groupBy("product_id").agg(F.count("transaction_id").alias("n"))
    counts = sold.join(products.select("product_id", "category"), "product_id").groupBy("category")
    return top_by_rank(counts.agg(F.sum("n").alias("total_sales_count")), "total_sales_count", k, "category_rank")


def foreign_transactions(transactions: DataFrame, rates: DataFrame, currency: str = "EUR") -> DataFrame:
    daily = rates.where(F.col("currency_code") == currency).select(
        F.col("rate_date").alias("transaction_date"), F.col("exchange_rate").cast("decimal(12,6)").alias("rate")
    )
    return transactions.join(daily, "transaction_date").select(
        "transaction_id",
        "transaction_date",
        dbl(F.round(money("transaction_amount") * F.col("rate"), 4)).alias("transaction_amount_usd"),
    )


def error_log(transactions: DataFrame, limit: float = 500) -> DataFrame:
    """High amounts and missing customers; a high amount hides a missing customer."""
    high = F.col("transaction_amount") > limit
    message = first_match([(high, f"High Value Transaction (>{limit:g})")], "Missing Customer ID")
    kept = transactions.where(high | F.col("customer_id").isNull())
    return kept.select("transaction_id", message.alias("error_message")).distinct()


def transactions_of(t: Tables) -> DataFrame:
    """Orders as transactions: the product is the order's least part, every 97th order lost its customer."""
    parts = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_partkey").alias("product_id"))
    return t.orders.join(parts, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_custkey")).alias("customer_id"),
        "product_id",
        F.to_date("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").alias("transaction_amount"),
    )


def returns_of(t: Tables) -> DataFrame:
    return t.lineitem.where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("transaction_id"), F.col("l_extendedprice").alias("return_amount")
    )


TXN_SQL = """t AS (SELECT o_orderkey AS transaction_id, CASE WHEN o_orderkey % 97 <> 0 THEN o_custkey END AS customer_id, product_id,
        CAST(o_orderdate AS DATE) AS transaction_date, CAST(o_totalprice AS DECIMAL(18,2)) AS amount
      FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS product_id FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey),
    r AS (SELECT l_orderkey AS transaction_id, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS ret FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
    n AS (SELECT t.*, coalesce(ret, 0) AS returned FROM t LEFT JOIN r ON t.transaction_id = r.transaction_id)"""


@query(
    "pipe_daily_sales",
    f"""WITH {TXN_SQL} SELECT transaction_date AS sale_date, CAST(sum(amount) AS DOUBLE) AS total_revenue, count(*) AS total_transactions,
               CAST(sum(returned) AS DOUBLE) AS total_returned_revenue FROM n GROUP BY 1""",
)
def pipe_daily_sales(t: Tables) -> DataFrame:
    return daily_sales(transactions_of(t), returns_of(t))


@query(
    "pipe_clv",
    f"""WITH {TXN_SQL}, s AS (SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS total, CAST(sum(amount - returned) AS DOUBLE) AS net FROM n GROUP BY 1)
        SELECT c_custkey AS customer_id, c_name AS customer_name, n_name AS country, coalesce(total, 0.0) AS total_spend, coalesce(net, 0.0) AS net_spend
        FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN s ON c_custkey = customer_id""",
)
def pipe_clv(t: Tables) -> DataFrame:
    customers = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), F.col("n_name").alias("country")
    )
    return customer_value(customers, transactions_of(t), returns_of(t))


@query(
    "pipe_top_categories",
    f"""WITH {TXN_SQL}, c AS (SELECT p_name AS category, count(*) AS total_sales_count FROM t JOIN part ON product_id = p_partkey GROUP BY 1)
        SELECT * FROM (SELECT *, CAST(rank() OVER (ORDER BY total_sales_count DESC) AS INTEGER) AS category_rank FROM c) WHERE category_rank <= 5""",
)
def pipe_top_categories(t: Tables) -> DataFrame:
    products = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("category"))
    return top_categories(transactions_of(t), products)


@query(
    "pipe_foreign",
    f"""WITH {TXN_SQL}, x AS (SELECT CAST(CAST(ts AS DATE) - INTERVAL 24 YEAR AS DATE) AS d,
               CAST(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 100 AS DECIMAL(12,6)) AS rate FROM events WHERE event_type = 'view' GROUP BY 1)
        SELECT transaction_id, transaction_date, CAST(round(amount * rate, 4) AS DOUBLE) AS transaction_amount_usd FROM t JOIN x ON transaction_date = d""",
)
def pipe_foreign(t: Tables) -> DataFrame:
    """Daily rates from event values; purchases stand for dollars, views for euros."""
    rates = (
        t.events.where("event_type IN ('purchase', 'view')")
        .groupBy(F.add_months(F.to_date("ts"), -288).alias("rate_date"), "event_type")
        .agg((dbl(F.sum(money("value"))) / F.count("*") / 100).alias("exchange_rate"))
        .withColumn("currency_code", F.when(F.col("event_type") == "view", "EUR").otherwise("USD"))
    )
    return foreign_transactions(transactions_of(t), rates)


@query(
    "pipe_error_log",
    f"""WITH {TXN_SQL} SELECT DISTINCT transaction_id, CASE WHEN amount > 490000 THEN 'High Value Transaction (>490000)' ELSE 'Missing Customer ID' END AS error_message
        FROM t WHERE amount > 490000 OR customer_id IS NULL""",
)
def pipe_error_log(t: Tables) -> DataFrame:
    return error_log(transactions_of(t), 490000)
