"""Monthly spend per account: filter, band, join, flag, aggregate, windows, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemill.functions.columns import dbl, money, month_label, rounded
from tidemill.functions.labels import review_flag
from tidemill.operators.ordered import order_stats
from tidemill.plans.registry import Tables, query
from tidemill.session import scratch_path
from tidemill.sources.versions import VersionedTable

KEYS = ["account_id", "customer_name", "account_type", "credit_limit", "year_month", "merchant_category"]


def monthly_spend(accounts: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row per account, month and category.

    Transactions are summed before the join, so an account with a third of
    them is a few rows per task when it is shuffled. What is left is at most
    (months x categories) rows per account, so the windows by account stay
    small; the global rank has no such bound and is computed by ranges.
    """
    active = accounts.where(F.col("status") == "ACTIVE").select(
        "account_id", "customer_name", "account_type", dbl("credit_limit").alias("credit_limit")
    )
    spent = transactions.where(F.col("transaction_type").isin("DEBIT", "TRANSFER") & F.col("amount").isNotNull())
    amount = money("amount")
    sums = spent.groupBy(
        "account_id", month_label("transaction_date").alias("year_month"), "merchant_category"
    ).agg(
        F.sum(amount).alias("total_spend"),
        F.count("transaction_id").alias("transaction_count"),
        F.max(amount).alias("max_transaction_amount"),
        # counted as if the account were a credit account; the join decides
        F.count_if(review_flag(F.lit("CREDIT"), amount) == "REVIEW").alias("__review"),
    )
    flagged = F.when(F.col("account_type") == "CREDIT", F.col("__review")).otherwise(0)
    monthly = sums.join(active, "account_id").withColumn("flagged_transactions", flagged).drop("__review")
    by_account = Window.partitionBy("account_id").orderBy("year_month", "merchant_category")
    by_slice = Window.partitionBy("account_id", "merchant_category").orderBy("year_month")
    windows = monthly.withColumns(
        {
            "cumulative_spend": F.sum("total_spend").over(by_account.rowsBetween(Window.unboundedPreceding, 0)),
            "prev_month_spend": F.lag("total_spend").over(by_slice),
        }
    )
    ranked = order_stats(windows, "total_spend", descending=True, rank="spend_rank", settle=True)
    return ranked.select(
        *KEYS,
        dbl("total_spend").alias("total_spend"),
        "transaction_count",
        (dbl("total_spend") / F.col("transaction_count")).alias("avg_transaction_amount"),
        dbl("max_transaction_amount").alias("max_transaction_amount"),
        "flagged_transactions",
        dbl("cumulative_spend").alias("cumulative_spend"),
        F.col("spend_rank").cast("bigint").alias("spend_rank"),
        dbl("prev_month_spend").alias("prev_month_spend"),
        dbl(F.col("total_spend") - F.col("prev_month_spend")).alias("month_over_month_change"),
        rounded(F.try_divide(dbl("cumulative_spend"), F.col("credit_limit")) * 100, 2).alias(
            "credit_utilisation_pct"
        ),
    )


def accounts_of(t: Tables) -> DataFrame:
    """Customers read as accounts: HOUSEHOLD ones are credit accounts, one nation is frozen."""
    kind = F.when(F.col("c_mktsegment") == "HOUSEHOLD", "CREDIT").when(
        F.col("c_mktsegment") == "BUILDING", "SAVINGS"
    ).otherwise("CHECKING")
    return t.customer.select(
        F.col("c_custkey").alias("account_id"),
        F.col("c_name").alias("customer_name"),
        kind.alias("account_type"),
        F.when(F.col("c_nationkey") == 3, "FROZEN").otherwise("ACTIVE").alias("status"),
        F.col("c_acctbal").alias("credit_limit"),
    )


def transactions_of(t: Tables) -> DataFrame:
    """Orders read as card transactions."""
    kind = F.when(F.col("o_orderstatus") == "O", "DEBIT").when(
        F.col("o_orderstatus") == "F", "TRANSFER"
    ).otherwise("CREDIT")
    return t.orders.select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("account_id"),
        F.col("o_totalprice").alias("amount"),
        kind.alias("transaction_type"),
        F.to_date("o_orderdate").alias("transaction_date"),
        F.col("o_orderpriority").alias("merchant_category"),
    )


MONTHLY_SPEND_SQL = """
WITH acc AS (
  SELECT c_custkey AS account_id, c_name AS customer_name,
         CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'CREDIT' WHEN 'BUILDING' THEN 'SAVINGS' ELSE 'CHECKING' END AS account_type,
         c_acctbal AS credit_limit
  FROM customer WHERE c_nationkey <> 3),
m AS (
  SELECT account_id, customer_name, account_type, credit_limit,
         strftime(o_orderdate, '%Y-%m') AS year_month, o_orderpriority AS merchant_category,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS n,
         max(o_totalprice) AS mx,
         count(*) FILTER (WHERE account_type = 'CREDIT' AND o_totalprice > 3000) AS flagged
  FROM orders JOIN acc ON o_custkey = account_id
  WHERE o_orderstatus IN ('O', 'F')
  GROUP BY ALL),
w AS (
  SELECT *, sum(total) OVER (PARTITION BY account_id ORDER BY year_month, merchant_category
                             ROWS UNBOUNDED PRECEDING) AS cum,
         lag(total) OVER (PARTITION BY account_id, merchant_category ORDER BY year_month) AS prev,
         rank() OVER (ORDER BY total DESC) AS rk
  FROM m)
SELECT account_id, customer_name, account_type, credit_limit, year_month, merchant_category,
       CAST(total AS DOUBLE) AS total_spend, n AS transaction_count,
       CAST(total AS DOUBLE) / n AS avg_transaction_amount, mx AS max_transaction_amount,
       flagged AS flagged_transactions, CAST(cum AS DOUBLE) AS cumulative_spend, rk AS spend_rank,
       CAST(prev AS DOUBLE) AS prev_month_spend,
       CAST(total - prev AS DOUBLE) AS month_over_month_change,
       CAST(round(CAST(CAST(cum AS DOUBLE) / nullif(credit_limit, 0) * 100 AS DECIMAL(24,8)), 2) AS DOUBLE) AS credit_utilisation_pct
FROM w
"""


@query("pipe_monthly_spend", MONTHLY_SPEND_SQL)
def pipe_monthly_spend(t: Tables) -> DataFrame:
    """The job with its sink: the result is published, and what is returned is read back."""
    table = VersionedTable(t.spark, scratch_path(t.spark, "monthly-spend"))
    table.publish(monthly_spend(accounts_of(t), transactions_of(t)))
    return table.read()
