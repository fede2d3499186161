"""Window operators whose groups are bounded, and top-k.

The series functions expect one row per key and period: callers aggregate to
days or months first, so a group never exceeds the number of periods.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.functions.columns import rounded


def with_previous(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """Previous and next value, change and percent change within the key."""
    w = Window.partitionBy(*keys).orderBy(order)
    prev = F.lag(value).over(w)
    v = F.col(value)
    return df.withColumns({"prev_value": prev, "next_value": F.lead(value).over(w), "change": v - prev}).withColumn(
        "change_pct", percent_change(v, F.col("prev_value"))
    )


def percent_change(now: Column, before: Column, digits: int = 2) -> Column:
    """Null when there is no earlier value or it is zero."""
    ratio = F.try_divide((now - before).cast("double"), before.cast("double"))
    return rounded(ratio * 100, digits)


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def since_first(df: DataFrame, keys: Sequence[str], order: str, value: str) -> DataFrame:
    """First value of the key and the percent return since then."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("first_value", F.first(value).over(w)).withColumn(
        "return_pct", percent_change(F.col(value), F.col("first_value"))
    )


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest ``order`` per key, as an aggregate.

    Rows are reduced before the shuffle, so a frequent key costs one row per
    task instead of one large sort.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return best.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def top_by_rank(df: DataFrame, value: str, k: int, out: str) -> DataFrame:
    """Rows among the k best by rank, ties kept.

    The k-th best value comes from a top-k of bounded size. Fewer than k rows
    are better and are ranked in a window; all rows that tie with the k-th
    best share one rank, however many they are.
    """
    best = df.where(F.col(value).isNotNull()).select(value).orderBy(F.col(value).desc()).limit(k)
    kth = best.agg(F.min(value)).scalar()
    above = df.where(F.col(value) > kth).withColumn(out, F.rank().over(Window.orderBy(F.col(value).desc())))
    better = best.agg(F.count_if(F.col(value) > kth)).scalar()
    tied = df.where(F.col(value) == kth).withColumn(out, (better + 1).cast("int"))
    return above.unionByName(tied)
