"""Lookups, exclusion lists, source preference and other equi-joins.

No side is marked for broadcast: Spark broadcasts a side whose size, by
statistics or measured at run time, is below
``spark.sql.autoBroadcastJoinThreshold``, and sorts and splits skewed
partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def lookup_chain(facts: DataFrame, lookups: Sequence[tuple[DataFrame, str | list[str]]]) -> DataFrame:
    """Left joins of one dimension after the other; facts without a match stay."""
    return reduce(lambda df, lk: df.join(lk[0], lk[1], "left"), lookups, facts)


def full_outer(left: DataFrame, right: DataFrame, keys: list[str], defaults: dict[str, object]) -> DataFrame:
    """All keys of both sides, missing features take their default."""
    return left.join(right, keys, "full").na.fill(defaults)


def exclude_ids(df: DataFrame, key: str, lists: Sequence[DataFrame], constants: Sequence[object] = ()) -> DataFrame:
    """Rows whose key is on no list and is not one of the constants. A null key stays."""
    banned = reduce(DataFrame.union, [one.select(F.col(one.columns[0]).alias(key)) for one in lists]).distinct()
    kept = df.where(F.col(key).isNull() | ~F.col(key).isin(list(constants))) if constants else df
    return kept.join(banned, key, "left_anti")


def prefer(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of ``first``, and those of ``second`` whose key ``first`` lacks."""
    return first.unionByName(second.join(first.select(*keys), keys, "left_anti"))


def latest_snapshot(df: DataFrame, date: str | Column) -> DataFrame:
    """Rows of the newest load date."""
    at = F.col(date) if isinstance(date, str) else date
    return df.where(at == df.agg(F.max(at)).scalar())


def prune_by_prefix(df: DataFrame, other: DataFrame, column: str, other_column: str, length: int) -> DataFrame:
    """Rows whose key prefix occurs on the other side; the key list stays on the cluster."""
    prefix = F.substring(F.col(column).cast("string"), 1, length)
    wanted = other.select(F.substring(F.col(other_column).cast("string"), 1, length).alias("__prefix")).distinct()
    return df.withColumn("__prefix", prefix).join(wanted, "__prefix", "left_semi").drop("__prefix")


def with_group_total(df: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """Group totals next to every row.

    Aggregate and join back instead of a window: the sums are combined before
    the shuffle, and a key with a third of the rows is split by the join.
    """
    sums = df.groupBy(*keys).agg(*[v.alias(n) for n, v in totals.items()])
    return df.join(sums, keys)
