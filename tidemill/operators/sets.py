"""Unions and multiset comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_by_position(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union by position; raises when the types at a position differ."""
    if [f.dataType for f in first.schema] != [f.dataType for f in second.schema]:
        raise ValueError(f"schemas differ: {first.dtypes} and {second.dtypes}")
    return first.union(second)


def multiset_difference(left: DataFrame, right: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows that one side has more often than the other, with how much more often.

    Both sides are counted in one aggregation instead of two ``exceptAll``.
    ``surplus`` is positive for the left side and negative for the right.
    """
    columns = [c for c in left.columns if c not in ignore]
    tagged = left.select(*columns, F.lit(1).alias("__n")).unionByName(right.select(*columns, F.lit(-1).alias("__n")))
    return tagged.groupBy(*columns).agg(F.sum("__n").alias("surplus")).where("surplus <> 0")


def same_rows(left: DataFrame, right: DataFrame, ignore: Sequence[str] = ()) -> bool:
    return multiset_difference(left, right, ignore).isEmpty()
