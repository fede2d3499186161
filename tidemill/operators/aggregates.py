"""Group, pivot, rollup and profile operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from tidemill.functions.columns import dbl, rounded


def pivot_sum(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], measure: Column, names: dict[str, str]) -> DataFrame:
    """Sum of the measure per listed value; a group without the value gets 0."""
    wide = df.groupBy(*keys).pivot(column, list(values)).agg(dbl(F.sum(measure)))
    return wide.select(*keys, *[F.coalesce(F.col(f"`{v}`"), F.lit(0.0)).alias(names[v]) for v in values])


def pivot_table(df: DataFrame, keys: Sequence[str], column: str, aggregates: dict[str, Column], values: Sequence[str] | None = None) -> DataFrame:
    """Pivot with one column per (metric, value), named ``metric_value``.

    Without ``values`` a distinct pass finds them. More than
    ``spark.sql.pivotMaxValues`` of them are an error, as for Spark's own pivot.
    """
    if values is None:
        most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
        found = df.select(column).where(F.col(column).isNotNull()).distinct().take(most + 1)
        if len(found) > most:
            raise ValueError(f"{column} has more than {most} values; name those that are wanted")
        values = sorted(r[0] for r in found)
    wide = df.groupBy(*keys).pivot(column, list(values)).agg(*[a.alias(m) for m, a in aggregates.items()])
    one = len(aggregates) == 1
    return wide.select(
        *keys,
        *[
            F.col(f"`{v}`" if one else f"`{v}_{m}`").alias(f"{m}_{v}".lower())
            for m in aggregates
            for v in values
        ],
    )


def rollup_levels(df: DataFrame, levels: Sequence[str], aggregates: dict[str, Column], labels: Sequence[str]) -> DataFrame:
    """Subtotals at every level. The label comes from the grouping id, so a real null is no subtotal.

    ``labels`` runs from the grand total to the detail.
    """
    rolled = df.rollup(*levels).agg(*[a.alias(n) for n, a in aggregates.items()], F.grouping_id().alias("__gid"))
    level = F.when(F.col("__gid") == 0, labels[-1])
    for depth in range(len(levels)):
        level = level.when(F.col("__gid") == 2 ** (len(levels) - depth) - 1, labels[depth])
    return rolled.withColumn("level", level).drop("__gid")


def guarded_percent(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole in percent: null for a null whole, 0 for a zero whole."""
    return F.when(whole.isNull(), F.lit(None)).when(whole == 0, F.lit(0.0)).otherwise(
        rounded(dbl(part) / dbl(whole) * 100, digits)
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percent per column: one pass over the data, then a tiny unpivot."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    long = counts.unpivot(["__rows"], df.columns, "column_name", "null_count")
    share = rounded(F.col("null_count") * 100.0 / F.nullif("__rows", F.lit(0)), 1)
    return long.select("column_name", "null_count", F.coalesce(share, F.lit(0.0)).alias("null_pct"))


def describe_numbers(df: DataFrame, digits: int = 4) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum of every number column."""
    numbers = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
    stats = {
        "n": lambda c: F.count(c).cast("double"),
        "mean": lambda c: rounded(F.avg(c), digits),
        "stddev": lambda c: rounded(F.stddev(c), digits),
        "min": lambda c: dbl(F.min(c)),
        "max": lambda c: dbl(F.max(c)),
    }
    row = df.agg(*[fn(c).alias(f"{c}__{s}") for c in numbers for s, fn in stats.items()])
    parts = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{s}").alias(s) for s in stats])
            for c in numbers
        ]
    )
    return row.select(F.inline(parts))


def fold_status(statuses: Column, distinct: Column) -> Column:
    """The status all share, else in_progress."""
    return F.when(distinct == 1, statuses).otherwise(F.lit("in_progress"))
