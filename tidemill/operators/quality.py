"""Data-quality checks: schema checks without a job, row checks in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tidemill.functions.casting import is_date, is_number


class ValidationError(ValueError):
    """A frame does not meet a check."""


class ColumnError(ValidationError):
    """Columns are missing, unexpected or forbidden."""


class ValuesError(ValidationError):
    """Values break a rule."""


class SchemaError(ValidationError):
    """Types differ from the declared schema."""


def columns_present(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ColumnError(f"missing columns: {missing}")
    return df


def columns_exact(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    missing = sorted(set(expected) - set(df.columns))
    extra = sorted(set(df.columns) - set(expected))
    if missing or extra:
        raise ColumnError(f"missing columns: {missing}, unexpected columns: {extra}")
    return df


def columns_absent(df: DataFrame, forbidden: Sequence[str]) -> DataFrame:
    found = [c for c in forbidden if c in df.columns]
    if found:
        raise ColumnError(f"forbidden columns: {found}")
    return df


def schema_faults(df: DataFrame, schema: StructType) -> list[str]:
    """Missing fields and type mismatches, from the schema alone."""
    have = {f.name: f.dataType for f in df.schema}
    faults = [f"missing field {f.name}" for f in schema if f.name not in have]
    return faults + [
        f"{f.name} is {have[f.name].simpleString()}, expected {f.dataType.simpleString()}"
        for f in schema
        if f.name in have and have[f.name] != f.dataType
    ]


def conforms(df: DataFrame, schema: StructType) -> DataFrame:
    faults = schema_faults(df, schema)
    if faults:
        raise SchemaError("; ".join(faults))
    return df


def outside(column: str, low: object, high: object) -> Column:
    """True for a value out of the closed range; null passes."""
    return F.coalesce(~F.col(column).between(low, high), F.lit(False))


def not_allowed(column: str, values: Sequence[object]) -> Column:
    """True for a value not in the list; null passes."""
    return F.coalesce(~F.col(column).isin(list(values)), F.lit(False))


def bad_rate(column: str, low: float, high: float) -> Column:
    """True for a rate that is null or out of range."""
    return F.col(column).isNull() | outside(column, low, high)


def null_zero_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls and zeros of every column in one aggregate."""
    row = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in columns],
        *[F.count_if(F.col(c) == 0).alias(f"{c}__zeros") for c in columns],
    )
    parts = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__nulls").alias("nulls"), F.col(f"{c}__zeros").alias("zeros"))
        for c in columns
    ]
    return row.select(F.inline(F.array(*parts)))


def require_no_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise when any of the columns holds a null; one job for all of them."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    bad = {c: row[c] for c in columns if row[c]}
    if bad:
        raise ValuesError(f"nulls found: {bad}")
    return df


def no_nulls_in_flow(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself, whose job fails at the first null in any of the columns: the check costs no scan of its own."""
    checked = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"nulls found: {c}")).cast(df.schema[c].dataType)) for c in columns}
    return df.withColumns(checked)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@dataclass(frozen=True)
class Check:
    """A labelled row check: ``bad`` is true for a row that breaks it."""

    label: str
    bad: Column


def suite(df: DataFrame, checks: Sequence[Check], unique: dict[str, Sequence[str]] | None = None, schema: StructType | None = None) -> DataFrame:
    """Report (label, status, bad_rows). Row checks share one pass; a uniqueness check needs its own grouping."""
    row = df.agg(*[F.count_if(c.bad).alias(f"c{i}") for i, c in enumerate(checks)])
    line = lambda label, n: F.struct(F.lit(label).alias("label"), n.cast("bigint").alias("bad_rows"))
    report = row.select(F.inline(F.array(*[line(c.label, F.col(f"c{i}")) for i, c in enumerate(checks)])))
    for label, keys in (unique or {}).items():
        extra = duplicates(df, keys).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("bad_rows"))
        report = report.unionByName(extra.select(F.lit(label).alias("label"), "bad_rows"))
    if schema is not None:
        faults = len(schema_faults(df, schema))
        one = row.select(F.lit("schema").alias("label"), F.lit(faults).cast("bigint").alias("bad_rows"))
        report = report.unionByName(one)
    return report.withColumn("status", F.when(F.col("bad_rows") == 0, "passed").otherwise("failed"))


def parse_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many values of each text column read as a number or as a date."""
    tests = {"n_values": lambda c: F.col(c).isNotNull(), "n_numbers": lambda c: is_number(F.col(c)), "n_dates": lambda c: is_date(F.col(c))}
    row = df.agg(*[F.count_if(test(c)).alias(f"{c}__{n}") for c in columns for n, test in tests.items()])
    parts = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{n}").alias(n) for n in tests]) for c in columns
    ]
    return row.select(F.inline(F.array(*parts)))
