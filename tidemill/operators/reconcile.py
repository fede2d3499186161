"""Compare an output with a baseline, on the cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def schema_difference(actual: Sequence[str], expected: Sequence[str], case_sensitive: bool = False) -> list[str]:
    """Missing and extra columns, or a different order."""
    a, e = (list(actual), list(expected)) if case_sensitive else ([c.lower() for c in actual], [c.lower() for c in expected])
    faults = [f"missing column {c}" for c in e if c not in a] + [f"extra column {c}" for c in a if c not in e]
    return faults or ([] if a == e else [f"column order {a}, expected {e}"])


def key_columns(outputs: dict[str, Sequence[str]], name: str, columns: Sequence[str]) -> list[str]:
    """Declared keys of an output, else its first column."""
    declared = {k.lower(): v for k, v in outputs.items()}.get(name.lower())
    return list(declared) if declared else list(columns[:1])


def _text(c: Column) -> Column:
    """Trimmed lower text; a timestamp loses its T."""
    return F.regexp_replace(F.lower(F.trim(c.cast("string"))), "^(\\d{4}-\\d{2}-\\d{2})t", "$1 ")


def same_value(expected: Column, actual: Column, tolerance: float = 0.0) -> Column:
    """Equal values: null equals empty text, numbers within the tolerance, other text case-blind.

    A timestamp text matches when it begins with the actual value.
    """
    e, a = _text(expected), _text(actual)
    empty = (F.coalesce(e, F.lit("")) == "") & (F.coalesce(a, F.lit("")) == "")
    gap = F.abs(e.try_cast("double") - a.try_cast("double"))
    stamp = a.rlike("^\\d{4}-\\d{2}-\\d{2} ") & e.startswith(a)
    return empty | F.when(gap.isNotNull(), gap <= tolerance).otherwise(
        F.coalesce(e.eqNullSafe(a) | stamp, F.lit(False))
    )


def compare(actual: DataFrame, expected: DataFrame, keys: Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """Differences as rows (keys, column_name, expected, actual); empty when the frames agree.

    Keys must identify a row. A row only one side has is reported once, under
    the column name ``*``.
    """
    faults = schema_difference(actual.columns, expected.columns)
    if faults:
        raise ValueError("; ".join(faults))
    keys = [k.lower() for k in keys]
    columns = [c.lower() for c in expected.columns if c.lower() not in keys]
    side = lambda df, name: df.toDF(*[c.lower() for c in df.columns]).select(*keys, F.struct(F.lit(True).alias("__there"), *columns).alias(name))
    both = side(expected, "__e").join(side(actual, "__a"), keys, "full")
    e, a = (lambda c: F.col(f"__e.{c}")), (lambda c: F.col(f"__a.{c}"))
    line = lambda name, x, y: F.struct(
        F.lit(name).alias("column_name"), x.cast("string").alias("expected"), y.cast("string").alias("actual")
    )
    lone = F.col("__e").isNull() | F.col("__a").isNull()
    state = lambda s: F.when(F.col(s).isNull(), "absent").otherwise("present")
    cells = [F.when(~same_value(e(c), a(c), tolerance), line(c, e(c), a(c))) for c in columns]
    found = F.when(lone, F.array(line("*", state("__e"), state("__a")))).otherwise(F.array_compact(F.array(*cells)))
    return both.select(*keys, F.inline(found))


def write_baseline(df: DataFrame, path: str, single_file: bool = True) -> None:
    """One CSV file for a small baseline; parquet for a large one."""
    if single_file:
        df.coalesce(1).write.mode("overwrite").csv(path, header=True)
    else:
        df.write.mode("overwrite").parquet(path)
