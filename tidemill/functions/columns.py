"""Small typed column helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: str | Column) -> Column:
    """Exact two-digit amount; sums of it do not depend on row order."""
    return as_col(c).cast("decimal(18,2)")


def dbl(c: str | Column) -> Column:
    return as_col(c).cast("double")


def rounded(c: str | Column, digits: int) -> Column:
    """Round half up on the decimal text, back to double."""
    return F.round(as_col(c).cast("decimal(24,8)"), digits).cast("double")


def month_label(c: str | Column) -> Column:
    return F.date_format(as_col(c), "yyyy-MM")


def position(c: str | Column, dtype: str) -> Column:
    """A double that grows with the column; used only to cut ranges.

    Values that share a position fall in one range, so a coarse position is
    safe. Nulls sort last.
    """
    col = as_col(c)
    if dtype == "date":
        p = F.unix_date(col).cast("double")
    elif dtype.startswith("timestamp"):
        seconds = F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
        p = F.unix_date(F.to_date(col)) + seconds / F.lit(86400.0)
    else:
        p = col.cast("double")
    return F.coalesce(p, F.lit(float("inf")))


def epoch_us(c: str | Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, or of a date's midnight."""
    day = F.unix_date(F.to_date(as_col(c))).cast("bigint")
    clock = (F.hour(as_col(c)) * 3600 + F.minute(as_col(c)) * 60).cast("bigint")
    second = (F.extract(F.lit("SECOND"), as_col(c)) * 1000000).cast("bigint")
    return (day * 86400 + clock) * 1000000 + second
