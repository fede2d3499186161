"""Casts that turn bad text into null without paying for an exception per row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, StringType

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INTEGER = r"^\s*[+-]?\d+\s*$"
_DAY = r"^\s*[+-]?\d{4,7}(-\d{1,2}(-\d{1,2}([T ].*)?)?)?\s*$"
# What a text must look like before it is worth parsing.
SHAPES = {
    "tinyint": _INTEGER,
    "smallint": _INTEGER,
    "int": _INTEGER,
    "bigint": _INTEGER,
    "float": r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]?|[+-]?(?i:inf|infinity|nan))\s*$",
    "double": r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]?|[+-]?(?i:inf|infinity|nan))\s*$",
    "decimal": _NUMBER,
    "date": _DAY,
}


def safe_cast(c: Column, target: DataType | str, source: DataType) -> Column:
    """``try_cast``; a text is parsed only when it has the shape of the target.

    A failed parse raises and is caught inside Spark, which for a column of
    bad values costs far more than the look at its shape.
    """
    name = target if isinstance(target, str) else target.simpleString()
    shape = SHAPES.get(name.split("(")[0].lower())
    if shape is None or not isinstance(source, StringType):
        return c.try_cast(target)
    return F.when(c.rlike(shape), c.try_cast(target))


# The date formats a text may have, each with its shape.
DATE_FORMATS = {
    "yyyy/MM/dd": r"^\d{4}/\d{2}/\d{2}$",
    "M/dd/yyyy": r"^\d{1,2}/\d{2}/\d{4}$",
    "yyyy": r"^\d{4}$",
    "MM.dd.yyyy": r"^\d{2}\.\d{2}\.\d{4}$",
    "MM/yyyy/dd": r"^\d{2}/\d{4}/\d{2}$",
    "MM-dd-yyyy": r"^\d{2}-\d{2}-\d{4}$",
}


def is_number(c: Column) -> Column:
    return F.when(c.rlike(_NUMBER), c.try_cast("decimal(38,10)").isNotNull()).otherwise(F.lit(False))


def is_date(c: Column) -> Column:
    """True when the text reads as a date in one of the formats or as a timestamp."""
    known = F.when(F.lit(False), F.lit(None).cast("date"))
    for fmt, shape in DATE_FORMATS.items():
        known = known.when(c.rlike(shape), F.try_to_date(c, fmt))
    other = F.when(c.rlike(_DAY), c.try_cast("timestamp").cast("date"))
    return F.coalesce(known, other).isNotNull()
