"""Labels and bands as ``when`` chains."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Bands and labels the results must carry.
AGE_BANDS = [(18, "Under 18"), (25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64")]
AGE_LAST = "65+"
RECENCY_BANDS = [(7, "Last 7 days"), (30, "Last 30 days"), (90, "Last 90 days"), (365, "Last year")]
RECENCY_LAST = "Older"


def first_match(cases: list[tuple[Column, object]], default: object = None) -> Column:
    """CASE WHEN over (condition, value) pairs in order."""
    if not cases:
        return F.lit(default).cast("string") if default is None else F.lit(default)
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, value)
    return chain.otherwise(F.lit(default))


def size_band(amount: Column) -> Column:
    return first_match([(amount.isNull(), "unknown"), (amount < 50, "small"), (amount < 500, "medium")], "large")


def review_flag(kind: Column, amount: Column) -> Column:
    """REVIEW for credit accounts above 3000; a null amount is OK."""
    return first_match([(F.coalesce((kind == "CREDIT") & (amount > 3000), F.lit(False)), "REVIEW")], "OK")


def age_band(age: Column, null_label: str = AGE_LAST) -> Column:
    return first_match([(age.isNull(), null_label)] + [(age < top, label) for top, label in AGE_BANDS], AGE_LAST)


def recency_band(date: Column, as_of: Column) -> Column:
    days = F.datediff(as_of, F.to_date(date))
    return first_match([(days <= top, label) for top, label in RECENCY_BANDS], RECENCY_LAST)


def tier(amount: Column, steps: list[tuple[float, str]], top: str) -> Column:
    """Label of the first threshold the amount stays below."""
    return first_match([(amount < limit, label) for limit, label in steps], top)


def value_label(value: Column, mapping: list[tuple[object, str]], default: str | None = None) -> Column:
    return first_match([(value == raw, label) for raw, label in mapping], default)


def quarter_label(date: Column) -> Column:
    """``2024 Q2``; null for a null date."""
    return F.concat(F.year(date).cast("string"), F.lit(" Q"), F.quarter(date).cast("string"))
