"""Calendar tables, gap filling and periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.functions import dates
from tidemill.functions.columns import epoch_us


def calendar(span: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day between the two date columns of a one-row frame, with calendar fields."""
    days = span.select(F.explode(F.sequence(F.to_date(first), F.to_date(last))).alias("calendar_date"))
    d = F.col("calendar_date")
    year, month = F.year(d), F.month(d)
    return days.withColumns(
        {
            "day_of_calendar": dates.day_number(d),
            "day_of_week": F.dayofweek(d),
            "day_of_month": F.dayofmonth(d),
            "day_of_year": F.dayofyear(d),
            "month_of_year": month,
            "weekday_of_month": F.floor((F.dayofmonth(d) - 1) / 7).cast("int") + 1,
            "week_of_month": dates.week_since_sunday(F.dayofmonth(d), d),
            "week_of_year": dates.week_of_year(d),
            "week_of_calendar": dates.week_since_sunday(dates.day_number(d), d),
            "month_of_quarter": (month - 1) % 3 + 1,
            "month_of_calendar": month + 12 * (year - 1900),
            "quarter_of_year": F.quarter(d),
            "quarter_of_calendar": F.quarter(d) + 4 * (year - 1900),
            "year_of_calendar": year,
        }
    )


def with_iso_fields(days: DataFrame, column: str = "calendar_date") -> DataFrame:
    d = F.col(column)
    return days.withColumns(
        {
            "iso_year": dates.iso_year(d),
            "iso_week": F.weekofyear(d),
            "iso_year_begin": dates.iso_year_begin(d),
            "iso_year_end": dates.iso_year_end(d),
            "year_begin": F.trunc(d, "year"),
            "year_end": F.last_day(F.add_months(F.trunc(d, "year"), 11)),
            "weekday_from_jan_1": dates.weekday_from_january_first(d),
            "week_of_year_compatible": dates.week_of_year_compatible(d),
            "week_of_quarter": dates.week_of_quarter(d),
            "week_of_quarter_iso": dates.week_of_quarter_iso(d),
            "week_of_quarter_compatible": dates.week_of_quarter_compatible(d),
            "day_of_iso_month": dates.day_of_iso_month(d),
            "julian_day": dates.julian_day(d),
        }
    )


def fill_gaps(df: DataFrame, date: str, keys: Sequence[str], values: Sequence[str], end: str) -> DataFrame:
    """A row per day from the first date of each key to ``end``; values carry forward.

    Expects one row per key and day. A key has as many rows as there are days,
    so its window is bounded by the calendar.
    """
    spans = df.groupBy(*keys).agg(F.min(date).alias("__first"))
    days = spans.select(*keys, F.explode(F.sequence("__first", F.lit(end).cast("date"))).alias(date))
    w = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = days.join(df, [*keys, date], "left")
    return filled.select(*keys, date, *[F.last(v, ignorenulls=True).over(w).alias(v) for v in values])


# Unit -> (truncation name, step).
UNITS = {
    "second": ("second", "1 second"),
    "minute": ("minute", "1 minute"),
    "hour": ("hour", "1 hour"),
    "day": ("day", "1 day"),
    "week": ("week", "7 days"),
    "month": ("month", "1 month"),
    "quarter": ("quarter", "3 months"),
    "year": ("year", "1 year"),
}


#: Units that are listed inside coarser ones: the coarser unit, its step, and seconds of the unit.
COARSE = {"second": ("day", "1 day", 1), "minute": ("day", "1 day", 60), "hour": ("month", "1 month", 3600), "day": ("year", "1 year", 86400)}


def expand_period(df: DataFrame, begin: str, end: str, unit: str, anchor: str = "begin") -> DataFrame:
    """One row per unit that a half-open period touches, the first at the unit's own begin.

    ``anchor='begin'`` gives the begin of the unit, ``'end'`` its last
    millisecond. ``seq`` counts from 0. A period without length gives no row.
    """
    name, step = UNITS[unit]
    interval, moment = F.expr(f"interval {step}"), F.expr("interval 1 microsecond")
    first = F.date_trunc(name, F.col(begin).cast("timestamp")).cast("timestamp_ntz")
    stop = F.col(end).cast("timestamp_ntz") - moment
    if unit not in COARSE:
        slots = F.when(F.col(begin) < F.col(end), F.sequence(first, stop, interval))
        out = df.select("*", F.posexplode(slots).alias("seq", "unit_at"))
    else:
        # Two steps, so that no row holds all units of a long period: coarse units first, then the units inside each.
        outer, outer_step, length = COARSE[unit]
        whole = F.date_trunc(outer, first.cast("timestamp")).cast("timestamp_ntz")
        blocks = F.when(F.col(begin) < F.col(end), F.sequence(whole, stop, F.expr(f"interval {outer_step}")))
        out = df.withColumns({"__first": first, "__stop": stop}).withColumn("__block", F.explode(blocks))
        after = F.col("__block") + F.expr(f"interval {outer_step}") - moment
        out = out.withColumn("unit_at", F.explode(F.sequence(F.greatest("__first", "__block"), F.least("__stop", after), interval)))
        seq = F.call_function("div", epoch_us("unit_at") - epoch_us("__first"), F.lit(length * 1_000_000).cast("long")).cast("int")
        out = out.select(*df.columns, seq.alias("seq"), "unit_at")
    if anchor == "end":
        out = out.withColumn("unit_at", F.col("unit_at") + interval - F.expr("interval 1 millisecond"))
    return out


def overlaps(b1: Column, e1: Column, b2: Column, e2: Column) -> Column:
    """Half-open periods share a moment; null counts as no."""
    return F.coalesce(~((b1 >= e2) | (b2 >= e1)), F.lit(False))


def intersect_periods(df: DataFrame, keys: Sequence[str], begin: str, end: str) -> DataFrame:
    """Common part of all periods of a key; null when two are apart or one is null."""
    common = df.groupBy(*keys).agg(
        F.max(begin).alias("__b"),
        F.min(end).alias("__e"),
        F.count_if(F.col(begin).isNull() | F.col(end).isNull()).alias("__nulls"),
    )
    good = (F.col("__nulls") == 0) & (F.col("__b") < F.col("__e"))
    return common.select(*keys, F.when(good, F.col("__b")).alias(begin), F.when(good, F.col("__e")).alias(end))


def left_difference(b1: Column, e1: Column, b2: Column, e2: Column) -> Column:
    """Part of the first period before the second, null when there is none or they are apart."""
    return F.when(overlaps(b1, e1, b2, e2) & (b1 < b2), F.struct(b1.alias("b"), b2.alias("e")))


def right_difference(b1: Column, e1: Column, b2: Column, e2: Column) -> Column:
    return F.when(overlaps(b1, e1, b2, e2) & (e1 > e2), F.struct(e2.alias("b"), e1.alias("e")))


def parse_period(text: Column, separator: str = "*") -> Column:
    """``begin*end`` text to a struct of two timestamps."""
    at = lambda k: F.try_element_at(F.split(text, f"\\{separator}"), F.lit(k)).try_cast("timestamp_ntz")
    return F.struct(at(1).alias("begin"), at(2).alias("end"))
