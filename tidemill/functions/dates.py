"""Calendar arithmetic as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

UNIX_EPOCH_JULIAN_DAY = 2440588


def day_number(date: Column) -> Column:
    """1 for 1900-01-01."""
    return F.datediff(date, F.lit("1900-01-01").cast("date")) + 1


def iso_weekday(date: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(date) + 1


def monday(date: Column) -> Column:
    return F.date_sub(date, F.weekday(date))


def week_since_sunday(day_in_unit: Column, date: Column) -> Column:
    """Week of a unit; weeks begin on Sunday and the days before the first Sunday are week 0."""
    return F.floor((day_in_unit - day_number(date) % 7 + 6) / 7).cast("int")


def week_of_year(date: Column) -> Column:
    return week_since_sunday(F.dayofyear(date), date)


def year_start(date: Column) -> Column:
    return F.trunc(date, "year")


def weekday_from_january_first(date: Column) -> Column:
    """1 on the weekday of 1 January, up to 7."""
    return F.pmod(F.weekday(date) - F.weekday(year_start(date)), F.lit(7)) + 1


def week_of_year_compatible(date: Column) -> Column:
    later = F.when(
        weekday_from_january_first(date) >= 5, F.date_add(date, iso_weekday(date) - 4)
    ).otherwise(F.date_add(date, 7 - iso_weekday(date)))
    return F.when(week_of_year(date) == 0, 1).otherwise(week_of_year(later))


def iso_year(date: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), date).cast("int")


def iso_year_begin(date: Column) -> Column:
    """Monday of the week that holds 4 January of the ISO year."""
    return monday(F.make_date(iso_year(date), F.lit(1), F.lit(4)))


def iso_year_end(date: Column) -> Column:
    return F.date_sub(monday(F.make_date(iso_year(date) + 1, F.lit(1), F.lit(4))), 1)


def week_of_quarter(date: Column) -> Column:
    """Monday boundaries since the quarter began; a Sunday counts one more."""
    weeks = F.floor(F.datediff(monday(date), monday(F.trunc(date, "quarter"))) / 7).cast("int")
    return F.when(F.weekday(date) == 6, weeks + 1).otherwise(weeks)


def week_of_quarter_iso(date: Column) -> Column:
    week = F.weekofyear(date)
    return F.when(week <= 13, week).when(week <= 26, week - 13).when(week <= 39, week - 26).otherwise(week - 39)


def week_of_quarter_compatible(date: Column) -> Column:
    return (F.floor(F.datediff(date, F.trunc(date, "quarter")) / 7) + 1).cast("int")


def iso_month_begin(first: Column) -> Column:
    """Monday of the week that holds the first Thursday of the month."""
    return F.date_add(monday(first), F.when(F.weekday(first) <= 3, 0).otherwise(7))


def day_of_iso_month(date: Column) -> Column:
    first = F.trunc(date, "month")
    starts = [iso_month_begin(F.add_months(first, k)) for k in (1, 0, -1)]
    begin = F.when(date >= starts[0], starts[0]).when(date >= starts[1], starts[1]).otherwise(starts[2])
    return F.datediff(date, begin) + 1


def julian_day(date: Column) -> Column:
    return F.unix_date(date) + UNIX_EPOCH_JULIAN_DAY


def business_days(start: Column, end: Column, holidays: Sequence[str] = ()) -> Column:
    """Weekdays in [start, end) without a loop: whole weeks and a rest on either side.

    Holidays are a short list of dates; those on a weekday are subtracted.
    """

    def before(date: Column) -> Column:
        n = F.unix_date(date) + 3  # days since a Monday
        return F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)), F.lit(5))

    count = before(end) - before(start)
    for day in holidays:
        h = F.lit(day).cast("date")
        count = count - F.when((h >= start) & (h < end) & (F.weekday(h) < 5), 1).otherwise(0)
    return F.when(start.isNull() | end.isNull(), F.lit(None)).when(start >= end, 0).otherwise(count).cast("int")
