"""Sales features per contact, each in one pass over the facts.

Windows are fixed by the anchor date, so they become conditional sums: the
facts are read once, partly summed before the shuffle, and a contact with a
third of all rows is one row per task.
"""

from __future__ import annotations

import calendar
import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.columns import dbl, money
from tidemill.functions.labels import first_match
from tidemill.operators.ordered import exact_quantiles
from tidemill.session import cut_lineage


def months_before(day: datetime.date, months: int) -> datetime.date:
    """Same day of an earlier month, or that month's last day."""
    index = day.year * 12 + day.month - 1 - months
    year, month = divmod(index, 12)
    return datetime.date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def month_end(day: datetime.date, back: int) -> datetime.date:
    """Last day of the month that lies ``back`` months earlier."""
    at = months_before(day, back)
    return at.replace(day=calendar.monthrange(at.year, at.month)[1])


def between(date: str, after: datetime.date | None, upto: datetime.date | None) -> Column:
    """after < date <= upto; either end may be open."""
    test = F.lit(True)
    if after is not None:
        test = test & (F.col(date) > F.lit(after))
    return test & (F.col(date) <= F.lit(upto)) if upto is not None else test


def conditional_sum(test: Column, value: Column) -> Column:
    return dbl(F.coalesce(F.sum(F.when(test, value)), F.lit(0)))


Span = tuple[datetime.date | None, datetime.date | None]


def segment_sums(df: DataFrame, key: str, date: str, sums: dict[str, Column], windows: dict[str, tuple[str, Span]]) -> DataFrame:
    """One row per key with a column per window: the sum named by it over after < date <= upto.

    The axis is cut at the ends of all windows, and the facts are summed once per key and
    segment, partly before the shuffle. A key then has at most one line per segment; what
    lies up to each end is summed from these lines, and a window is the difference at its
    two ends, however many windows there are and however they overlap. Rows without a date
    belong to no window; a window without any fact gives 0. Decimal sums are carried as
    whole numbers of their last digit and come out as doubles.
    """
    ends = sorted({e for _, span in windows.values() for e in span if e is not None})
    segment = sum(((F.col(date) > F.lit(e)).cast("int") for e in ends), F.lit(0))
    used = {source for source, _ in windows.values()}
    cells = df.where(F.col(date).isNotNull()).groupBy(key, segment.alias("__segment")).agg(*[v.alias(f"__{n}") for n, v in sums.items() if n in used])
    scale = {n: getattr(cells.schema[f"__{n}"].dataType, "scale", None) for n in used}
    cells = cells.withColumns({f"__{n}": (F.col(f"__{n}") * F.lit(10**d)).cast("long") for n, d in scale.items() if d is not None})
    place = {e: i for i, e in enumerate(ends)} | {None: len(ends)}
    marks = sorted({(source, place[e]) for source, (after, upto) in windows.values() for e in ({upto} if after is None else {upto, after})})
    upto_mark = [F.coalesce(F.sum(F.when(F.col("__segment") <= i, F.col(f"__{n}"))), F.lit(0)).alias(f"__{n}_{i}") for n, i in marks]
    lines = cells.groupBy(key).agg(*upto_mark)
    out = []
    for name, (source, (after, upto)) in windows.items():
        total = F.col(f"__{source}_{place[upto]}")
        total = total - F.col(f"__{source}_{place[after]}") if after is not None else total
        out.append((total if scale[source] is None else dbl(total) / F.lit(float(10 ** scale[source]))).alias(name))
    return lines.select(key, *out)


def trailing_spans(as_of: datetime.date) -> dict[str, Span]:
    """The last 3, 3 to 9, 12 and 12 to 24 months, bounds at month ends."""
    e = lambda k: month_end(as_of, k)
    return {"3mon": (e(3), None), "3_6mon": (e(9), e(3)), "12mon": (e(12), None), "12_24mon": (e(24), e(12))}


def average_spans(as_of: datetime.date, months: int) -> dict[int, Span]:
    """The months that end at each of the last eleven month ends."""
    return {k: (months_before(month_end(as_of, k), months), month_end(as_of, k)) for k in range(1, 12)}


def snapshot_spans(as_of: datetime.date, lags: Sequence[int]) -> dict[int, Span]:
    """The single months that end ``lag`` months back."""
    return {lag: (month_end(as_of, lag + 1), month_end(as_of, lag)) for lag in lags}


def trailing(as_of: datetime.date, date: str, value: str, prefix: str = "rollup") -> list[Column]:
    """Sums and counts of the last 3, 3 to 9, 12 and 12 to 24 months, bounds at month ends."""
    spans = trailing_spans(as_of)
    amount = money(value)
    sums = [conditional_sum(between(date, *span), amount).alias(f"{prefix}_{n}sales") for n, span in spans.items()]
    counts = [
        F.count_if(between(date, *spans[n]) & (F.col(value) >= 0)).alias(f"{prefix}_{n}freq") for n in ("3mon", "3_6mon", "12mon")
    ]
    return sums + counts


def slope(points: Sequence[Column]) -> Column:
    """Least-squares slope over x = 1, 2, ..: fixed weights, so a plain expression."""
    n = len(points)
    mean = (n + 1) / 2
    spread = sum((x - mean) ** 2 for x in range(1, n + 1))
    total = F.lit(0.0)
    for x, y in enumerate(points, start=1):
        total = total + F.lit((x - mean) / spread) * y
    return total


def projection(slope_: Column, mean: Column) -> Column:
    """A year ahead, never below 0."""
    return F.greatest((slope_ + mean) * 12, F.lit(0.0))


def snapshots(as_of: datetime.date, date: str, value: str, lags: Sequence[int], name: str) -> list[Column]:
    """Balance of the month that ends ``lag`` months back, as one column per lag."""
    return [
        conditional_sum(F.last_day(date) == F.lit(month_end(as_of, lag)), money(value)).alias(f"{name}_{lag}") for lag in lags
    ]


def months_over(df: DataFrame, key: str, date: str, value: str, after: datetime.date, limit: float, out: str) -> DataFrame:
    """How many months since ``after`` total at least the limit."""
    months = (
        df.where(F.col(date) > F.lit(after))
        .groupBy(key, F.date_format(date, "yyyy-MM").alias("__month"))
        .agg(F.sum(money(value)).alias("__total"))
    )
    return months.where(F.col("__total") >= limit).groupBy(key).agg(F.count("*").alias(out))


def net_segment(recent: Column, earlier: Column) -> Column:
    return first_match(
        [
            ((recent == 0) & (earlier == 0), "Holding Asset"),
            ((recent <= 0) & (earlier <= 0), "Redeeming"),
            ((recent > 0) & (earlier > 0), "Adding Asset"),
            (recent > earlier, "Recent Pickup"),
            (recent < earlier, "Recent Decline"),
        ],
        "Others",
    )


def momentum(short: Column, long: Column) -> Column:
    return first_match(
        [((short == 0) & (long == 0), "0"), (short * 4 > long, "Short Term Momentum"), (short * 4 < long, "Long Term Momentum")],
        "Consistent",
    )


def rfm(df: DataFrame, key: str, date: str, value: str, after: datetime.date, upto: datetime.date) -> DataFrame:
    """Recency, frequency, monetary and their tercile classes in the window (after, upto].

    The edges differ on purpose: a recency at the lower cut is 2, a frequency
    there is 1; a frequency at the upper cut is 2, a monetary value there 3.
    """
    each = cut_lineage(
        df.where(between(date, after, upto))
        .groupBy(key)
        .agg(F.max(date).alias("__last"), F.count(F.lit(1)).alias("frequency"), dbl(F.sum(money(value))).alias("monetary"))
        .select(key, F.datediff(F.lit(upto), "__last").alias("recency"), "frequency", "monetary")
    )
    cuts = exact_quantiles(each, ["recency", "frequency", "monetary"], {"lo": 0.333, "hi": 0.667}).first()
    r, f, m = F.col("recency"), F.col("frequency"), F.col("monetary")
    return each.withColumns(
        {
            "r_class": F.when(r < cuts["recency_lo"], 3).when(r < cuts["recency_hi"], 2).otherwise(1),
            "f_class": F.when(f <= cuts["frequency_lo"], 1).when(f <= cuts["frequency_hi"], 2).otherwise(3),
            "m_class": F.when(m <= cuts["monetary_lo"], 1).when(m < cuts["monetary_hi"], 2).otherwise(3),
        }
    ).withColumn("rfm", F.col("r_class") * 100 + F.col("f_class") * 10 + F.col("m_class"))


def rfm_halves(df: DataFrame, key: str, date: str, value: str, spans: dict[str, Span]) -> DataFrame:
    """``rfm`` of several windows in one pass over the facts: a class column per window, null without facts in it."""
    columns = []
    for name, (after, upto) in spans.items():
        test = between(date, after, upto)
        columns += [
            F.datediff(F.lit(upto), F.max(F.when(test, F.col(date)))).alias(f"recency_{name}"),
            F.nullif(F.count_if(test), F.lit(0)).alias(f"frequency_{name}"),
            dbl(F.sum(F.when(test, money(value)))).alias(f"monetary_{name}"),
        ]
    each = cut_lineage(df.groupBy(key).agg(*columns))
    cuts = exact_quantiles(each, [c for c in each.columns if c != key], {"lo": 0.333, "hi": 0.667}).first()
    out = []
    for name in spans:
        r, f, m = (F.col(f"{c}_{name}") for c in ("recency", "frequency", "monetary"))
        low, high = ([cuts[f"{c}_{name}_{side}"] for c in ("recency", "frequency", "monetary")] for side in ("lo", "hi"))
        classes = (
            F.when(r < low[0], 3).when(r < high[0], 2).otherwise(1) * 100
            + F.when(f <= low[1], 1).when(f <= high[1], 2).otherwise(3) * 10
            + F.when(m <= low[2], 1).when(m < high[2], 2).otherwise(3)
        )
        out.append(F.when(f.isNotNull(), classes).alias(name))
    return each.select(key, *out)


def rfm_movement(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Movement between two halves; a contact without a class counts as 111."""
    return movement(first.select(key, F.col("rfm").alias("rfm_f6")).join(second.select(key, F.col("rfm").alias("rfm_s6")), key, "full"))


def movement(both: DataFrame) -> DataFrame:
    """Adds the changes of each class from ``rfm_f6`` to ``rfm_s6`` and what they amount to; null classes become 111."""
    both = both.na.fill(111, ["rfm_f6", "rfm_s6"])
    digit = lambda c, d: F.floor(F.col(c) / d).cast("int") % 10
    moved = both.withColumns({n: digit("rfm_s6", d) - digit("rfm_f6", d) for n, d in (("r", 100), ("f", 10), ("m", 1))})
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    total = r + f + m
    label = first_match(
        [
            ((r >= 0) & (f >= 0) & (m >= 0) & (total > 0), "gained"),
            ((r <= 0) & (f <= 0) & (m <= 0) & (total < 0), "dropped"),
            ((r == 0) & (f == 0) & (m == 0), "stayed"),
            (total > 0, "marginally gained"),
            (total < 0, "marginally dropped"),
        ],
        "ambiguous",
    )
    return moved.withColumn("movement", label)
