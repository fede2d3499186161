"""Queries over calendars, periods and intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions import dates
from tidemill.functions.columns import dbl, money
from tidemill.operators import calendar as cal
from tidemill.plans.registry import Tables, query

SPAN_SQL = """days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d
    FROM (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders))"""


def order_span(t: Tables) -> DataFrame:
    return t.orders.agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))


@query(
    "cal_dimension",
    f"""WITH {SPAN_SQL}, n AS (SELECT *, date_diff('day', DATE '1900-01-01', d) + 1 AS k FROM days),
        o AS (SELECT CAST(o_orderdate AS DATE) AS od, count(*) AS n_orders FROM orders GROUP BY 1)
        SELECT d AS calendar_date, CAST(k AS INTEGER) AS day_of_calendar, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(day(d) AS INTEGER) AS day_of_month,
          CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(month(d) AS INTEGER) AS month_of_year, CAST((day(d) - 1) // 7 + 1 AS INTEGER) AS weekday_of_month,
          CAST((day(d) - k % 7 + 6) // 7 AS INTEGER) AS week_of_month, CAST((dayofyear(d) - k % 7 + 6) // 7 AS INTEGER) AS week_of_year,
          CAST((k - k % 7 + 6) // 7 AS INTEGER) AS week_of_calendar, CAST((month(d) - 1) % 3 + 1 AS INTEGER) AS month_of_quarter,
          CAST(month(d) + 12 * (year(d) - 1900) AS INTEGER) AS month_of_calendar, CAST(quarter(d) AS INTEGER) AS quarter_of_year,
          CAST(quarter(d) + 4 * (year(d) - 1900) AS INTEGER) AS quarter_of_calendar, CAST(year(d) AS INTEGER) AS year_of_calendar,
          coalesce(n_orders, 0) AS n_orders
        FROM n LEFT JOIN o ON d = od""",
)
def cal_dimension(t: Tables) -> DataFrame:
    """Calendar over the span of the orders, with the orders of each day."""
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("calendar_date")).agg(F.count("*").alias("n_orders"))
    days = cal.calendar(order_span(t), "a", "b")
    return days.join(per_day, "calendar_date", "left").na.fill(0, ["n_orders"])


@query(
    "cal_dimension_iso",
    f"""WITH {SPAN_SQL}, w AS (
          SELECT d, isodow(d) AS i, CAST(date_trunc('quarter', d) AS DATE) AS q, CAST(date_trunc('year', d) AS DATE) AS y,
                 isodow(CAST(date_trunc('year', d) AS DATE)) AS jan, weekofyear(d) AS iw, isoyear(d) AS iy,
                 make_date(isoyear(d), 1, 1) AS ij, make_date(isoyear(d), 12, 31) AS idec FROM days),
        m AS (SELECT *, CASE WHEN i = jan THEN 1 ELSE isodow(CAST(d - CAST(isodow(y - 1) AS INTEGER) AS DATE)) END AS dowc,
                 CASE WHEN isodow(CAST(date_trunc('month', d) AS DATE)) <= 4 THEN 0 ELSE 7 END AS s0 FROM w),
        f AS (SELECT *, CAST(date_trunc('month', d) AS DATE) AS f0, CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS f1,
                 CAST(date_trunc('month', d) - INTERVAL 1 MONTH AS DATE) AS fm FROM m),
        g AS (SELECT *, CAST(f0 - CAST(isodow(f0) AS INTEGER) + 1 + CASE WHEN isodow(f0) <= 4 THEN 0 ELSE 7 END AS DATE) AS g0,
                 CAST(f1 - CAST(isodow(f1) AS INTEGER) + 1 + CASE WHEN isodow(f1) <= 4 THEN 0 ELSE 7 END AS DATE) AS g1,
                 CAST(fm - CAST(isodow(fm) AS INTEGER) + 1 + CASE WHEN isodow(fm) <= 4 THEN 0 ELSE 7 END AS DATE) AS gm,
                 CAST(CASE WHEN dowc >= 5 THEN d + CAST(i - 4 AS INTEGER) ELSE d + CAST(7 - i AS INTEGER) END AS DATE) AS later FROM f)
        SELECT d AS calendar_date, CAST(iy AS INTEGER) AS iso_year, CAST(iw AS INTEGER) AS iso_week,
          CAST(CASE WHEN isodow(ij) >= 5 THEN ij + CAST(8 - isodow(ij) AS INTEGER) WHEN isodow(ij) >= 2 THEN ij + CAST(1 - isodow(ij) AS INTEGER) ELSE ij END AS DATE) AS iso_year_begin,
          CAST(CASE WHEN isodow(idec) <= 3 THEN idec - CAST(isodow(idec) AS INTEGER) WHEN isodow(idec) <= 6 THEN idec + CAST(7 - isodow(idec) AS INTEGER) ELSE idec END AS DATE) AS iso_year_end,
          y AS year_begin, make_date(year(d), 12, 31) AS year_end, CAST(dowc AS INTEGER) AS weekday_from_jan_1,
          CAST(CASE WHEN (dayofyear(d) - (date_diff('day', DATE '1900-01-01', d) + 1) % 7 + 6) // 7 = 0 THEN 1
               ELSE (dayofyear(later) - (date_diff('day', DATE '1900-01-01', later) + 1) % 7 + 6) // 7 END AS INTEGER) AS week_of_year_compatible,
          CAST(date_diff('day', date_trunc('week', q), date_trunc('week', d)) // 7 + CASE WHEN i = 7 THEN 1 ELSE 0 END AS INTEGER) AS week_of_quarter,
          CAST(CASE WHEN iw <= 13 THEN iw WHEN iw <= 26 THEN iw - 13 WHEN iw <= 39 THEN iw - 26 ELSE iw - 39 END AS INTEGER) AS week_of_quarter_iso,
          CAST(date_diff('day', q, d) // 7 + 1 AS INTEGER) AS week_of_quarter_compatible,
          CAST(date_diff('day', CASE WHEN d >= g1 THEN g1 WHEN d >= g0 THEN g0 ELSE gm END, d) + 1 AS INTEGER) AS day_of_iso_month,
          CAST(julian(d) AS INTEGER) AS julian_day
        FROM g""",
)
def cal_dimension_iso(t: Tables) -> DataFrame:
    days = order_span(t).select(F.explode(F.sequence(F.to_date("a"), F.to_date("b"))).alias("calendar_date"))
    return cal.with_iso_fields(days)


@query(
    "ts_gap_fill",
    """WITH s AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS v, count(*) AS n FROM events GROUP BY ALL),
            d AS (SELECT user_id, event_type, CAST(unnest(generate_series(min(day), DATE '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS day FROM s GROUP BY 1, 2)
       SELECT d.user_id, d.event_type, d.day, CAST(last_value(v IGNORE NULLS) OVER w AS DOUBLE) AS v, last_value(n IGNORE NULLS) OVER w AS n
       FROM d LEFT JOIN s ON d.user_id = s.user_id AND d.event_type = s.event_type AND d.day = s.day WINDOW w AS (PARTITION BY d.user_id, d.event_type ORDER BY d.day ROWS UNBOUNDED PRECEDING)""",
)
def gap_fill(t: Tables) -> DataFrame:
    series = t.events.groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(
        dbl(F.sum(money("value"))).alias("v"), F.count("*").alias("n")
    )
    return cal.fill_gaps(series, "day", ["user_id", "event_type"], ["v", "n"], "2024-02-05")


@query(
    "ts_business_days",
    """WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS s, CAST(l_shipdate AS DATE) AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
            u AS (SELECT DISTINCT s, e FROM p),
            c AS (SELECT s, e, CAST(len(list_filter(range(date_diff('day', DATE '1990-01-01', s), date_diff('day', DATE '1990-01-01', e)), lambda k: k % 7 < 5)) AS INTEGER) AS n FROM u)
       SELECT l_orderkey, l_linenumber, l_partkey, n AS biz_days FROM p JOIN c ON p.s = c.s AND p.e = c.e""",
)
def business_days(t: Tables) -> DataFrame:
    ordered = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.to_date("o_orderdate").alias("s"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("e"))
    return lines.join(ordered, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", dates.business_days(F.col("s"), F.col("e")).alias("biz_days")
    )


@query(
    "period_expand",
    """WITH p AS (SELECT o_custkey, min(o_orderdate) AS b, max(o_orderdate) AS e FROM orders GROUP BY 1),
            m AS (SELECT o_custkey, unnest(range(date_trunc('month', b), e, INTERVAL 1 MONTH)) AS unit_at FROM p WHERE b < e)
       SELECT o_custkey, unit_at, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY unit_at) - 1 AS INTEGER) AS seq FROM m""",
)
def period_expand(t: Tables) -> DataFrame:
    periods = t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("b"), F.max("o_orderdate").alias("e"))
    return cal.expand_period(periods, "b", "e", "month").select("o_custkey", "unit_at", "seq")


PERIODS = """(SELECT l_orderkey, CASE WHEN l_partkey % 37 <> 0 THEN l_shipdate END AS b,
                     l_shipdate + to_days(CAST(l_quantity * 40 AS INTEGER)) AS e FROM lineitem)"""


def line_periods(t: Tables) -> DataFrame:
    """A period per line: from shipping on, forty days per unit; some begins are unknown."""
    days = F.make_dt_interval((F.col("l_quantity") * 40).cast("int"))
    return t.lineitem.select(
        "l_orderkey",
        F.when(F.col("l_partkey") % 37 != 0, F.col("l_shipdate")).alias("b"),
        (F.col("l_shipdate") + days).alias("e"),
    )


@query(
    "period_intersect_agg",
    f"""SELECT l_orderkey, CASE WHEN ok THEN mb END AS b, CASE WHEN ok THEN me END AS e FROM (
        SELECT l_orderkey, max(b) AS mb, min(e) AS me, count(*) = count(b) AND max(b) < min(e) AS ok FROM {PERIODS} GROUP BY 1)""",
)
def period_intersect(t: Tables) -> DataFrame:
    return cal.intersect_periods(line_periods(t), ["l_orderkey"], "b", "e")


@query(
    "period_subtract",
    f"""WITH j AS (SELECT o_orderkey, o_orderdate AS b1, o_orderdate + INTERVAL 400 DAY AS e1, b AS b2, e AS e2
                   FROM orders JOIN {PERIODS} p ON o_orderkey = l_orderkey),
            x AS (SELECT *, coalesce(NOT (b1 >= e2 OR b2 >= e1), false) AS ov FROM j)
       SELECT o_orderkey, b2, CASE WHEN ov AND b1 < b2 THEN b1 END AS left_b, CASE WHEN ov AND b1 < b2 THEN b2 END AS left_e,
              CASE WHEN ov AND e1 > e2 THEN e2 END AS right_b, CASE WHEN ov AND e1 > e2 THEN e1 END AS right_e FROM x""",
)
def period_subtract(t: Tables) -> DataFrame:
    first = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderdate").alias("b1"),
        (F.col("o_orderdate") + F.expr("interval 400 days")).alias("e1"),
    )
    pairs = first.join(line_periods(t), "l_orderkey")
    ends = [F.col(c) for c in ("b1", "e1", "b", "e")]
    cut = pairs.withColumns({"left": cal.left_difference(*ends), "right": cal.right_difference(*ends)})
    return cut.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("b").alias("b2"),
        F.col("left.b").alias("left_b"),
        F.col("left.e").alias("left_e"),
        F.col("right.b").alias("right_b"),
        F.col("right.e").alias("right_e"),
    )


@query(
    "interval_arith",
    """WITH j AS (SELECT o_orderkey, o_orderdate, date_diff('second', o_orderdate, l_shipdate) AS lag FROM orders JOIN lineitem ON o_orderkey = l_orderkey),
            s AS (SELECT o_orderkey, any_value(o_orderdate) AS od, CAST(sum(lag) AS BIGINT) AS total FROM j GROUP BY 1)
       SELECT o_orderkey, total AS lag_seconds, od + to_seconds(total // 2 - CASE WHEN total < 0 AND total % 2 <> 0 THEN 1 ELSE 0 END) AS half_way,
              od + INTERVAL 3 MONTH - INTERVAL 36 HOUR AS due_at FROM s""",
)
def interval_arith(t: Tables) -> DataFrame:
    """Lags as intervals: subtract times, sum, halve, and add back; month and hour intervals."""
    shipped = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    lags = t.orders.select("o_orderkey", "o_orderdate").join(shipped, "o_orderkey")
    total = lags.groupBy("o_orderkey", "o_orderdate").agg(
        F.sum(F.col("l_shipdate") - F.col("o_orderdate")).alias("lag")
    )
    seconds = (
        F.extract(F.lit("DAY"), "lag") * 86400
        + F.extract(F.lit("HOUR"), "lag") * 3600
        + F.extract(F.lit("MINUTE"), "lag") * 60
        + F.extract(F.lit("SECOND"), "lag").cast("bigint")
    )
    return total.select(
        "o_orderkey",
        seconds.cast("bigint").alias("lag_seconds"),
        (F.col("o_orderdate") + F.col("lag") / 2).alias("half_way"),
        (F.col("o_orderdate") + F.make_ym_interval(months=F.lit(3)) - F.make_dt_interval(hours=F.lit(36))).alias("due_at"),
    )
