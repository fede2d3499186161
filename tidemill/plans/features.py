"""Queries over sales features and scoring steps."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.functions.columns import dbl, money, rounded
from tidemill.operators import features as ft
from tidemill.operators.columns import growth_sign, safe_ratio
from tidemill.operators.ordered import exact_quantiles
from tidemill.plans.registry import Tables, query
from tidemill.session import cut_lineage

AS_OF = datetime.date(2001, 7, 31)
LAGS = [0, 3, 6, 9, 12, 15, 18, 21]
D = "CAST(o_orderdate AS DATE)"
AMT = "CAST(o_totalprice AS DECIMAL(18,2))"


def sales(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("cgi"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("sales"), "o_orderstatus"
    )


def _span(after: str | None, upto: str | None) -> str:
    parts = [f"{D} > DATE '{after}'"] if after else []
    parts += [f"{D} <= DATE '{upto}'"] if upto else []
    return " AND ".join(parts)


def _sum(after, upto, name: str) -> str:
    return f"CAST(coalesce(sum({AMT}) FILTER (WHERE {_span(after, upto)}), 0) AS DOUBLE) AS {name}"


E3, E9, E12, E24 = "2001-04-30", "2000-10-31", "2000-07-31", "1999-07-31"
TRAILING_SQL = ", ".join(
    [
        _sum(E3, None, "rollup_3monsales"),
        _sum(E9, E3, "rollup_3_6monsales"),
        _sum(E12, None, "rollup_12monsales"),
        _sum(E24, E12, "rollup_12_24monsales"),
        f"count(*) FILTER (WHERE {_span(E3, None)}) AS rollup_3monfreq",
        f"count(*) FILTER (WHERE {_span(E9, E3)}) AS rollup_3_6monfreq",
        f"count(*) FILTER (WHERE {_span(E12, None)}) AS rollup_12monfreq",
    ]
)


@query("feat_trailing", f"SELECT o_custkey AS cgi, {TRAILING_SQL} FROM orders GROUP BY 1")
def trailing(t: Tables) -> DataFrame:
    return sales(t).groupBy("cgi").agg(*ft.trailing(AS_OF, "date", "sales"))


ENDS = ["2001-06-30", "2001-05-31", "2001-04-30", "2001-03-31", "2001-02-28", "2001-01-31", "2000-12-31", "2000-11-30",
        "2000-10-31", "2000-09-30", "2000-08-31"]


def _average_sql(months: int, name: str, count: bool = False) -> str:
    parts = []
    for k, end in enumerate(ENDS, start=1):
        start = f"CAST(DATE '{end}' - INTERVAL {months} MONTH AS DATE)"
        where = f"{D} > {start} AND {D} <= DATE '{end}'"
        total = f"count(*) FILTER (WHERE {where})" if count else f"coalesce(sum({AMT}) FILTER (WHERE {where}), 0)"
        parts.append(f"CAST({total} AS DOUBLE) / {months} AS {name}_{k}")
    return ", ".join(parts)


AVERAGES_SQL = f"{_average_sql(12, 'avg12')}, {_average_sql(3, 'avg3')}, {_average_sql(12, 'freq12', True)}"


def measures() -> dict[str, Column]:
    """What is summed per segment: amounts, bookings of 0 or more, above 0 and of 0, and redemptions."""
    redeemed = F.when(F.col("o_orderstatus") == "F", -money("sales")).otherwise(0)
    tests = {"booked": F.col("sales") >= 0, "bought": F.col("sales") > 0, "nothing": F.col("sales") == 0}
    return {"sales": F.sum(money("sales")), "redeemed": F.sum(redeemed)} | {n: F.count_if(test) for n, test in tests.items()}


@query("feat_moving_avg", f"SELECT o_custkey AS cgi, {AVERAGES_SQL} FROM orders GROUP BY 1")
def moving_avg(t: Tables) -> DataFrame:
    """Averages of 12 and 3 months and of 12-month counts at eleven month ends: 33 windows from one sum per segment."""
    spans = {("avg12", "sales"): 12, ("avg3", "sales"): 3, ("freq12", "bought"): 12}
    windows = {f"{n}_{k}": (source, span) for (n, source), m in spans.items() for k, span in ft.average_spans(AS_OF, m).items()}
    wanted = {n: v for n, v in measures().items() if n in ("sales", "bought")}
    found = ft.segment_sums(sales(t), "cgi", "date", wanted, windows)
    return found.select("cgi", *[(dbl(F.col(f"{n}_{k}")) / m).alias(f"{n}_{k}") for (n, _), m in spans.items() for k in range(1, 12)])


SLOPE_SQL = f"""SELECT o_custkey AS cgi, {_average_sql(12, 'avg12')}, {_sum(E12, None, 's12')} FROM orders GROUP BY 1"""


@query(
    "feat_slope",
    f"""WITH b AS ({SLOPE_SQL}), l AS (SELECT cgi, s12 / 12 AS mean, unnest([{', '.join(f'avg12_{k}' for k in range(11, 0, -1))}, s12 / 12]) AS y, unnest(range(1, 13)) AS x FROM b),
        r AS (SELECT cgi, any_value(mean) AS mean, regr_slope(y, x) AS slope FROM l GROUP BY 1)
        SELECT cgi, CAST(round(CAST(slope AS DECIMAL(24,8)), 4) AS DOUBLE) AS sales_slope,
               CAST(round(CAST(greatest((slope + mean) * 12, 0.0) AS DECIMAL(24,8)), 2) AS DOUBLE) AS proj_sales FROM r""",
)
def slope(t: Tables) -> DataFrame:
    windows = {f"avg12_{k}": ("sales", span) for k, span in ft.average_spans(AS_OF, 12).items()}
    windows["s12"] = ("sales", (ft.month_end(AS_OF, 12), None))
    totals = ft.segment_sums(sales(t), "cgi", "date", {"sales": measures()["sales"]}, windows)
    base = totals.select("cgi", *[(dbl(F.col(n)) / 12).alias(n) for n in windows])
    mean = F.col("s12")
    rise = ft.slope([F.col(f"avg12_{k}") for k in range(11, 0, -1)] + [mean])
    return base.select(
        "cgi", rounded(rise, 4).alias("sales_slope"), rounded(ft.projection(rise, mean), 2).alias("proj_sales")
    )


@query(
    "agg_month_threshold",
    f"""SELECT o_custkey AS cgi, count(*) AS months_over FROM (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS m, sum({AMT}) AS s FROM orders
        WHERE {D} > DATE '{E12}' GROUP BY ALL) WHERE s >= 150000 GROUP BY 1""",
)
def month_threshold(t: Tables) -> DataFrame:
    return ft.months_over(sales(t), "cgi", "date", "sales", ft.month_end(AS_OF, 12), 150000, "months_over")


SNAP_ENDS = ["2001-07-31", "2001-04-30", "2001-01-31", "2000-10-31", "2000-07-31", "2000-04-30", "2000-01-31", "1999-10-31"]
SNAPSHOT_SQL = ", ".join(
    f"CAST(coalesce(sum({AMT}) FILTER (WHERE last_day({D}) = DATE '{end}'), 0) AS DOUBLE) AS aum_{lag}" for lag, end in zip(LAGS, SNAP_ENDS)
)


@query("feat_lag_snapshots", f"SELECT o_custkey AS cgi, {SNAPSHOT_SQL} FROM orders GROUP BY 1")
def lag_snapshots(t: Tables) -> DataFrame:
    return sales(t).groupBy("cgi").agg(*ft.snapshots(AS_OF, "date", "sales", LAGS, "aum"))


@query(
    "agg_terciles",
    """WITH c AS (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1)
       SELECT quantile_cont(CAST(n AS DOUBLE), 0.333) AS n_lo, quantile_cont(CAST(n AS DOUBLE), 0.667) AS n_hi,
              quantile_cont(total, 0.333) AS total_lo, quantile_cont(total, 0.667) AS total_hi FROM c""",
)
def terciles(t: Tables) -> DataFrame:
    each = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), dbl(F.sum(money("o_totalprice"))).alias("total"))
    return exact_quantiles(each, ["n", "total"], {"lo": 0.333, "hi": 0.667})


NET_SQL = f"""SELECT o_custkey AS cgi,
    CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN -{AMT} WHEN o_orderstatus = 'O' THEN {AMT} ELSE 0 END) FILTER (WHERE {D} > DATE '{E12}'), 0) AS DOUBLE) AS net12,
    CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN -{AMT} WHEN o_orderstatus = 'O' THEN {AMT} ELSE 0 END) FILTER (WHERE {_span(E24, E12)}), 0) AS DOUBLE) AS net24
    FROM orders GROUP BY 1"""
SEGMENT_SQL = """CASE WHEN net12 = 0 AND net24 = 0 THEN 'Holding Asset' WHEN net12 <= 0 AND net24 <= 0 THEN 'Redeeming' WHEN net12 > 0 AND net24 > 0 THEN 'Adding Asset'
    WHEN net12 > net24 THEN 'Recent Pickup' WHEN net12 < net24 THEN 'Recent Decline' ELSE 'Others' END"""


@query(
    "feat_net_segment",
    f"""SELECT cgi, net12, net24, {SEGMENT_SQL} AS segment, CASE WHEN net12 = 0 AND net24 = 0 THEN '0' WHEN net12 * 4 > net24 THEN 'Short Term Momentum'
               WHEN net12 * 4 < net24 THEN 'Long Term Momentum' ELSE 'Consistent' END AS momentum, CASE WHEN net12 > 0 THEN 'active' ELSE 'dormant' END AS state FROM ({NET_SQL})""",
)
def net_segment(t: Tables) -> DataFrame:
    """Finished orders count as redemptions, open ones as sales."""
    signed = F.when(F.col("o_orderstatus") == "F", -money("sales")).when(F.col("o_orderstatus") == "O", money("sales")).otherwise(0)
    e12, e24 = ft.month_end(AS_OF, 12), ft.month_end(AS_OF, 24)
    net = sales(t).groupBy("cgi").agg(
        ft.conditional_sum(ft.between("date", e12, None), signed).alias("net12"),
        ft.conditional_sum(ft.between("date", e24, e12), signed).alias("net24"),
    )
    n12, n24 = F.col("net12"), F.col("net24")
    return net.select(
        "cgi",
        "net12",
        "net24",
        ft.net_segment(n12, n24).alias("segment"),
        ft.momentum(n12, n24).alias("momentum"),
        F.when(n12 > 0, "active").otherwise("dormant").alias("state"),
    )


def _rfm_sql(after: str, upto: str) -> str:
    return f"""(WITH e AS (SELECT o_custkey AS cgi, CAST(date_diff('day', max({D}), DATE '{upto}') AS INTEGER) AS recency, count(*) AS frequency, CAST(sum({AMT}) AS DOUBLE) AS monetary
        FROM orders WHERE {_span(after, upto)} GROUP BY 1),
      q AS (SELECT quantile_cont(CAST(recency AS DOUBLE), [0.333, 0.667]) AS r, quantile_cont(CAST(frequency AS DOUBLE), [0.333, 0.667]) AS f, quantile_cont(monetary, [0.333, 0.667]) AS m FROM e)
      SELECT cgi, recency, frequency, monetary, CAST(CASE WHEN recency < r[1] THEN 3 WHEN recency < r[2] THEN 2 ELSE 1 END * 100 + CASE WHEN frequency <= f[1] THEN 1 WHEN frequency <= f[2] THEN 2 ELSE 3 END * 10
             + CASE WHEN monetary <= m[1] THEN 1 WHEN monetary < m[2] THEN 2 ELSE 3 END AS INTEGER) AS rfm FROM e, q)"""


@query("feat_rfm", f"SELECT * FROM {_rfm_sql('2001-01-31', '2001-07-31')}")
def rfm(t: Tables) -> DataFrame:
    out = ft.rfm(sales(t), "cgi", "date", "sales", ft.months_before(AS_OF, 6), AS_OF)
    return out.select("cgi", "recency", "frequency", "monetary", "rfm")


MOVEMENT_SQL = f"""WITH j AS (SELECT coalesce(a.cgi, b.cgi) AS cgi, coalesce(a.rfm, 111) AS rfm_f6, coalesce(b.rfm, 111) AS rfm_s6
        FROM {_rfm_sql('2000-07-31', '2001-01-31')} a FULL JOIN {_rfm_sql('2001-01-31', '2001-07-31')} b ON a.cgi = b.cgi),
    d AS (SELECT *, CAST(rfm_s6 // 100 - rfm_f6 // 100 AS INTEGER) AS r, CAST(rfm_s6 // 10 % 10 - rfm_f6 // 10 % 10 AS INTEGER) AS f, CAST(rfm_s6 % 10 - rfm_f6 % 10 AS INTEGER) AS m FROM j)
    SELECT cgi, rfm_f6, rfm_s6, r, f, m, CASE WHEN r >= 0 AND f >= 0 AND m >= 0 AND r + f + m > 0 THEN 'gained' WHEN r <= 0 AND f <= 0 AND m <= 0 AND r + f + m < 0 THEN 'dropped'
           WHEN r = 0 AND f = 0 AND m = 0 THEN 'stayed' WHEN r + f + m > 0 THEN 'marginally gained' WHEN r + f + m < 0 THEN 'marginally dropped' ELSE 'ambiguous' END AS movement FROM d"""


def movement_of(facts: DataFrame) -> DataFrame:
    """Classes of two half-years and the movement between them, for contacts with facts in either."""
    middle = ft.months_before(AS_OF, 6)
    halves = ft.rfm_halves(facts, "cgi", "date", "sales", {"rfm_f6": (ft.months_before(AS_OF, 12), middle), "rfm_s6": (middle, AS_OF)})
    return ft.movement(halves.where("rfm_f6 IS NOT NULL OR rfm_s6 IS NOT NULL"))


@query("feat_rfm_movement", MOVEMENT_SQL)
def rfm_movement(t: Tables) -> DataFrame:
    return movement_of(sales(t))


def lead_features(t: Tables) -> DataFrame:
    """Features per customer: sales, balances, activity, funds, RFM. The orders are scanned once, into a narrow copy."""
    day, price = F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("sales")
    facts = cut_lineage(t.orders.select("o_orderkey", F.col("o_custkey").alias("cgi"), day, price, "o_orderstatus"))
    limit = exact_quantiles(facts, "sales", {"p995": 0.995}).first()["p995"]
    clipped = facts.withColumn("sales", F.least("sales", F.lit(limit)))
    e12, e24 = ft.month_end(AS_OF, 12), ft.month_end(AS_OF, 24)
    spans = ft.trailing_spans(AS_OF)
    averages = {"avg12": ("sales", 12), "avg3": ("sales", 3), "freq12": ("bought", 12)}
    windows = {f"rollup_{n}sales": ("sales", span) for n, span in spans.items()}
    windows |= {f"rollup_{n}freq": ("booked", spans[n]) for n in ("3mon", "3_6mon", "12mon")}
    windows |= {f"aum_{lag}": ("sales", span) for lag, span in ft.snapshot_spans(AS_OF, LAGS).items()}
    windows |= {f"{n}_{k}": (source, span) for n, (source, m) in averages.items() for k, span in ft.average_spans(AS_OF, m).items()}
    windows |= {"rollup_12monredemptions": ("redeemed", (e12, None)), "rollup_12_24monredemptions": ("redeemed", (e24, e12))}
    windows["sales0_in12mon"] = ("nothing", (e12, None))
    totals = ft.segment_sums(clipped, "cgi", "date", measures(), windows)
    amounts = [n for n, (source, _) in windows.items() if source in ("sales", "redeemed")]
    base = totals.withColumns(
        {n: dbl(F.col(n)) for n in amounts}
    ).withColumns({f"{n}_{k}": dbl(F.col(f"{n}_{k}")) / m for n, (_, m) in averages.items() for k in range(1, 12)})
    c = F.col
    back = lambda name: [c(f"{name}_{k}") for k in range(11, 0, -1)]
    year, quarter = c("rollup_12monsales") / 12, c("rollup_3monsales") / 3
    aum = [c(f"aum_{lag}") for lag in LAGS]
    with_slopes = base.withColumns(
        {
            "aum_slope": ft.slope(aum[::-1]),
            "aum_qtrlyavg": sum(aum[1:], aum[0]) / len(aum),
            "last_12mon_monthly_avg_sales": year,
            "last_3mon_monthly_avg_sales": quarter,
            "last_12_month_freq_avg": c("rollup_12monfreq") / 12,
            "salesslope": ft.slope(back("avg12") + [year]),
            "salesslope_3mon": ft.slope(back("avg3") + [quarter]),
            "salesfreqslope": ft.slope(back("freq12") + [c("rollup_12monfreq") / 12]),
            "netsales12m": c("rollup_12monsales") + c("rollup_12monredemptions"),
            "netsales12_24m": c("rollup_12_24monsales") + c("rollup_12_24monredemptions"),
        }
    )
    shaped = with_slopes.withColumns(
        {
            "proj_sales": ft.projection(c("salesslope"), c("last_12mon_monthly_avg_sales")),
            "proj_sales_3mon": ft.projection(c("salesslope_3mon"), c("last_3mon_monthly_avg_sales")),
            "salesslope_byavg": safe_ratio(c("salesslope"), c("last_12mon_monthly_avg_sales")),
            "salesslope_byavg_3mon": safe_ratio(c("salesslope_3mon"), c("last_3mon_monthly_avg_sales")),
            "salesfreqslope_byavg": safe_ratio(c("salesfreqslope"), c("last_12_month_freq_avg")),
            "aumslope_byavg": F.when(c("aum_qtrlyavg") > 0, c("aum_slope") / c("aum_qtrlyavg")).otherwise(0.0),
            "prev_3monthsales": c("rollup_3_6monsales") / 3,
            "prev_3monthfreq": c("rollup_3_6monfreq") / 3,
            "avg_historical_12monsales": (c("rollup_12monsales") + c("rollup_12_24monsales")) / 2,
            "max_historical_12monsales": F.greatest("rollup_12monsales", "rollup_12_24monsales"),
            "max_aum_2years": F.greatest(*[f"aum_{lag}" for lag in LAGS]),
            "aum_gt_1m": (c("aum_0") >= 1000000).cast("int"),
            "sales_gt_100k_2years": ((c("rollup_12monsales") >= 100000) | (c("rollup_12_24monsales") >= 100000)).cast("int"),
            "sales_recent_freqgrowth": growth_sign(c("rollup_3monfreq"), c("rollup_3_6monfreq") / 2),
            "sales_recent_growth": growth_sign(c("rollup_3monsales"), c("rollup_3_6monsales") / 2),
            "nsales_segment": ft.net_segment(c("netsales12m"), c("netsales12_24m")),
            "active_dormant": F.when((c("rollup_12monsales") > 0) | (c("aum_0") > 0), "active").otherwise("dormant"),
            "last24msales": c("rollup_12monsales") + c("rollup_12_24monsales"),
            "last24mredemptions": c("rollup_12monredemptions") + c("rollup_12_24monredemptions"),
        }
    ).withColumn("momentum", ft.momentum(c("proj_sales_3mon"), c("proj_sales")))
    kind = F.when(c("event_type").isin("click", "view"), "CALL").when(c("event_type") == "signup", "VISIT")
    activity = t.events.groupBy(c("user_id").alias("cgi")).agg(
        F.count_if(kind == "CALL").alias("call_12m"), F.count_if(kind == "VISIT").alias("visit_12m")
    )
    recent = facts.where(c("date") > F.lit(e12)).select("o_orderkey", "cgi")
    brands = t.part.select(c("p_partkey").alias("l_partkey"), "p_brand")
    funds = (
        t.lineitem.select(c("l_orderkey").alias("o_orderkey"), "l_partkey")
        .join(recent, "o_orderkey")
        .select("cgi", "l_partkey")
        .distinct()
        .join(brands, "l_partkey")
        .groupBy("cgi")
        .agg(F.count_distinct("p_brand").alias("num_funds_sales"))
    )
    months = ft.months_over(clipped, "cgi", "date", "sales", e12, 1000, "salesgt1000")
    moves = movement_of(facts).select("cgi", "rfm_f6", "rfm_s6", c("r").alias("r_move"), c("f").alias("f_move"), c("m").alias("m_move"), "movement")
    contacts = t.customer.select(c("c_custkey").alias("cgi"))
    joined = contacts
    for part in (shaped, activity, funds, months, moves):
        joined = joined.join(part, "cgi", "left")
    return (
        joined.withColumn("total_activity", F.coalesce(c("call_12m") + c("visit_12m"), F.lit(0)))
        .na.fill({"movement": "ambiguous", "rfm_f6": 111, "rfm_s6": 111, "nsales_segment": "Holding Asset", "momentum": "0", "active_dormant": "dormant"})
        .na.fill(0)
    )


def _filled(expression: str, name: str) -> str:
    return f"coalesce({expression}, 0) AS {name}"


def _rounded(expression: str, digits: int, name: str) -> str:
    return f"coalesce(CAST(round(CAST({expression} AS DECIMAL(24,8)), {digits}) AS DOUBLE), 0.0) AS {name}"


def _sign(recent: str, past: str) -> str:
    return f"CAST(CASE WHEN trunc({recent}) > trunc({past}) THEN 1 WHEN trunc({recent}) < trunc({past}) THEN -1 ELSE 0 END AS INTEGER)"


PROJ, PROJ3 = "greatest((slope + rollup_12monsales / 12) * 12, 0.0)", "greatest((slope3 + rollup_3monsales / 3) * 12, 0.0)"
AUM_MEAN = f"(({' + '.join(f'aum_{k}' for k in LAGS)}) / 8)"
#: Columns that are divided by a trend or come out of one are compared after rounding.
TRENDS = {
    "aum_slope": 3, "salesslope": 4, "salesslope_3mon": 4, "salesfreqslope": 6, "proj_sales": 2, "proj_sales_3mon": 2, "salesslope_byavg": 5,
    "salesslope_byavg_3mon": 5, "salesfreqslope_byavg": 5, "aumslope_byavg": 5, "aum_qtrlyavg": 2,
}
TREND_SQL = {
    "aum_slope": "aslope", "salesslope": "slope", "salesslope_3mon": "slope3", "salesfreqslope": "fslope", "proj_sales": PROJ, "proj_sales_3mon": PROJ3,
    "salesslope_byavg": "CASE WHEN rollup_12monsales / 12 = 0 THEN 0.0 ELSE slope / (rollup_12monsales / 12) END",
    "salesslope_byavg_3mon": "CASE WHEN rollup_3monsales / 3 = 0 THEN 0.0 ELSE slope3 / (rollup_3monsales / 3) END",
    "salesfreqslope_byavg": "CASE WHEN rollup_12monfreq = 0 THEN 0.0 ELSE fslope / (rollup_12monfreq / 12) END",
    "aumslope_byavg": f"CASE WHEN {AUM_MEAN} > 0 THEN aslope / {AUM_MEAN} ELSE 0.0 END",
    "aum_qtrlyavg": AUM_MEAN,
}
PLAIN = [
    "rollup_3monsales", "rollup_3_6monsales", "rollup_12monsales", "rollup_12_24monsales", "rollup_3monfreq", "rollup_3_6monfreq", "rollup_12monfreq",
    *(f"aum_{k}" for k in LAGS), *(f"{n}_{k}" for n in ("avg12", "avg3", "freq12") for k in range(1, 12)), "call_12m", "visit_12m", "num_funds_sales",
    "salesgt1000", "sales0_in12mon",
]
DERIVED_SQL = {
    "rollup_12monredemptions": "red12",
    "rollup_12_24monredemptions": "red24",
    "last_12mon_monthly_avg_sales": "rollup_12monsales / 12",
    "last_3mon_monthly_avg_sales": "rollup_3monsales / 3",
    "last_12_month_freq_avg": "rollup_12monfreq / 12",
    "netsales12m": "net12",
    "netsales12_24m": "net24",
    "prev_3monthsales": "rollup_3_6monsales / 3",
    "prev_3monthfreq": "rollup_3_6monfreq / 3",
    "avg_historical_12monsales": "(rollup_12monsales + rollup_12_24monsales) / 2",
    "max_historical_12monsales": "greatest(rollup_12monsales, rollup_12_24monsales)",
    "max_aum_2years": f"greatest({', '.join(f'aum_{k}' for k in LAGS)})",
    "aum_gt_1m": "CAST(aum_0 >= 1000000 AS INTEGER)",
    "sales_gt_100k_2years": "CAST(rollup_12monsales >= 100000 OR rollup_12_24monsales >= 100000 AS INTEGER)",
    "sales_recent_freqgrowth": _sign("rollup_3monfreq", "rollup_3_6monfreq / 2"),
    "sales_recent_growth": _sign("rollup_3monsales", "rollup_3_6monsales / 2"),
    "last24msales": "rollup_12monsales + rollup_12_24monsales",
    "last24mredemptions": "red12 + red24",
    "r_move": "r",
    "f_move": "f",
    "m_move": "m",
    "total_activity": "call_12m + visit_12m",
}
LABEL_SQL = f"""CASE WHEN net12 IS NULL THEN 'Holding Asset' ELSE {SEGMENT_SQL} END AS nsales_segment,
    CASE WHEN {PROJ3} IS NULL OR ({PROJ3} = 0 AND {PROJ} = 0) THEN '0' WHEN {PROJ3} * 4 > {PROJ} THEN 'Short Term Momentum' WHEN {PROJ3} * 4 < {PROJ} THEN 'Long Term Momentum'
         ELSE 'Consistent' END AS momentum,
    CASE WHEN rollup_12monsales > 0 OR aum_0 > 0 THEN 'active' ELSE 'dormant' END AS active_dormant,
    coalesce(rfm_f6, 111) AS rfm_f6, coalesce(rfm_s6, 111) AS rfm_s6, coalesce(movement, 'ambiguous') AS movement"""
FEATURES_SQL = ", ".join(
    [_filled(n, n) for n in PLAIN] + [_filled(e, n) for n, e in DERIVED_SQL.items()] + [_rounded(e, TRENDS[n], n) for n, e in TREND_SQL.items()]
)


@query(
    "pipe_lead_features",
    f"""WITH clip AS (SELECT o_custkey, o_orderdate, o_orderstatus, least(o_totalprice, (SELECT quantile_cont(o_totalprice, 0.995) FROM orders)) AS o_totalprice FROM orders),
      b AS (SELECT o_custkey AS cgi, {TRAILING_SQL}, {SNAPSHOT_SQL}, {AVERAGES_SQL},
              count(*) FILTER (WHERE {D} > DATE '{E12}' AND o_totalprice = 0) AS sales0_in12mon,
              CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN -{AMT} ELSE 0 END) FILTER (WHERE {D} > DATE '{E12}'), 0) AS DOUBLE) AS red12,
              CAST(coalesce(sum(CASE WHEN o_orderstatus = 'F' THEN -{AMT} ELSE 0 END) FILTER (WHERE {_span(E24, E12)}), 0) AS DOUBLE) AS red24 FROM clip GROUP BY 1),
      l AS (SELECT cgi, unnest([{', '.join(f'avg12_{k}' for k in range(11, 0, -1))}, rollup_12monsales / 12]) AS y, unnest([{', '.join(f'avg3_{k}' for k in range(11, 0, -1))}, rollup_3monsales / 3]) AS y3,
              unnest([{', '.join(f'freq12_{k}' for k in range(11, 0, -1))}, rollup_12monfreq / 12]) AS yf, unnest(range(1, 13)) AS x FROM b),
      s AS (SELECT cgi, regr_slope(y, x) AS slope, regr_slope(y3, x) AS slope3, regr_slope(yf, x) AS fslope FROM l GROUP BY 1),
      al AS (SELECT cgi, unnest([{', '.join(f'aum_{k}' for k in reversed(LAGS))}]) AS y, unnest(range(1, 9)) AS x FROM b),
      a AS (SELECT cgi, regr_slope(y, x) AS aslope FROM al GROUP BY 1),
      net AS (SELECT *, rollup_12monsales + red12 AS net12, rollup_12_24monsales + red24 AS net24 FROM b),
      act AS (SELECT user_id AS cgi, count(*) FILTER (WHERE event_type IN ('click', 'view')) AS call_12m, count(*) FILTER (WHERE event_type = 'signup') AS visit_12m FROM events GROUP BY 1),
      fund AS (SELECT o_custkey AS cgi, count(DISTINCT p_brand) AS num_funds_sales FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey WHERE {D} > DATE '{E12}' GROUP BY 1),
      mon AS (SELECT o_custkey AS cgi, count(*) AS salesgt1000 FROM (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS m, sum({AMT}) AS s FROM clip WHERE {D} > DATE '{E12}' GROUP BY ALL) WHERE s >= 1000 GROUP BY 1),
      mv AS ({MOVEMENT_SQL})
    SELECT c_custkey AS cgi, {FEATURES_SQL}, {LABEL_SQL}
    FROM customer LEFT JOIN net ON c_custkey = net.cgi LEFT JOIN s ON c_custkey = s.cgi LEFT JOIN a ON c_custkey = a.cgi LEFT JOIN act ON c_custkey = act.cgi
         LEFT JOIN fund ON c_custkey = fund.cgi LEFT JOIN mon ON c_custkey = mon.cgi LEFT JOIN mv ON c_custkey = mv.cgi""",
)
def pipe_lead_features(t: Tables) -> DataFrame:
    found = lead_features(t)
    return found.select([rounded(c, TRENDS[c]).alias(c) if c in TRENDS else F.col(c) for c in found.columns])
