"""Queries over joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemill.functions.columns import dbl, epoch_us, money
from tidemill.operators import joins, ranges, similar
from tidemill.plans.registry import Tables, query

HOUR = 3_600_000_000
JANUARY = 1_704_067_200_000_000  # 2024-01-01 in microseconds


@query(
    "join_inner",
    "SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner(t: Tables) -> DataFrame:
    accounts = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return t.orders.join(accounts, "o_custkey").select("o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query(
    "join_inner_expr",
    """SELECT s.k AS supplier_key, c.k AS nation_key, s.name AS supplier_name, c.name AS nation_name
       FROM (SELECT s_suppkey AS k, s_nationkey AS nation, s_name AS name FROM supplier) s
       JOIN (SELECT n_nationkey AS k, n_name AS name FROM nation) c ON s.nation = c.k""",
)
def join_inner_expr(t: Tables) -> DataFrame:
    s = t.supplier.toDF("k", "name", "nation", "bal").alias("s")
    c = t.nation.toDF("k", "name", "region").alias("c")
    return s.join(c, F.col("s.nation") == F.col("c.k")).select(
        F.col("s.k").alias("supplier_key"),
        F.col("c.k").alias("nation_key"),
        F.col("s.name").alias("supplier_name"),
        F.col("c.name").alias("nation_name"),
    )


@query(
    "join_star_left",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, p_brand, p_type, s_name, n_name
       FROM lineitem LEFT JOIN part ON l_partkey = CASE WHEN p_partkey % 11 <> 0 THEN p_partkey END
       LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def join_star_left(t: Tables) -> DataFrame:
    # Every eleventh part has no key, so lines miss it.
    part = t.part.select(F.when(F.col("p_partkey") % 11 != 0, F.col("p_partkey")).alias("l_partkey"), "p_brand", "p_type")
    supplier = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey"))
    nation = t.nation.select("n_nationkey", "n_name")
    facts = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return joins.lookup_chain(facts, [(part, "l_partkey"), (supplier, "l_suppkey"), (nation, "n_nationkey")]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "p_brand", "p_type", "s_name", "n_name"
    )


@query(
    "join_multi_key",
    """WITH base AS (SELECT DISTINCT l_suppkey AS k, year(l_shipdate) || ' Q' || quarter(l_shipdate) AS q FROM lineitem),
       a AS (SELECT l_suppkey AS k, year(l_shipdate) || ' Q' || quarter(l_shipdate) AS q, count(*) AS n_returned FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
       b AS (SELECT l_suppkey AS k, year(l_shipdate) || ' Q' || quarter(l_shipdate) AS q, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS open_qty
             FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL)
       SELECT base.k AS store_id, base.q AS quarter, n_returned, open_qty
       FROM base LEFT JOIN a ON base.k = a.k AND base.q = a.q LEFT JOIN b ON base.k = b.k AND base.q = b.q""",
)
def join_multi_key(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        F.col("l_suppkey").alias("store_id"),
        F.concat(F.year("l_shipdate").cast("string"), F.lit(" Q"), F.quarter("l_shipdate").cast("string")).alias("quarter"),
        "l_returnflag",
        "l_linestatus",
        "l_quantity",
    )
    keys = ["store_id", "quarter"]
    returned = lines.where("l_returnflag = 'R'").groupBy(*keys).agg(F.count("*").alias("n_returned"))
    still_open = lines.where("l_linestatus = 'O'").groupBy(*keys).agg(dbl(F.sum(money("l_quantity"))).alias("open_qty"))
    return joins.lookup_chain(lines.select(*keys).distinct(), [(returned, keys), (still_open, keys)])


@query(
    "join_left_coalesce",
    """SELECT c_custkey, c_name, coalesce(CAST(s AS DOUBLE), 0.0) AS total_spend
       FROM customer LEFT JOIN (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS s FROM orders GROUP BY 1) ON c_custkey = o_custkey""",
)
def join_left_coalesce(t: Tables) -> DataFrame:
    spend = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(dbl(F.sum(money("o_totalprice"))).alias("s"))
    return t.customer.join(spend, "c_custkey", "left").select(
        "c_custkey", "c_name", F.coalesce("s", F.lit(0.0)).alias("total_spend")
    )


@query(
    "join_full_outer",
    """WITH f AS (SELECT o_custkey AS k, count(*) AS n_before FROM orders WHERE o_orderdate < DATE '2000-01-01' GROUP BY 1),
            s AS (SELECT o_custkey AS k, count(*) AS n_since FROM orders WHERE o_orderdate >= DATE '2000-01-01' GROUP BY 1)
       SELECT coalesce(f.k, s.k) AS custkey, coalesce(n_before, 0) AS n_before, coalesce(n_since, 0) AS n_since
       FROM f FULL JOIN s ON f.k = s.k""",
)
def join_full_outer(t: Tables) -> DataFrame:
    turn = F.lit("2000-01-01").cast("timestamp_ntz")

    def counts(test: Column, name: str) -> DataFrame:
        return t.orders.where(test).groupBy(F.col("o_custkey").alias("custkey")).agg(F.count("*").alias(name))

    early, late = counts(F.col("o_orderdate") < turn, "n_before"), counts(F.col("o_orderdate") >= turn, "n_since")
    return joins.full_outer(early, late, ["custkey"], {"n_before": 0, "n_since": 0})


@query(
    "join_anti",
    """SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m') AS ym FROM orders o
       WHERE NOT EXISTS (SELECT 1 FROM orders u WHERE u.o_orderpriority = '1-URGENT' AND u.o_custkey = o.o_custkey
                         AND strftime(u.o_orderdate, '%Y-%m') = strftime(o.o_orderdate, '%Y-%m'))""",
)
def join_anti(t: Tables) -> DataFrame:
    """Customer months with no urgent order: left anti join on two keys."""
    months = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("ym"), "o_orderpriority")
    urgent = months.where("o_orderpriority = '1-URGENT'").select("o_custkey", "ym")
    return months.select("o_custkey", "ym").distinct().join(urgent, ["o_custkey", "ym"], "left_anti")


@query(
    "dq_orphans",
    """SELECT o_orderkey, o_custkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN -o_custkey ELSE o_custkey END AS o_custkey FROM orders)
       LEFT JOIN customer ON o_custkey = c_custkey WHERE c_custkey IS NULL""",
)
def dq_orphans(t: Tables) -> DataFrame:
    known = t.customer.select(F.col("c_custkey").alias("o_custkey"))
    # Every thirteenth order names a customer that does not exist.
    orphan = F.col("o_orderkey") % 13 == 0
    orders = t.orders.select("o_orderkey", F.when(orphan, -F.col("o_custkey")).otherwise(F.col("o_custkey")).alias("o_custkey"))
    return orders.join(known, "o_custkey", "left_anti").select("o_orderkey", "o_custkey")


@query(
    "join_exclusion",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (1, 2, 3)
       AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 495000)
       AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice < 3000)""",
)
def join_exclusion(t: Tables) -> DataFrame:
    large = t.orders.where("o_totalprice > 495000").select("o_custkey")
    small = t.orders.where("o_totalprice < 3000").select("o_custkey")
    return joins.exclude_ids(t.customer, "c_custkey", [large, small], [1, 2, 3]).select("c_custkey", "c_name")


@query(
    "join_semi",
    """SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000) AS has_large FROM customer""",
)
def join_semi(t: Tables) -> DataFrame:
    large = t.orders.where("o_totalprice > 480000").select(F.col("o_custkey").alias("c_custkey"))
    keys = t.customer.select("c_custkey")
    inside = keys.join(large, "c_custkey", "left_semi").withColumn("has_large", F.lit(True))
    outside = keys.join(large, "c_custkey", "left_anti").withColumn("has_large", F.lit(False))
    return inside.unionByName(outside)


@query(
    "join_prefer_source",
    """WITH p AS (SELECT p_brand || '/' || p_size AS brand, p_partkey, p_type FROM part),
            a AS (SELECT brand, p_partkey, 'A' AS src FROM p WHERE p_type = 'ECONOMY'),
            b AS (SELECT brand, p_partkey, 'B' AS src FROM p WHERE p_type <> 'ECONOMY')
       SELECT * FROM a UNION ALL SELECT * FROM b WHERE brand NOT IN (SELECT brand FROM a)""",
)
def join_prefer_source(t: Tables) -> DataFrame:
    rows = t.part.select(F.concat_ws("/", "p_brand", "p_size").alias("brand"), "p_partkey", "p_type")
    first = rows.where("p_type = 'ECONOMY'").select("brand", "p_partkey", F.lit("A").alias("src"))
    second = rows.where("p_type <> 'ECONOMY'").select("brand", "p_partkey", F.lit("B").alias("src"))
    return joins.prefer(first, second, ["brand"])


@query(
    "join_rate_on_date",
    """WITH r AS (SELECT CAST(ts AS DATE) - INTERVAL 24 YEAR AS d, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS rate
                  FROM events WHERE event_type = 'purchase' GROUP BY 1)
       SELECT o_orderkey, CAST(round(CAST(o_totalprice * rate AS DECIMAL(24,8)), 4) AS DOUBLE) AS amount_usd
       FROM orders JOIN r ON CAST(o_orderdate AS DATE) = CAST(d AS DATE)""",
)
def join_rate_on_date(t: Tables) -> DataFrame:
    rates = (
        t.events.where("event_type = 'purchase'")
        .groupBy(F.to_date("ts").alias("day"))
        .agg((dbl(F.sum(money("value"))) / F.count("*")).alias("rate"))
        .select(F.add_months("day", -288).alias("rate_date"), "rate")
    )
    amount = F.round((F.col("o_totalprice") * F.col("rate")).cast("decimal(24,8)"), 4)
    return t.orders.join(rates, F.to_date("o_orderdate") == F.col("rate_date")).select(
        "o_orderkey", dbl(amount).alias("amount_usd")
    )


SERIES_SQL = """
WITH s AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(CAST(value AS DECIMAL(18,2))) AS v FROM events GROUP BY ALL),
     j AS (SELECT a.day, a.v AS v_click, b.v AS v_view FROM s a JOIN s b ON a.day = b.day
           WHERE a.event_type = 'click' AND b.event_type = 'view')
SELECT day, CAST(v_click AS DOUBLE) AS click_value, CAST(v_view AS DOUBLE) AS view_value,
       CAST(v_click - lag(v_click) OVER (ORDER BY day) AS DOUBLE) AS click_change,
       CAST(v_view - lag(v_view) OVER (ORDER BY day) AS DOUBLE) AS view_change
FROM j"""


@query("join_self_series", SERIES_SQL)
def join_self_series(t: Tables) -> DataFrame:
    """Two daily series side by side. One row per calendar day reaches the window."""
    series = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.sum(money("value")).alias("v"))
    a, b = series.alias("a"), series.alias("b")
    sides = a.join(b, "day").where("a.event_type = 'click' AND b.event_type = 'view'")
    by_day = Window.partitionBy("a.event_type").orderBy("day")
    return sides.select(
        "day",
        dbl("a.v").alias("click_value"),
        dbl("b.v").alias("view_value"),
        dbl(F.col("a.v") - F.lag("a.v").over(by_day)).alias("click_change"),
        dbl(F.col("b.v") - F.lag("b.v").over(by_day)).alias("view_change"),
    )


@query(
    "filter_latest_snapshot",
    "SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)",
)
def latest_snapshot(t: Tables) -> DataFrame:
    return joins.latest_snapshot(t.orders, F.to_date("o_orderdate")).select("o_orderkey", "o_custkey")


@query(
    "join_prefix_prune",
    """SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
       WHERE substr(CAST(l_partkey AS VARCHAR), 1, 2) IN (SELECT substr(CAST(p_partkey AS VARCHAR), 1, 2) FROM part WHERE p_retailprice < 910)""",
)
def prefix_prune(t: Tables) -> DataFrame:
    cheap = t.part.where("p_retailprice < 910")
    return joins.prune_by_prefix(t.lineitem, cheap, "l_partkey", "p_partkey", 2).select(
        "l_orderkey", "l_partkey", "l_linenumber"
    )


SESSIONS_SQL = """(SELECT user_id, CAST(ts AS DATE) AS day, min(ts) AS b, max(ts) AS e, count(*) AS n FROM events GROUP BY ALL)"""


def user_days(t: Tables) -> DataFrame:
    """First and last event of each user and day, as a period."""
    return t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.min("ts").alias("b"), F.max("ts").alias("e"), F.count("*").alias("n")
    )


def order_windows(t: Tables) -> DataFrame:
    """One window per order day: three hours on per day, counted from January 2024 and 2001, one to seven hours long.

    There are as many windows as order days, however many orders or events
    there are, so the pairs grow with the events alone.
    """
    day = F.datediff(F.to_date("o_orderdate"), F.lit("2001-01-01").cast("date"))
    days = t.orders.groupBy(day.alias("day_no")).agg(F.count("*").alias("n_orders"))
    start = F.lit(JANUARY) + F.col("day_no") * (3 * HOUR)
    return days.select(
        "day_no", "n_orders", start.alias("w_begin"), (start + (F.col("n_orders") % 7 + 1) * HOUR).alias("w_end")
    )


WINDOWS_SQL = """(SELECT *, TIMESTAMP '2024-01-01' + to_hours(day_no * 3) AS wb, TIMESTAMP '2024-01-01' + to_hours(day_no * 3 + n_orders % 7 + 1) AS we
    FROM (SELECT CAST(date_diff('day', DATE '2001-01-01', CAST(o_orderdate AS DATE)) AS INTEGER) AS day_no, count(*) AS n_orders FROM orders GROUP BY 1))"""


@query(
    "join_period_overlap",
    f"""SELECT user_id, day, n, day_no, n_orders FROM {SESSIONS_SQL} s JOIN {WINDOWS_SQL} w ON NOT (s.b >= w.we OR w.wb >= s.e)""",
)
def period_overlap(t: Tables) -> DataFrame:
    """Active time of each user and day against the order windows, pair by pair."""
    days = user_days(t).withColumns({"b_us": epoch_us("b"), "e_us": epoch_us("e")})
    c = F.col
    pairs = ranges.interval_join(days, order_windows(t), c("b_us"), c("e_us"), c("w_begin"), c("w_end"), width=4 * HOUR)
    return pairs.select("user_id", "day", "n", "day_no", "n_orders")


@query(
    "join_point_in_period",
    f"""SELECT event_id, day_no, n_orders FROM events JOIN {WINDOWS_SQL} w ON ts >= wb AND ts <= we""",
)
def point_in_period(t: Tables) -> DataFrame:
    points = t.events.select("event_id", epoch_us("ts").alias("at"))
    c = F.col
    pairs = ranges.point_in_period(points, order_windows(t), c("at"), c("w_begin"), c("w_end"), width=4 * HOUR)
    return pairs.select("event_id", "day_no", "n_orders")


@query(
    "join_ip_range",
    """WITH h AS (SELECT event_id, 167772160 + user_id * 65537 % 16777216 AS ip FROM events),
            n AS (SELECT s_suppkey AS net_id, CASE WHEN s_suppkey % 3 = 0 THEN 16 WHEN s_suppkey % 3 = 1 THEN 24 ELSE 30 END AS bits,
                         167772160 + s_suppkey * 65536 + CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey END AS addr FROM supplier),
            m AS (SELECT net_id, bits, addr - addr % CAST(pow(2, 32 - bits) AS BIGINT) AS lo, CAST(pow(2, 32 - bits) AS BIGINT) AS size FROM n)
       SELECT event_id, net_id, bits FROM h JOIN m ON ip >= lo AND ip < lo + size""",
)
def ip_range(t: Tables) -> DataFrame:
    """Event hosts in supplier networks of three prefix lengths."""

    def dotted(n):
        parts = [F.floor(n / 16777216) % 256, F.floor(n / 65536) % 256, F.floor(n / 256) % 256, n % 256]
        return F.concat_ws(".", *[p.cast("bigint").cast("string") for p in parts])

    hosts = t.events.select("event_id", dotted(167772160 + F.col("user_id") * 65537 % 16777216).alias("host"))
    kind = F.col("s_suppkey") % 3
    networks = t.supplier.select(
        F.col("s_suppkey").alias("net_id"),
        F.when(kind == 0, 16).when(kind == 1, 24).otherwise(30).alias("bits"),
        dotted(
            167772160 + F.col("s_suppkey") * 65536 + F.when(kind == 0, F.lit(0)).otherwise(F.col("s_suppkey"))
        ).alias("network"),
    )
    return ranges.network_join(hosts, networks, "host", "network", "bits").select("event_id", "net_id", "bits")


@query(
    "join_fuzzy",
    """WITH a AS (SELECT DISTINCT p_name AS name FROM part),
            b AS (SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN substr(p_name, 1, 2) || substr(p_name, 4)
                         WHEN 2 THEN substr(p_name, 1, 3) || 'z' || substr(p_name, 4) ELSE replace(p_name, 'l', 'll') END AS typed FROM part)
       SELECT name, typed, CAST(round(CAST(jaro_winkler_similarity(name, typed) AS DECIMAL(24,8)), 6) AS DOUBLE) AS score
       FROM a JOIN b ON levenshtein(name, typed) <= 1""",
)
def fuzzy(t: Tables) -> DataFrame:
    """Part names against names with a typing error."""
    name, slot = F.col("p_name"), F.col("p_partkey") % 4
    typed = (
        F.when(slot == 0, name)
        .when(slot == 1, F.concat(F.substr(name, F.lit(1), F.lit(2)), F.substr(name, F.lit(4))))
        .when(slot == 2, F.concat(F.substr(name, F.lit(1), F.lit(3)), F.lit("z"), F.substr(name, F.lit(4))))
        .otherwise(F.replace(name, F.lit("l"), F.lit("ll")))
    )
    found = similar.fuzzy_match(
        t.part.select(name.alias("name")), t.part.select(typed.alias("typed")), "name", "typed"
    )
    return found.select("name", "typed", dbl(F.round(F.col("score").cast("decimal(24,8)"), 6)).alias("score"))


@query(
    "join_similar",
    """WITH a AS (SELECT DISTINCT p_name || ' ' || p_brand AS name FROM part),
            b AS (SELECT DISTINCT CASE p_partkey % 4 WHEN 0 THEN p_name || ' ' || p_brand WHEN 1 THEN substr(p_name, 2, 2) || substr(p_name, 1, 1) || substr(p_name, 4) || ' ' || p_brand
                         WHEN 2 THEN p_brand || ' ' || p_name ELSE p_name || ' ' || replace(p_brand, '#', ' no ') END AS typed FROM part)
       SELECT name, typed, CAST(round(CAST(jaro_winkler_similarity(name, typed) AS DECIMAL(24,8)), 6) AS DOUBLE) AS score
       FROM a, b WHERE jaro_winkler_similarity(name, typed) >= 0.9 - 1e-9""",
)
def similar_names(t: Tables) -> DataFrame:
    """Part labels against labels with characters moved, words swapped or signs replaced."""
    name, label, slot = F.col("p_name"), F.concat("p_name", F.lit(" "), "p_brand"), F.col("p_partkey") % 4
    piece = lambda start, n: F.substr(name, F.lit(start), F.lit(n))
    typed = (
        F.when(slot == 0, label)
        .when(slot == 1, F.concat(piece(2, 2), piece(1, 1), F.substr(name, F.lit(4)), F.lit(" "), "p_brand"))
        .when(slot == 2, F.concat("p_brand", F.lit(" "), name))
        .otherwise(F.concat(name, F.lit(" "), F.replace("p_brand", F.lit("#"), F.lit(" no "))))
    )
    found = similar.similarity_join(t.part.select(label.alias("name")), t.part.select(typed.alias("typed")), "name", "typed", 0.9)
    return found.select("name", "typed", dbl(F.round(F.col("score").cast("decimal(24,8)"), 6)).alias("score"))


@query(
    "join_derived_key",
    """WITH b AS (SELECT p_partkey, CASE WHEN instr(p_brand, '#') > 0 THEN substr(p_brand, instr(p_brand, '#') + 1) ELSE p_brand END AS code,
                         split_part(p_brand, '#', 1) AS stem FROM part)
       SELECT p_partkey, stem, n_name, s_name FROM b LEFT JOIN nation ON CAST(code AS INTEGER) = n_nationkey
       LEFT JOIN supplier ON CAST(code AS BIGINT) = s_suppkey""",
)
def derived_key(t: Tables) -> DataFrame:
    """Keys cut out of a label, then two left joins."""
    keyed = t.part.select(
        "p_partkey",
        F.substring_index("p_brand", "#", 1).alias("stem"),
        F.substring_index("p_brand", "#", -1).try_cast("bigint").alias("code"),
    )
    nation = t.nation.select(F.col("n_nationkey").cast("bigint").alias("code"), "n_name")
    supplier = t.supplier.select(F.col("s_suppkey").alias("code"), "s_name")
    return joins.lookup_chain(keyed, [(nation, "code"), (supplier, "code")]).select(
        "p_partkey", "stem", "n_name", "s_name"
    )
