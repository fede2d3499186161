"""Golden outputs of the commerce job and small cases of single operators."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemill.functions import dates, json as js, text as tx
from tidemill.operators.changes import persisted
from tidemill.operators import calendar as cal, columns as cols, features as ft, quality as dq, synthetic as syn
from tidemill.plans import commerce
from tidemill.session import cut_lineage
from tidemill.sources import readers, writers

# Inputs and outputs of the commerce example.
TRANSACTIONS = [
    ("T001", 101, 501, "2024-10-01", 150.0), ("T002", 102, 502, "2024-10-01", 250.5), ("T003", 101, 503, "2024-10-02", 50.0),
    ("T004", 103, 501, "2024-10-03", 450.0), ("T005", 102, 504, "2024-10-04", 75.0), ("T006", 104, 505, "2024-10-04", 600.0),
    ("T007", None, 501, "2024-10-05", 25.0), ("T008", 103, 502, "2024-10-05", 120.0), ("T009", 101, 504, "2024-10-05", 800.0),
    ("T010", 104, 503, "2024-10-06", 20.0),
]
RETURNS = [("T002", 50.5), ("T006", 600.0), ("T009", 400.0)]
CUSTOMERS = [(101, "Alice Smith", "USA"), (102, "Bob Johnson", "CAN"), (103, "Charlie Brown", "MEX"), (104, "Dana Scully", "GER"), (105, "Eve Adams", "USA")]
PRODUCTS = [(501, "Electronics"), (502, "Electronics"), (503, "Apparel"), (504, "Apparel"), (505, "Books")]
RATES = [("USD", 1.0, "2024-10-01"), ("EUR", 1.075, "2024-10-01"), ("EUR", 1.08, "2024-10-05"), ("EUR", 1.077, "2024-10-06")]


@pytest.fixture(scope="module")
def shop(spark):
    make = spark.createDataFrame
    return {
        "t": make(TRANSACTIONS, "transaction_id string, customer_id int, product_id int, transaction_date string, transaction_amount double"),
        "r": make(RETURNS, "transaction_id string, return_amount double"),
        "c": make(CUSTOMERS, "customer_id int, customer_name string, country string"),
        "p": make(PRODUCTS, "product_id int, category string"),
        "x": make(RATES, "currency_code string, exchange_rate double, rate_date string"),
    }


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_commerce_goldens(shop):
    assert rows(commerce.daily_sales(shop["t"], shop["r"])) == [
        ("2024-10-01", 400.5, 2, 50.5), ("2024-10-02", 50.0, 1, 0.0), ("2024-10-03", 450.0, 1, 0.0),
        ("2024-10-04", 675.0, 2, 600.0), ("2024-10-05", 945.0, 3, 400.0), ("2024-10-06", 20.0, 1, 0.0),
    ]
    assert rows(commerce.customer_value(shop["c"], shop["t"], shop["r"])) == [
        (101, "Alice Smith", "USA", 1000.0, 600.0), (102, "Bob Johnson", "CAN", 325.5, 275.0), (103, "Charlie Brown", "MEX", 570.0, 570.0),
        (104, "Dana Scully", "GER", 620.0, 20.0), (105, "Eve Adams", "USA", 0.0, 0.0),
    ]
    assert rows(commerce.top_categories(shop["t"], shop["p"])) == [("Apparel", 4, 2), ("Books", 1, 3), ("Electronics", 5, 1)]
    assert rows(commerce.foreign_transactions(shop["t"], shop["x"])) == [
        ("T001", "2024-10-01", 161.25), ("T002", "2024-10-01", 269.2875), ("T007", "2024-10-05", 27.0),
        ("T008", "2024-10-05", 129.6), ("T009", "2024-10-05", 864.0), ("T010", "2024-10-06", 21.54),
    ]
    assert rows(commerce.error_log(shop["t"])) == [
        ("T006", "High Value Transaction (>500)"), ("T007", "Missing Customer ID"), ("T009", "High Value Transaction (>500)"),
    ]


def test_business_days_equal_a_loop(spark):
    first = datetime.date(2024, 2, 20)
    pairs = [(first + datetime.timedelta(days=a), first + datetime.timedelta(days=b)) for a in range(9) for b in range(0, 30, 3)]
    df = spark.createDataFrame([*pairs, (None, first)], "s date, e date")
    for r in df.select("s", "e", dates.business_days(F.col("s"), F.col("e"), ["2024-02-29"]).alias("n")).collect():
        if r.s is None:
            assert r.n is None
        else:
            days = [r.s + datetime.timedelta(days=k) for k in range(max((r.e - r.s).days, 0))]
            assert r.n == sum(d.weekday() < 5 and d != datetime.date(2024, 2, 29) for d in days)


def test_fill_gaps(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 1.0), ("a", "2024-01-04", None), ("b", "2024-01-03", 2.0)], "g string, d string, v double")
    got = cal.fill_gaps(df.withColumn("d", F.to_date("d")), "d", ["g"], ["v"], "2024-01-05")
    assert [(r.g, r.d.day, r.v) for r in got.orderBy("g", "d").collect()] == [("a", k, 1.0) for k in range(1, 6)] + [("b", k, 2.0) for k in (3, 4, 5)]


def test_period_expand_units(spark):
    df = spark.createDataFrame([("2024-01-15 10:00:00", "2024-03-01 00:00:00")], "b string, e string").select(
        F.col("b").cast("timestamp_ntz").alias("b"), F.col("e").cast("timestamp_ntz").alias("e")
    )
    at = lambda unit, anchor: [str(r.unit_at) for r in cal.expand_period(df, "b", "e", unit, anchor).collect()]
    assert at("month", "begin") == ["2024-01-01 00:00:00", "2024-02-01 00:00:00"]
    assert at("month", "end") == ["2024-01-31 23:59:59.999000", "2024-02-29 23:59:59.999000"]
    assert at("year", "begin") == ["2024-01-01 00:00:00"]
    parsed = spark.createDataFrame([("2024-01-01*2024-02-01",), ("bad",)], "p string").select(cal.parse_period(F.col("p")).alias("x")).collect()
    assert str(parsed[0].x.end) == "2024-02-01 00:00:00" and parsed[1].x.end is None


def test_columns(spark):
    df = spark.createDataFrame([(1, None, " A ")], "`Total Sales (USD)` int, n short, s string")
    assert cols.normalise_names(df).columns == ["total_sales_usd", "n", "s"]
    with pytest.raises(ValueError):
        cols.normalise_names(df.toDF("a b", "a-b", "s"))
    assert cols.fill_numbers(5)(df).first().n == 5
    assert cols.drop_null_keys([])(df).count() == 1
    typed = cols.impose_types({"s": "int"})(spark.createDataFrame([("12",), (" 7 ",), ("x",), ("99999999999",), ("1.5",)], "s string"))
    assert [r.s for r in typed.collect()] == [12, 7, None, None, None]
    feed = spark.createDataFrame([("1", "2024-01-01"), ("x", None)], "a string, d string")
    assert [r["__reason"] for r in cols.split_valid(feed, {"a": "int", "d": "date"}, ["a", "d"]).collect()] == [None, "a unreadable; d missing"]


def test_quality(spark):
    df = spark.createDataFrame([(1, "a")], "k long, s string")
    with pytest.raises(dq.ColumnError):
        dq.columns_present(df, ["z"])
    with pytest.raises(dq.ColumnError):
        dq.columns_absent(df, ["s"])
    with pytest.raises(dq.ColumnError):
        dq.columns_exact(df, ["k"])
    with pytest.raises(dq.SchemaError):
        dq.conforms(df, spark.createDataFrame([], "k int, s string").schema)
    with pytest.raises(dq.ValuesError):
        dq.require_no_nulls(df.withColumn("n", F.lit(None).cast("int")), ["k", "n"])


def test_json(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": [1, null]}}'), (2, "not json"), (3, None)], "id int, j string")
    opened = [(r.id, r.key, r.value, r.type) for r in js.open_json(df, "j").where("id = 1").collect()]
    assert opened == [(1, "a", "1", 2), (1, "b", '{"c":[1,null]}', 5)]
    one = df.where("id = 1").select(
        js.json_scalars("j", "$.b.c").alias("s"), js.set_paths("j", {"b.d": F.lit(2), "x.y": F.lit("t")}).alias("set"), js.keep_paths("j", ["b.c", "q.r"]).alias("kept")
    ).first()
    assert (one.s, one.set, one.kept) == (None, '{"a":1,"b":{"c":[1,null],"d":2},"x":{"y":"t"}}', '{"b":{"c":[1,null]}}')


def test_text(spark):
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(tx.name_value(F.lit("a=1;b:2;a=3"), "a", (";",), ("=", ":"), 2)) == "3"
    assert get(tx.ancestor(F.lit("/a/b/c/"), 1)) == "/a/b/" and get(tx.ancestor(F.lit("/a/"), 1)) == "/" and get(tx.ancestor(F.lit("/a/"), 2)) is None
    for path, target in {
        "s3://b/x.csv": "@lake/s3/b/x.csv", "file:///tmp/a": "@lake/local/tmp/a", "/data/a.csv": "@lake/local/data/a.csv", "./a": "@lake/relative/a",
        "../a/b": "@lake/relative/parent/a/b", "../../a": "@lake/relative/parent2/a", "@OLD/s3/x": "@lake/s3/x", "${v}/a": None,
    }.items():
        assert get(tx.staged_path(F.lit(path), "lake")) == target, path
    code = spark.createDataFrame([(1, "x = df.collect()\n# df.rdd\ny = 1"), (2, "z"), (3, "a.rdd\nb.cache( )")], "id int, t string")
    got = {r.id: (r.n_lines, r.n_matches, r.score, r.level) for r in tx.rule_scan(code, ["id"], "t", tx.CODE_RULES).collect()}
    assert got == {1: (3, 1, 80, "Critical"), 2: (1, 0, 0, "Low"), 3: (2, 2, 100, "Critical")}
    lines = [(r.id, r.line_number, r.rule) for r in tx.rule_matches(code, ["id"], "t", tx.CODE_RULES).orderBy("id", "line_number").collect()]
    assert lines == [(1, 1, ".collect()"), (3, 1, ".rdd"), (3, 2, ".cache()")]


def test_feature_edges():
    day = datetime.date
    assert ft.months_before(day(2001, 2, 28), 3) == day(2000, 11, 28)
    assert ft.month_end(day(2001, 7, 31), 5) == day(2001, 2, 28) and ft.months_before(day(2001, 3, 31), 1) == day(2001, 2, 28)


def test_slope_equals_least_squares(spark):
    import numpy as np

    points = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0]
    got = spark.range(1).select(ft.slope([F.lit(p) for p in points])).first()[0]
    assert got == pytest.approx(np.polyfit(range(1, 9), points, 1)[0])


def test_synthetic(spark):
    d = syn.resolve((("gt", 5), ("gte", 2), ("lt", 9), ("between", (1, 8)), ("is_null", None)))
    assert (d.low, d.high, d.null_rate) == (5, 8, 0.2)
    keys = spark.range(4000).withColumnRenamed("id", "k")
    out = syn.generate(keys, "k", [syn.Field("a", "int", (("between", (3, 6)), ("is_null", None)))])
    stats = out.agg(F.min("a"), F.max("a"), F.avg(F.col("a").isNull().cast("int"))).first()
    assert (stats[0], stats[1]) == (3, 6) and 0.15 < stats[2] < 0.25
    noisy = syn.add_noise(keys.withColumn("v", F.lit(12.5)), "k", {"v": "decimal"}, rate=0.25)
    assert 0.2 < noisy.agg(F.avg(F.size("noise"))).first()[0] < 0.3
    assert noisy.where("size(noise) = 0 AND v <> '12.5'").isEmpty()
    kinds = {r.kind for r in noisy.select(F.inline("noise")).select("kind").distinct().collect()}
    assert kinds == {"boundary", "format_drift", "null_stress", "type_poison"}
    children = syn.skewed_children(spark.range(1, 21).withColumnRenamed("id", "p"), "p", keys, "k", miss_rate=0.1)
    counts = {r.p: r["count"] for r in children.groupBy("p").count().where("p > 0").collect()}
    assert sum(counts.values()) > 3400 and counts[1] > 2 * counts[10] and children.count() == 4000


def test_contract_of_connectors(spark):
    options = readers.jdbc_options("jdbc:x:y", "SELECT 1", {"user": "u"}, partition_column="id", bounds=(0, 10), partitions=4)
    assert options["dbtable"] == "(SELECT 1) src" and options["numPartitions"] == "4" and options["user"] == "u"
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:x:y", "SELECT 1", {}, partition_column="id")
    with pytest.raises(ValueError):
        readers.read_format(spark, "/nowhere", "xlsx")
    rows = spark.range(100).repartition(8)
    assert writers.jdbc_frame(rows, 3).rdd.getNumPartitions() == 3


def test_cut_lineage_starts_from_files(spark):
    cut = cut_lineage(spark.range(10).groupBy((F.col("id") % 2).alias("k")).count())
    assert cut.inputFiles() and cut.count() == 2


def test_paths_of_a_line(spark):
    lines = {
        """load("a b", "/x/y.csv", 'S3://b/c')""": ["/x/y.csv", "S3://b/c"],
        """put('/no/ending') + "/data/é.csv" + "ftp://x/y" + "..//" + "./z" """: ["..//", "./z"],
        """f("@st/dir/file.csv", "s3://hidden/x")""": ["@st/dir/file.csv"],
        """COPY INTO @"My Stage"/d/e.json FROM '/a/b.txt'""": ['@"My Stage"/d/e.json'],
        "nothing 'here' \"at all\"": [],
    }
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    assert {r.line: r.p for r in df.select("line", tx.storage_paths(F.col("line")).alias("p")).collect()} == lines


def test_every_rule_finds_its_line():
    import re

    from tidemill.plans.semi import CODE_LINES

    assert set(CODE_LINES) == {r.name for r in tx.CODE_RULES}
    assert all(re.search(r.pattern, CODE_LINES[r.name]) for r in tx.CODE_RULES)


def test_impose_schema(spark):
    schema = spark.createDataFrame([], "k int, d date, __audit string").schema
    out = spark.createDataFrame([("7", "2024-02-30", 5), ("x", "2024-02-29", 6)], "k string, d string, __audit long").transform(cols.impose_schema(schema))
    assert dict(out.dtypes) == {"k": "int", "d": "date", "__audit": "bigint"}
    assert [tuple(r) for r in out.collect()] == [(7, None, 5), (None, datetime.date(2024, 2, 29), 6)]


def test_persisted_frame_is_kept_and_released(spark):
    with persisted(spark.range(5)) as kept:
        assert kept.is_cached and kept.count() == 5
    assert not kept.is_cached


def test_nulls_stop_the_job_that_meets_them(spark):
    good = spark.createDataFrame([(1, "a")], "k int, s string")
    assert dq.no_nulls_in_flow(good, ["k", "s"]).collect() == good.collect()
    bad = dq.no_nulls_in_flow(good.unionByName(spark.createDataFrame([(2, None)], "k int, s string")), ["k", "s"])
    with pytest.raises(Exception, match="nulls found: s"):
        bad.collect()
