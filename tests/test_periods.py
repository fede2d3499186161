"""Period expansion in two steps."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemill.operators import calendar as cal

STEPS = {"second": datetime.timedelta(seconds=1), "minute": datetime.timedelta(minutes=1), "hour": datetime.timedelta(hours=1), "day": datetime.timedelta(days=1)}


@pytest.mark.parametrize("unit", list(STEPS))
def test_equals_plain_steps(spark, unit):
    at = datetime.datetime
    spans = {"second": (at(2023, 12, 31, 23, 59, 58, 500000), at(2024, 1, 1, 0, 0, 3)), "minute": (at(2024, 2, 28, 23, 0), at(2024, 3, 1, 1, 0, 30)),
             "hour": (at(2023, 12, 30, 5, 30), at(2024, 2, 2)), "day": (at(2022, 12, 30, 5), at(2024, 1, 2, 0, 0, 1))}
    b, e = spans[unit]
    rows = [(1, b, e), (2, b, b), (3, e, b), (4, None, e), (5, b, b + datetime.timedelta(microseconds=1))]
    df = spark.createDataFrame(rows, "k long, b timestamp_ntz, e timestamp_ntz")
    got = {}
    for r in cal.expand_period(df, "b", "e", unit).collect():
        got.setdefault(r.k, []).append((r.seq, r.unit_at))
    begin = b.replace(microsecond=0, second=0 if unit != "second" else b.second, minute=0 if unit in ("hour", "day") else b.minute, hour=0 if unit == "day" else b.hour)
    want, moment = [], begin
    while moment < e:
        want.append((len(want), moment))
        moment += STEPS[unit]
    assert sorted(got.pop(1)) == want
    assert got == {5: [(0, begin)]}


def test_long_periods_hold_no_long_array(spark):
    """Ten years by second: the blocks are days, and one day of them is expanded."""
    df = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ '2014-01-01 00:00:00' AS b, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS e")
    out = cal.expand_period(df, "b", "e", "second")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2
    some = cal.expand_period(df.withColumn("b", F.expr("e - interval 20 days")), "b", "e", "second").agg(F.count("*"), F.max("seq")).first()
    assert tuple(some) == (20 * 86400, 20 * 86400 - 1)
