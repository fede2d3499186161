"""Published versions: atomic switch, window replace, repeats and conflicts."""

import pytest
from pyspark.sql import functions as F

from tests.oracle import connect
from tidemill.operators import sets
from tidemill.plans import load_queries
from tidemill.sources.versions import Conflict, VersionedTable

PATH = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_publish_append_and_older_versions(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    with pytest.raises(ValueError):
        table.read()
    one = spark.createDataFrame([(1, "a"), (2, None)], "k long, s string")
    assert table.publish(one) == 1 and table.append(one) == 2
    assert table.read().count() == 4 and rows(table.read(1)) == rows(one)
    assert table.publish(one.limit(0)) == 3
    assert table.read().count() == 0 and table.read().schema == one.schema and table.read(2).count() == 4


def test_window_replace_twice_changes_nothing(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", part_by="m")
    months = [f"2024-{m:02d}" for m in range(1, 7)]
    first = spark.createDataFrame([(i, months[i % 6]) for i in range(60)] + [(99, None)], "k long, m string")
    table.publish(first)
    batch = spark.createDataFrame([(1000 + i, months[4]) for i in range(3)], "k long, m string")
    for _ in range(2):
        table.replace_from(batch, "2024-04")
        want = first.where("m < '2024-04' OR m IS NULL").unionByName(batch)
        assert sets.same_rows(table.read(), want)
    # Parts outside the window are the same files.
    outside = lambda v: {p["path"] for p in table.manifest(v)["parts"] if p["value"] is None or p["value"] < "2024-04"}
    assert outside(1) == outside(3)
    with pytest.raises(ValueError):
        table.replace_from(first, "2024-04")


def test_two_writers_cannot_both_win(spark, tmp_path):
    one, two = (VersionedTable(spark, f"file://{tmp_path}/t") for _ in range(2))
    df = spark.range(3)
    one.publish(df)
    before = two.manifest()["version"]
    one.append(df)
    with pytest.raises(Conflict):
        two._commit(before, df.schema, [])
    assert one.read().count() == 6


def test_readers_push_filters(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    table.publish(spark.range(100).withColumn("s", F.lit("x")))
    plan = table.read().where("id > 90").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(id,90)" in plan and "ReadSchema: struct<id:bigint>" in plan


@pytest.mark.parametrize("name", ["pipe_monthly_spend", "pipe_kpi_stars"])
def test_jobs_return_what_they_published(spark, name):
    out = load_queries()[name].run(spark, PATH)
    assert all("/data-" in f for f in out.inputFiles())
    assert out.count() == connect(PATH).sql(load_queries()[name].sql).to_arrow_table().num_rows
