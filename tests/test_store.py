"""The folder connector: round trips, skipped files, bounded writers, and writes that do not finish."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual

from tests import oracle
from tidemill.operators import sets
from tidemill.plans import load_queries
from tidemill.sources import readers, store, writers

SCHEMA = "k long, s string, d date, t timestamp_ntz, n decimal(10,2), x double, a array<int>"


@pytest.fixture()
def options(spark, tmp_path):
    store.register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    yield {"folder": f"file://{tmp_path}"}
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def frame(spark):
    day = datetime.date(2024, 1, 1)
    rows = [(i, f"s{i % 7}", day + datetime.timedelta(i), datetime.datetime(2024, 1, 1, i % 24), Decimal(i) / 4, i / 2, [i, None]) for i in range(200)]
    return spark.createDataFrame([*rows, (None,) * 7], SCHEMA)


def test_round_trip_append_and_overwrite(spark, options):
    df = frame(spark)
    writers.write_connector(df, store.NAME, options, "t")
    assert sets.same_rows(readers.read_connector(spark, store.NAME, options, "t"), df)
    writers.write_connector(df, store.NAME, options, "t", mode="append")
    assert readers.read_connector(spark, store.NAME, options, "t").count() == 402
    writers.write_connector(df.limit(0), store.NAME, options, "t")
    empty = readers.read_connector(spark, store.NAME, options, "t")
    assert empty.count() == 0 and empty.schema == df.schema
    with pytest.raises(Exception, match="no table"):
        readers.read_connector(spark, store.NAME, options, "absent").count()


def test_exactly_n_writers(spark, options):
    writers.write_connector(frame(spark).repartition(9), store.NAME, options, "t", writers=3)
    assert len(store.manifest(f"{options['folder']}/t")["files"]) == 3


def test_pushed_filters(spark, options):
    parts = frame(spark).where("k IS NOT NULL").repartitionByRange(8, "k")
    writers.write_connector(parts, store.NAME, options, "t")
    for test in ("k > 190", "s = 's3' AND k <= 20", "d = DATE '2024-02-01'", "s IN ('s1', 's2')", "k IS NULL", "n >= 49.5", "x < 3 OR k = 100"):
        df = readers.read_connector(spark, store.NAME, options, "t")
        assert sets.same_rows(df.where(test), frame(spark).where("k IS NOT NULL").where(test)), test
    reader = store.StoreReader(f"{options['folder']}/t", df.schema)
    assert not list(reader.pushFilters([GreaterThan(("k",), 190), IsNotNull(("k",))]))
    assert sum(len(p.names) for p in reader.partitions()) == 1
    reader = store.StoreReader(f"{options['folder']}/t", df.schema)
    list(reader.pushFilters([LessThanOrEqual(("k",), 30), In(("k",), (5, 29)), EqualTo(("s",), "s5")]))
    assert sum(len(p.names) for p in reader.partitions()) <= 2


def test_failed_and_late_writes_change_nothing(spark, options):
    df = frame(spark)
    writers.write_connector(df, store.NAME, options, "t")
    uri = f"{options['folder']}/t"
    before = store.manifest(uri)
    bad = df.withColumn("x", F.when(F.col("k") == 150, F.raise_error(F.lit("boom")).cast("double")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="boom"):
        writers.write_connector(bad, store.NAME, options, "t")
    assert store.manifest(uri) == before
    late = store.StoreWriter(uri, df.schema, True)
    writers.write_connector(df, store.NAME, options, "t", mode="append")
    with pytest.raises(RuntimeError):
        late.commit([])
    assert readers.read_connector(spark, store.NAME, options, "t").count() == 402


@pytest.mark.parametrize("name", ["src_connector_table", "sink_connector_modes"])
def test_queries_by_themselves(spark, name):
    """Neither query relies on a setting that another one left behind."""
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    path, q = "/root/testdata/sf0.001", load_queries()[name]
    found, want = q.run(spark, path).toArrow(), oracle.connect(path).execute(q.sql).to_arrow_table()
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert found.num_rows and not oracle.compare(found, want)
