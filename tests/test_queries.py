"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry
from tests import oracle
from tidemill.plans import load_queries

PATH = "/root/testdata/sf0.001"
QUERIES = load_queries()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(PATH)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problems = oracle.check(spark, con, QUERIES[name], PATH)
    # A rule may find nothing at this size; the larger data set must give rows.
    assert [p for p in problems if p != "no rows"] == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_sorted_output_is_sorted(spark):
    rows = QUERIES["sort_mixed"].run(spark, PATH).collect()
    keys = [(r.o_orderpriority, -r.o_totalprice, r.o_orderkey) for r in rows]
    assert keys == sorted(keys)
