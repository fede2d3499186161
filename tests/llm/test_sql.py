"""Queries of the package against their SQL, and the empty table."""

import pytest

from tests import oracle
from tidemill.llm import queries

PATH = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.SQL))
def test_sql(spark, name):
    got = queries.QUERIES[name](spark, PATH).toArrow()
    assert got.num_rows
    assert oracle.compare(got, oracle.connect(PATH).sql(queries.SQL[name]).to_arrow_table()) == []


def test_every_operator_has_a_query():
    numbers = {name.split("_")[0] for name in queries.QUERIES}
    assert numbers == {f"op{n}" for n in range(1, 14)} | {"pipeline"}
