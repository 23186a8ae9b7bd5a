"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import oracle

# Training-data queries have tests of their own.
QUERIES, SQL = (
    {name: value for name, value in found.items() if name.startswith("q_")}
    for found in (contract.queries(), contract.oracle_sql())
)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def duck(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, duck, name):
    got = oracle.spark_rows(QUERIES[name](spark, small))
    want = oracle.duck(duck, SQL[name])
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1], "nothing was compared"


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.count() == 15


def test_every_health_score_occurs(spark, small):
    rows = QUERIES["q_device_health"](spark, small).select("health_score").distinct()
    assert {r.health_score for r in rows.collect()} == {0, 20, 40, 60, 80, 100}
