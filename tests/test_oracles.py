"""Every query with an oracle, against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check_oracles import canonical
from conftest import TABLES

ORACLES = contract.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, duck, name):
    got = contract.queries()[name](spark, TABLES)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(names)
    assert canonical(map(tuple, got.select(*names).collect())) == canonical(result.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
