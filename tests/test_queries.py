"""Every registered query against its SQL in DuckDB; without SQL it must return rows."""

import pytest

import __spark_entry__ as entry
from validation.compare import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    result = compare(spark, con, QUERIES[name], ORACLES.get(name), sf_dir)
    assert result["status"] in ("match", "rows-only"), result
    if result["status"] == "rows-only":
        assert result["rows"] > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
