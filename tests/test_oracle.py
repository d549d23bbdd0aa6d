"""Every registered query against its SQL oracle on the driver tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, sf_dir, name):
    assert difference(entry.queries()[name](spark, sf_dir), con, entry.oracle_sql()[name]) is None


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "FECHA_SERVICIO" and df.limit(1).count() == 1
