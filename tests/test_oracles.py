"""Every registered query next to its SQL text on the same files."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks import runner
from conftest import SF

QUERIES, ORACLES = queries(), oracle_sql()
ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def duck():
    con = runner.connect(SF)
    yield con
    con.close()


def test_flagship(spark):
    assert entry(spark).schema.names[:3] == ["ClientId", "Timestamp", "LoadEnergyCalculated_15"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    same, message = runner.compare(QUERIES[name](spark, SF), duck, ORACLES[name])
    assert same, message


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
