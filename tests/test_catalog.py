"""Every registered query against its SQL; queries without SQL must give rows."""

import pytest
from conftest import SF

from cohortlens.catalog import ORACLES, QUERIES
from tools.check import compare, connect


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) == "ok"


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
