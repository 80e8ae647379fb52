"""Every query with SQL gives the rows that DuckDB gives."""

import pytest

from compare import difference, duck
from wavesym.catalog import QUERIES
from wavesym.oracle import ORACLE_SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_sql_only_for_known_queries():
    # the draws of a forest are more than SQL states; tests/test_forest.py applies its trees
    assert set(ORACLE_SQL) == set(QUERIES) - {"rf_score"}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, ORACLE_SQL[name]) is None
