"""The queries of this subpackage that have SQL, against it on the supplied tables.

The smallest tables by default; TICKLOOM_SF_DIR chooses another folder.
"""

import pytest

from tests import compare
from tests.compare import SF, connect, differences, duck_rows, spark_rows
from tickloom.llm import oracle, queries

QUERIES, SQL = queries.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name, monkeypatch):
    for kind, name_ in {"boolean": "BOOLEAN", "int": "INTEGER"}.items():
        monkeypatch.setitem(compare.SAME, kind, name_)
    spark_side, duck_side = spark_rows(QUERIES[name](spark, SF)), duck_rows(con, SQL[name])
    assert not differences(spark_side, duck_side)
    assert sum(duck_side[2].values()) > 0
