import pytest

import __spark_entry__ as registry
from tests.compare import SF, spark_rows
from tests.plain import PLAIN
from tickloom.plans.market import Market


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_same_rows_as_the_join_form(spark, name):
    ours = spark_rows(registry.queries()[name](spark, SF))
    plain = spark_rows(PLAIN[name](Market(spark, SF)))
    assert ours[0] == plain[0]
    assert ours[2] == plain[2]
