import pytest
from compare import difference

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf, name):
    rows, problem = difference(spark, sf, QUERIES[name], ORACLES[name])
    assert not problem and (rows > 0 or name.startswith("p4") or name.startswith("e7"))


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
