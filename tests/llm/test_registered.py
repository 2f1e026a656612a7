import pytest
from comparing import assert_same

import __spark_entry__
from inkmill.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE_SQL)
def test_query_equals_its_sql(spark, name):
    assert_same(spark, QUERIES[name], ORACLE_SQL[name], SF)


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert "pipeline" in __spark_entry__.queries()
