import pytest

import __spark_entry__ as entry
import oracle
from shelfmark import workload


@pytest.fixture(scope="module")
def duck(small):
    return oracle.connect(small)


@pytest.mark.parametrize("name", sorted(workload.QUERIES))
def test_query_equals_sql(spark, small, duck, name):
    sql = entry.oracle_sql()
    assert name in sql, "every query has its SQL"
    df = entry.queries()[name](spark, small)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "PythonUDF" not in plan and "Join Cross" not in plan
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in physical and "NestedLoop" not in physical
    assert oracle.compare(df, duck, sql[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
