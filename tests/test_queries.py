"""Every registered query against DuckDB on the smallest tables, and the shape of its plan."""

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from lonja.plans import catalog

QUERIES = catalog.queries()
ORACLES = catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_statement(spark, duck, sf, name):
    assert difference(spark, duck, sf, QUERIES[name], ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_statement_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_product_and_no_python(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "EvalPython" not in plan and "InPandas" not in plan and "InArrow" not in plan
    assert "NestedLoop" not in plan


def test_entry_ranks_regions(spark):
    rows = driver.entry(spark).orderBy("puesto").collect()
    assert [r["puesto"] for r in rows] == list(range(1, len(rows) + 1)) and rows
