"""Every registered query against its SQL, and the shape of its plan."""

import functools
import re

import pytest

import __spark_entry__ as contract
from checks import queries
from checks.compare import differences, duck

NAMES = [query.__name__ for query in queries.ALL]


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module", autouse=True)
def one_warehouse():
    """The queries over a loaded warehouse share one here; each loads its own outside."""
    loaded = functools.cache(queries._loaded_warehouse)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "_loaded_warehouse", loaded)
        yield


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, connection, name):
    query = contract.queries()[name](spark, sf_dir)
    result = query.toArrow()
    expected = connection.sql(contract.oracle_sql()[name]).arrow().read_all()
    assert differences(result, expected) == ""
    plan = query._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython"):
        assert bad not in plan


def plan_of(spark, sf_dir, name):
    return contract.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_top_one_is_limited_before_the_shuffle(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "dedupe_latest")
    assert re.search(r"row_number\(\), 1, Partial", plan)
    assert plan.count("Exchange") == 1


def test_scans_read_the_needed_columns(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "partition_counts")
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan
    plan = plan_of(spark, sf_dir, "month_range_read")
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "city",
        "day",
        "readings",
        "avg_temperature",
        "min_temperature",
        "max_temperature",
    ]
    assert df.count() > 0
