import pytest

from conftest import DATA
from quorate.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, same_rows, name):
    same_rows(QUERIES[name](spark, DATA), ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_no_pair_of_all_rows(spark):
    """No nested-loop or Cartesian join, but for one-row tables that are broadcast."""
    small = {"two_earliest_errors", "claimed_first_events", "refresh_queue", "diff_profile"}
    for name, run in QUERIES.items():
        if name not in small:
            plan = run(spark, DATA)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
