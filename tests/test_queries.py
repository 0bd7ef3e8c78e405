"""Every query against its SQL, and what no plan may contain."""

import pytest

import check
from __spark_entry__ import entry
from abacist.queries import CHECKS, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    wanted = duck.sql(CHECKS[name])
    assert check.compare(result.toPandas(), wanted.df()) is None
    assert check.compare_types(result, wanted) is None
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


PYTHON_QUERIES = {
    "batch_responses",
    "sampled_responses",
    "generated_pairs",
    "evaluated_models",
    "chosen_submission",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PYTHON_QUERIES))
def test_only_generators_run_python(spark, sf_dir, name):
    if name in {"streamed_pairs", "resumed_training_tables", "final_training_table"}:
        pytest.skip("the written table is read back")
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_entry_is_the_ranked_table(spark):
    rows = entry(spark).collect()
    assert [r.place for r in rows] == [1, 2, 3, 4]
    assert all(a.accuracy >= b.accuracy for a, b in zip(rows, rows[1:]))


def test_scans_read_only_needed_columns(spark, sf_dir):
    plan = QUERIES["group_objectives"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "o_orderdate" not in plan
