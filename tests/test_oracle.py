"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()
# Fits with full-size settings that M15 repeats; the correctness run covers them.
SLOW = {"M6_random_forest", "M7_gradient_boosting", "M14_compare_and_select"}
# The queries on whole texts may run Python in their tasks.
TEXT = {n for n in entry.queries() if n.startswith("op") or n == "pipeline"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in entry.queries() if n in ORACLES and n not in SLOW])
def test_agrees_with_sql(spark, con, name):
    plans = []

    def run(spark, d):
        df = entry.queries()[name](spark, d)
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    assert difference(spark, con, run, ORACLES[name], SF_DIR) is None
    assert "CartesianProduct" not in plans[0] and "NestedLoopJoin" not in plans[0]
    assert name in TEXT or not any(p in plans[0] for p in ("EvalPython", "InArrow", "InPandas"))


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in ORACLES and n not in SLOW])
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["measure", "n_a", "n_b", "mean_a", "mean_b", "t", "dof", "p", "verdict"]
    assert df.count() == 2


@pytest.mark.parametrize("name", ["P2_filter_ge", "A5_sum_by_keys_sorted", "A15_welch_t_test"])
def test_scan_reads_only_what_it_needs(spark, name):
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "o_custkey" not in plan.split("ReadSchema:")[1].split("\n")[0]
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
