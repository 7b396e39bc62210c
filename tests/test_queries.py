"""Every registered query of the warehouse against its SQL."""

import re

import pytest
from oracle import connect, same

from ledgerforge.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


#: Queries that order a row for each day or block in one task.
FEW_ROWS = {"empty_runs"}


def alone(df) -> list[str]:
    """What goes to a single task, but for aggregates without keys, which are combined before, and the sizes of range pieces."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    below = [lines[i + 1] for i, line in enumerate(lines[:-1]) if "Exchange SinglePartition" in line]
    return [x for x in below if not re.search(r"Aggregate\(keys=\[(_piece#\d+L?)?\], functions=\[(partial|merge|count)", x)] + [x for x in lines if "CartesianProduct" in x]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, sf_dir, con, name):
    found = QUERIES[name](spark, sf_dir)
    same(found, con, ORACLES[name])
    one_task = alone(found)
    assert not one_task or name in FEW_ROWS, one_task


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_again_alike(spark, sf_dir, name):
    first, second = (sorted(map(tuple, QUERIES[name](spark, sf_dir).collect())) for _ in range(2))
    assert first == second and first


def test_entry_module(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_uses_are_combined_before_the_join(spark, sf_dir):
    plan = QUERIES["unused_endpoints"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    join = next(i for i, line in enumerate(plan.split("\n")) if "LeftAnti" in line)
    right = [line for line in plan.split("\n")[join + 1 :] if line.split("Aggregate")[0].strip(" :") == "+-"]
    assert any("Aggregate [" in line for line in right), plan


def test_the_report_reads_the_rows_few_times(spark, sf_dir):
    plan = QUERIES["ranking_quality_report"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < sum("Relation" in line and "l_orderkey" in line for line in plan.split("\n")) <= 10
