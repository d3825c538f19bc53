"""Plan hygiene of every registered query: no pair-producing joins,
pushed-down watermark predicates, pruned scans."""

import pytest

import __spark_entry__ as E
from txnlake.plans.queries import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, sf_small, key):
    plan = _plan(E.queries()[key](spark, sf_small))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "RoundRobinPartitioning" not in plan


def test_watermark_predicate_reaches_the_scan(spark, sf_small):
    plan = _plan(E.queries()["incr_extract"](spark, sf_small))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "lineitem" in line]
    assert scans and "GreaterThan(l_shipdate" in scans[0]


def test_scans_read_only_needed_columns(spark, sf_small):
    plan = _plan(E.queries()["dq_fk_orphans"](spark, sf_small))
    events = [line for line in plan.splitlines() if "FileScan parquet" in line and "events" in line]
    assert events and all("props" not in line for line in events)
