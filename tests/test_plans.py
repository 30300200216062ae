"""Plan checks: no cartesian products, pruned scans, no window without PARTITION BY."""

import pytest

from leadlens import registry
from tests.conftest import SF_SMALL

registry.load_all()
QUERIES = dict(registry.QUERIES)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan, name
    assert "NestedLoopJoin" not in plan, name
    assert "Window [" not in plan or "windowspecdefinition(specifiedwindowframe" not in plan, name
    for line in plan.splitlines():
        if "Window [" in line:
            # every window must carry a PARTITION BY list
            tail = line.split("], [", 1)
            assert len(tail) == 2 and not tail[1].startswith("]"), (name, line)


def test_scan_prunes_columns(spark):
    spark.conf.set("leadlens.staging.enabled", "false")  # plan from the raw tables
    try:
        plan = _plan(QUERIES["m02_lead_to_booking"](spark, SF_SMALL))
    finally:
        spark.conf.set("leadlens.staging.enabled", "true")
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l and "lineitem" in l]
    assert scans and all("l_comment" not in s and "l_tax" not in s for s in scans)


def test_dimensions_are_broadcast(spark):
    for name in ["n04_map_stage", "t06_current_funnel", "t05_group_transitions"]:
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, name


def test_flagship_reads_staging_not_raw(spark):
    plan = _plan(QUERIES["m02_lead_to_booking"](spark, SF_SMALL))
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l or "Scan parquet" in l]
    assert scans and all("leadlens-staging" in l or "leads_booked" in l for l in scans), scans
    assert "lineitem" not in plan and "orders" not in plan
