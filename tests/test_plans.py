"""Plan shape: spatial joins are equi-joins on cells, never nested-loop or cartesian."""

import pytest

import __spark_entry__ as E
from tests.conftest import SMALL

SPATIAL = ["S1_zone_tag", "S1_zone_tag_clockwise", "S2_match_parcel", "S3_first_detection", "S5_outside_bounds", "S7_sync_zone_links", "S8_parcels_at_risk",
           "S8_parcels_at_risk_by_config", "S9_prescribed_by_history", "S1_zone_tag_shapes", "S2_match_parcel_shapes", "S3_first_detection_shapes", "S5_outside_bounds_shapes", "S9_prescribed_by_history_shapes",
           "S10_parcel_zone_flags", "S16_detections_in_risk", "C1_load_detections",
           "P2_upsert_collectivities", "C15_deployment_by_department"]


@pytest.mark.parametrize("key", SPATIAL)
def test_no_nested_loop_or_cartesian(spark, key):
    df = E.queries()[key](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan
    if key.endswith("_shapes"):  # features that are no boxes: still no pair reaches Python
        assert not any(x in plan for x in ("MapInPandas", "MapInArrow", "PythonUDF", "FlatMapGroups"))


def test_load_finds_covered_rows_by_a_search(spark):
    plan = E.queries()["C1_load_detections"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    # earlier detections are met in one join, which ends at the first that covers the row; no pairs are listed
    earlier = [x for x in plan.split("\n") if "Join" in x and "b_seq#" in x]
    assert len(earlier) == 1 and "Join LeftSemi" in earlier[0]


def test_zone_tag_scans_the_features_once(spark):
    plan = E.queries()["S1_zone_tag"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    # boxes need no trapezoids of their own: that branch is planned away
    assert plan.count("FileScan parquet") == 1 and "Union" not in plan and "Python" not in plan


def test_cohort_report_scans_detections_once_per_pass(spark):
    df = E.queries()["C8_evolution_epci"](spark, SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # presence pass: one aggregate over (zone, parcel), then one per zone — not a self join per period
    assert plan.count("Join LeftAnti") == 0
