"""What the physical plans of the registered queries may and may not contain."""

import pytest

from tallyboard.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
# These run jobs of their own before they return a frame.
EAGER = {"stream_", "batch_metrics", "refresh_mapping", "leaderboard_delta_rollup", "leaderboard_closed_days", "leaderboard_user_rank"}
EAGER |= {"usage_log_publish", "usage_log_append", "categorized_publish", "label_attempts"}
# The messages are read once, and once more where distinct keys are resolved apart (in a job before).
SCANS = {"usage_log_set_category": 2, "usage_log_set_category_upper": 2, "categorized_set_category": 2, "categorized_find_many": 2}
SCANS |= {"categorized_new_keys": 2, "usage_log_set_categorized": 2, "matched_updates": 2, "update_counters": 2}
LAZY = sorted(n for n in catalog.all_queries() if not any(n.startswith(e) for e in EAGER))
# Whole-table counts end in one row.
ONE_ROW = {"dictionary_counters", "update_counters"}


@pytest.mark.parametrize("name", LAZY)
def test_plan(spark, name):
    query = catalog.all_queries()[name](spark, SF_DIR)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan and "InPandas" not in plan
    assert plan.count("/events.parquet") <= SCANS.get(name, 1)
    assert ("SinglePartition" in plan) == (name in ONE_ROW)
    # Page text is never needed, so it is never read.
    assert "html" not in plan
