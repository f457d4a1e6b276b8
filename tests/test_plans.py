"""Plan properties that matter at scale, asserted on executed (final) plans."""

import pytest

from conftest import SF0001
from cardflow.registry import QUERIES


def _final_plan(df) -> str:
    df.collect()  # runs this plan, so the adaptive plan is final
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.mark.parametrize("name", ["customer_rejects", "transaction_rejects", "intermediate",
                                  "report_previous_transaction", "stage_counts"])
def test_no_python_in_plans(spark, name):
    plan = _final_plan(QUERIES[name](spark, SF0001))
    for marker in ("EvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert marker not in plan


def test_dedup_scans_once(spark):
    """No key is hot here, so what remains is one scan, one shuffle for the
    distinct rows and one for the window."""
    plan = _final_plan(QUERIES["transaction_rejects"](spark, SF0001))
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = _final_plan(QUERIES["transaction_rejects"](spark, SF0001))
    scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
    assert "o_orderstatus" not in scan          # unused column pruned at the scan


def test_previous_card_lag_is_range_partitioned(spark):
    """The window over the data and the ends of the ranges are written before they
    are joined: what is left is a scan and a broadcast join."""
    plan = _final_plan(QUERIES["window_lag"](spark, SF0001))
    assert "Window [" not in plan and "hashpartitioning" not in plan
    assert "BroadcastHashJoin" in plan or "Join" not in plan
