"""Physical-plan properties: pruning, pushdown, no single-partition work on full rows, no Python UDFs."""

import pytest

from tests.conftest import SF_SMALL

import __spark_entry__ as entry_mod


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    return entry_mod.queries()


def test_scan_is_pruned_and_filter_pushed(spark, qs):
    plan = _plan(qs["store_daily_sales"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,0.0)" in plan
    li = [ln for ln in plan.split("\n") if "lineitem.parquet" in ln and "ReadSchema" in ln]
    assert li and all("l_tax" not in ln and "l_returnflag" not in ln for ln in li)


def test_lines_are_scanned_once(spark, qs):
    for name in ("daily_sales", "store_daily_sales"):
        plan = _plan(qs[name](spark, SF_SMALL))
        assert plan.count("lineitem.parquet") == 1, name


def test_no_headline_query_plans_the_lines_twice(spark, qs):
    from bench import HEADLINE

    for name in HEADLINE + ["expanding_folds", "fold_scores"]:
        plan = _plan(qs[name](spark, SF_SMALL)).split("== Initial Plan ==")[-1]
        assert plan.count("lineitem.parquet") <= 1, name


def _single_partition_inputs(plan):
    """Nodes right below an exchange that sends all rows to one task."""
    lines = plan.split("\n")
    return [b for a, b in zip(lines, lines[1:]) if "SinglePartition" in a]


@pytest.mark.parametrize("name", ["lag_features", "rolling_features", "fill_grouped", "chronological_split",
                                  "rolling_metrics", "outlier_summary", "label_encoding", "qq_points"])
def test_no_python_and_no_single_partition_on_rows(spark, qs, name):
    df = qs[name](spark, SF_SMALL)
    plan = _plan(df)
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    # only aggregated frames (counts per bucket, partial totals) may meet in one task
    for below in _single_partition_inputs(plan):
        assert "Aggregate" in below or "Project" in below, below


def test_feature_windows_share_one_exchange(spark):
    from retailcast.operators import features, rollups
    sd = rollups.store_days(spark, SF_SMALL).select("date", "store_id", "sales")
    out = features.lag_and_rolling(sd, "sales", ["store_id"], chunk_rows=None)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # all 32 lag/rolling columns come from windows over the same partitioning
    assert plan.count("Window [") <= 3
