"""Physical-plan properties: pushdown, pruning, one exchange for all windows."""

from fixtures import SF_SMALL
from daycast import registry as R
from daycast.operators.rollup import daily_rollup
from daycast.sources import testdata as td


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_scan_pushes_timestamp_range_and_prunes_columns(spark):
    df = daily_rollup(td.blocks(spark, SF_SMALL), "1996-03-01", "1998-08-31")
    plan = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(l_shipdate,1996-03-01T00:00)" in plan
    assert "LessThan(l_shipdate,1998-09-01T00:00)" in plan
    assert "l_orderkey" not in plan and "l_returnflag" not in plan     # column pruning
    assert "partial_sum" in plan                                       # map-side combine


def test_feature_windows_share_one_exchange(spark):
    ft = R.QUERIES["feature_table"](spark, SF_SMALL)
    plan = _plan(ft)
    # exchanges: roll-up shuffle, price aggregate, (broadcast), one for all windows
    window_nodes = plan.count("Window [")
    assert window_nodes == 4                                           # fill + 3 feature levels
    sorts = plan.count("Sort [")
    assert sorts == 1                                                  # one sort feeds every window


def test_keyed_windows_partition_by_series(spark):
    plan = _plan(R.QUERIES["feature_table_keyed"](spark, SF_SMALL))
    assert "hashpartitioning(series" in plan


def test_no_cross_or_nested_loop_joins(spark):
    for key in ("feature_table", "residual_histogram", "report_scatter", "month_partitioned",
                "price_source", "report_overlay"):
        plan = _plan(R.QUERIES[key](spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_bucketed_windows_avoid_single_partition(spark):
    plan = _plan(R.QUERIES["feature_table_bucketed"](spark, SF_SMALL))
    assert "hashpartitioning(_bucket" in plan
    window_part = plan.split("Window [", 1)[1]
    assert "SinglePartition" not in window_part.split("Window [")[0]
    plain = _plan(R.QUERIES["feature_table"](spark, SF_SMALL))
    assert "SinglePartition" in plain                    # the unkeyed plain mode: one partition
