"""Plan shapes: one shuffle where one is enough, pushed-down scans, no product joins."""

import re

from rillstream import fixtures as fx
from rillstream.catalog import all_entries
from rillstream.catalog.cards import ALERTS, DETECT
from rillstream.plans import cards


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan_of(df)))


def test_alert_details_shuffle_once(spark, data_dir):
    df = cards.fraud_alert_details(fx.txn(spark, data_dir), fx.cust(spark, data_dir), ALERTS)
    plan = plan_of(df)
    assert shuffles(df) == 1 and plan.count("Sort [") == 1 and plan.count("Window [") == 1
    assert "PushedFilters: [IsNotNull(ts)]" in plan
    assert "props" not in plan and "c_acctbal" not in plan


def test_five_signals_shuffle_once(spark, data_dir):
    df = cards.flagged_exact(fx.near_txn(spark, data_dir), fx.cust(spark, data_dir), DETECT)
    assert shuffles(df) == 1 and plan_of(df).count("Sort [") <= 2


def test_latest_row_needs_no_window(spark, data_dir):
    from rillstream.operators.relational import latest

    plan = plan_of(latest(fx.txn(spark, data_dir), ["cc_num"], ["ts", "event_id"], ["amt"]))
    assert "Window" not in plan and "partial_max_by" in plan


def test_top_k_is_not_a_global_sort(spark, data_dir):
    plan = plan_of(all_entries()["top_k"].run(spark, data_dir))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_no_product_joins(spark, data_dir):
    allowed = {"replica_count", "workload_cost", "batch_stream_diff"}  # one-row or price-list sides
    for name in ("fraud_alert_details", "signal_gap", "detector_score", "windowed_features", "skim_signals",
                 "calibrate_thresholds", "adjacent_bucket_join", "unauthorized_access"):
        plan = plan_of(all_entries()[name].run(spark, data_dir))
        assert name in allowed or ("CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan), name
