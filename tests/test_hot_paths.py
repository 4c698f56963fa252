"""The hot-key plans give the answers of the plain ones, also on NULL keys, times and ids, repeated ids and bursts."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rillstream import skew
from rillstream.operators.relational import asof_latest
from rillstream.operators.windows import Trailing, days, engagement, lag_cols, rolling, time_axis
from rillstream.params import AlertParams, DetectorParams
from rillstream.plans import cards
from rillstream.skew import split_hot

DDL = ("event_id bigint, cc_num bigint, ts timestamp_ntz, amt decimal(38,2), category string, "
       "shipping_lat double, shipping_long double")


def awkward(spark):
    rows, at = [], datetime(2024, 1, 1)
    for k in range(60):
        card = (1, 2, None)[k % 3]
        ts = None if k % 20 == 7 else at if k % 4 == 0 else at + timedelta(hours=5 * k)
        event = None if k % 9 == 4 else k // 2  # NULL and repeated ids
        rows.append((event, card, ts, None if k % 11 == 3 else Decimal(k) + Decimal("0.25"),
                     "gift card" if k % 2 else "games", 30.0 + k % 5, -100.0 - k % 7))
    return spark.createDataFrame(rows, DDL), spark.createDataFrame(
        [(1, "a", 25.0, -120.0), (2, "b", None, -100.0)], "cc_num bigint, name string, lat double, long double")


def bag(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("limit", [0, 2])
def test_hot_plans_equal_plain_plans(spark, limit):
    txn, cust = awkward(spark)
    specs = {"n": Trailing(days(2)), "s": Trailing(days(2), "sum", "amt"), "a": Trailing(days(3), "avg", "amt")}
    assert bag(rolling(txn, ["cc_num"], "ts", specs, limit)) == bag(rolling(txn, ["cc_num"], "ts", specs, None))
    low = DetectorParams(gift_30d=3, velocity_7d=4, displaced_3d=2, fan_out_day=2)
    for build in (lambda h: cards.card_signals(txn, cust, low, h), lambda h: cards.flagged_exact(txn, cust, low, h),
                  lambda h: cards.alert_aggregates(txn, cust, AlertParams(), h),
                  lambda h: cards.enrich_1day(txn, cust, hot_rows=h),
                  lambda h: engagement(txn.withColumn("w", F.col("event_id").cast("int")), "cc_num", "ts", "w", h)):
        assert bag(build(limit)) == bag(build(None))
    order = txn.withColumn("tie", F.struct("event_id", "amt", "category"))
    assert bag(lag_cols(order, ["cc_num"], "ts", {"p": "amt"}, "tie", limit)) == bag(
        lag_cols(order, ["cc_num"], "ts", {"p": "amt"}, "tie", None))


@pytest.mark.parametrize("rows_per_slice", [3, 17])
def test_slices_of_a_hot_key_follow_its_density(spark, monkeypatch, rows_per_slice):
    """A burst of different times inside a sparse year goes into many slices, and all plans agree."""
    monkeypatch.setattr(skew, "SLICE_ROWS", rows_per_slice)
    start = datetime(2024, 1, 1)
    times = [start + timedelta(days=k) for k in range(40)] + [start + timedelta(days=9, seconds=k) for k in range(160)]
    df = spark.createDataFrame([(k, 1, t) for k, t in enumerate(times)], "event_id int, cc_num int, ts timestamp_ntz")
    hot = split_hot(df, ["cc_num"], time_axis(df, "ts"), 10).hot
    depth = [r["count"] for r in skew.equi_depth(hot.withColumn("at", time_axis(df, "ts")), ["cc_num"], "at").groupBy(
        "__slice").count().collect()]
    assert len(depth) > 150 / rows_per_slice and max(depth) <= 2 * rows_per_slice
    specs = {"n": Trailing(days(2)), "m": Trailing(timedelta(seconds=30))}
    assert bag(rolling(df, ["cc_num"], "ts", specs, 10)) == bag(rolling(df, ["cc_num"], "ts", specs, None))
    assert bag(lag_cols(df, ["cc_num"], "ts", {"p": "ts"}, "event_id", 10)) == bag(
        lag_cols(df, ["cc_num"], "ts", {"p": "ts"}, "event_id", None))


def test_a_null_key_can_be_hot(spark):
    txn, _ = awkward(spark)
    parts = split_hot(txn.filter("cc_num is null"), ["cc_num"], F.col("event_id"), 3)
    assert (parts.hot.count(), parts.cold.count()) == (20, 0)


def test_asof_keeps_every_left_row(spark):
    at = datetime(2024, 1, 1)
    left = spark.createDataFrame([(1, 1, at), (2, None, at), (3, 1, None)], "id int, k int, ts timestamp_ntz")
    right = spark.createDataFrame([(1, at, 5), (None, at, 6), (1, None, 7)], "k int, ts timestamp_ntz, v int")
    assert {(r.id, r.v) for r in asof_latest(left, right, "k", "ts", ["v"]).collect()} == {(1, 5), (2, None), (3, None)}
