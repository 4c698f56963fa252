"""Trailing windows, previous rows and the hot-key plan against brute force."""

import random
from datetime import timedelta
from decimal import Decimal

import brute
import numpy as np
import pandas as pd
import pytest
from brute import TXN_DDL, at, txn_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillstream.operators import windows as win
from rillstream.operators.relational import adjacent_buckets
from rillstream.skew import split_hot

EDGES = [
    txn_row(1, 7, "2024-01-01 00:00:00", "gift card", "10.00"),
    txn_row(2, 7, "2024-01-31 00:00:00", "gift card", "5.00"),  # exactly on the 30-day horizon of row 1
    txn_row(3, 7, "2024-01-31 00:00:00.000001", "gift card", "2.50"),  # one microsecond outside
    txn_row(4, 7, "2024-01-31 00:00:00", "grocery", None),  # peer of row 2, no amount
    txn_row(5, 7, "2024-02-10 00:00:00", "gift card", "1.00"),  # 30 to 45 days after row 1
    txn_row(6, 7, "2024-06-01 00:00:00", "gift card", "3.00"),  # long gap
    txn_row(7, 8, "2024-01-31 00:00:00", "grocery", None),
]
SPECS = {
    "n30": win.Trailing(win.days(30)),
    "gifts45": win.Trailing(win.days(45), where="category = 'gift card'"),
    "sum30": win.Trailing(win.days(30), "sum", "amt"),
    "gift_sum30": win.Trailing(win.days(30), "sum", "amt", "category = 'gift card'"),
    "avg30": win.Trailing(win.days(30), "avg", "amt"),
}
COLS = ["event_id", *SPECS]


def expected(rows):
    dicts = [dict(zip(["event_id", "cc_num", "ts", "category", "amt"], r)) for r in rows]
    gift = lambda r: r["category"] == "gift card"
    w30 = brute.trailing(dicts, "cc_num", "ts", timedelta(days=30))
    g45 = brute.trailing(dicts, "cc_num", "ts", timedelta(days=45), gift)
    out = {}
    for r, w, g in zip(dicts, w30, g45):
        amts = [x["amt"] for x in w if x["amt"] is not None]
        cased = [x["amt"] if gift(x) else Decimal(0) for x in w]
        cased = [a for a in cased if a is not None]
        out[r["event_id"]] = (
            len(w), len(g), sum(amts) if amts else None, sum(cased) if cased else None,
            float(sum(amts)) / len(amts) if amts else None)
    return out


def collected(df):
    return {
        r.event_id: (r.n30, r.gifts45, r.sum30, r.gift_sum30, r.avg30) for r in df.select(*COLS).collect()
    }


@pytest.mark.parametrize("hot_rows", [None, 0, 2])
def test_rolling_edges(spark, hot_rows):
    df = spark.createDataFrame(EDGES, TXN_DDL)
    got = collected(win.rolling(df, ["cc_num"], "ts", SPECS, hot_rows))
    assert got == expected(EDGES)


def random_rows(seed, n, third_on=None):
    rnd = random.Random(seed)
    base = at("2024-01-01 00:00:00")
    rows = []
    for i in range(n):
        cc = third_on if third_on is not None and i % 3 == 0 else rnd.randrange(6)
        ts = base + timedelta(hours=rnd.randrange(24 * 90))
        rows.append(txn_row(i, cc, ts, rnd.choice(["gift card", "games"]), rnd.choice([None, "1.10", "2.35"])))
    return rows


def test_hot_key_plan_equals_plain_plan(spark):
    """A key with a third of all rows goes through the sliced plan; results are the same."""
    rows = random_rows(1, 900, third_on=99)
    df = spark.createDataFrame(rows, TXN_DDL)
    parts = split_hot(df, ["cc_num"], win.time_axis(df, "ts"), 250)
    assert parts.n_keys == 1 and parts.hot.count() == 300 and parts.cold.count() == 600
    assert collected(win.rolling(df, ["cc_num"], "ts", SPECS, 250)) == expected(rows)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10_000))
def test_rolling_random(spark, seed):
    rows = random_rows(seed, 60)
    df = spark.createDataFrame(rows, TXN_DDL)
    for limit in (None, 0):
        assert collected(win.rolling(df, ["cc_num"], "ts", SPECS, limit)) == expected(rows)


def test_null_key_and_null_time(spark):
    rows = EDGES + [(8, None, at("2024-01-05"), "games", Decimal("4.00"), 0.0, 0.0), (9, 7, None, "games", Decimal("6.00"), 0.0, 0.0)]
    df = spark.createDataFrame(rows, TXN_DDL)
    plain = collected(win.rolling(df, ["cc_num"], "ts", SPECS, None))
    assert plain[8] == (1, 0, Decimal("4.00"), Decimal("0.00"), 4.0)
    assert collected(win.rolling(df, ["cc_num"], "ts", SPECS, 1)) == plain


def test_seconds_axis(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 1, 100), (3, 1, 101)], "id int, k int, sec bigint")
    got = {r.id: r.n for r in win.rolling(df, ["k"], "sec", {"n": win.Trailing(100)}).collect()}
    assert got == {1: 1, 2: 2, 3: 2}


def test_double_sums_are_refused(spark):
    df = spark.createDataFrame([(1, 1, 0.5)], "k int, sec bigint, x double")
    with pytest.raises(TypeError, match="DECIMAL"):
        win.rolling(df, ["k"], "sec", {"s": win.Trailing(10, "sum", "x")})


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_lag_ties(spark, hot_rows):
    rows = random_rows(3, 150) + [
        txn_row(1001, 50, "2024-01-01 00:00:00"), txn_row(1000, 50, "2024-01-01 00:00:00"),  # ids decide
        txn_row(1002, 50, "2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, TXN_DDL)
    out = win.lag_cols(df, ["cc_num"], "ts", {"pid": "event_id", "pts": "ts"}, "event_id", hot_rows)
    dicts = [dict(zip(["event_id", "cc_num", "ts"], r)) for r in rows]
    want = {
        r["event_id"]: (p and p["event_id"], p and p["ts"])
        for r, p in zip(dicts, brute.previous(dicts, "cc_num", "ts", "event_id"))}
    assert {r.event_id: (r.pid, r.pts) for r in out.collect()} == want


def test_adjacent_buckets(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("a", 4, 1), ("b", 3, 2)], "k string, b bigint, n bigint")
    got = {(r.k, r.b): r.n2 for r in adjacent_buckets(df, "k", "b").collect()}
    assert got == {("a", 1): 5, ("a", 2): 12, ("a", 4): 1, ("b", 3): 2}


def test_hop_edge_and_single_row(spark):
    from rillstream.plans.features import windowed

    df = spark.createDataFrame(
        [("1", at("2024-01-01 04:00:00"), Decimal("3.00"))], "cc_num string, date_time timestamp_ntz, amount decimal(38,2)")
    rows = windowed(df, keep_window=True).collect()
    assert sorted(r.window_start.hour for r in rows) == [1, 2, 3, 4]
    assert all(r.stddev_amt == 0.0 and r.trans == 1 and r.avg_amt == 3.0 for r in rows)


@pytest.mark.parametrize(("size", "slide", "k"), [("4 hours", "1 hour", 4), ("90 minutes", "30 minutes", 3), ("1 day", "1 day", 1)])
def test_panes_equal_every_window_by_itself(spark, size, slide, k):
    """Equal and missing amounts, gaps, repeated events, events without a time or key."""
    from rillstream.plans.features import windowed

    rnd = random.Random(k)
    start = at("2024-02-28 22:00:00")
    rows = [(rnd.choice(["a", "b"]), start + timedelta(minutes=rnd.randrange(3000)), rnd.choice([None, Decimal("7.10"), Decimal("123456.78")]))
            for _ in range(120)]
    rows += rows[:5] + [("c", start, None), ("c", start + timedelta(hours=9), Decimal("0.10")), (None, start, Decimal(1)), ("a", None, Decimal(1))]
    df = spark.createDataFrame(rows, "cc_num string, date_time timestamp_ntz, amount decimal(38,2)")
    got = sorted((r.cc_num, r.date_time, r.window_start, r.trans, r.avg_amt, r.stddev_amt) for r in
                 windowed(df, size, slide, keep_window=True).withColumns(
                     {"avg_amt": F.coalesce("avg_amt", F.lit(-1.0))}).collect())
    step, reach, zero, want = pd.Timedelta(slide), pd.Timedelta(size), at("1970-01-01"), []
    for key, t, _ in rows:
        if key is None or t is None:
            continue
        last = zero + ((t - zero) // step) * step
        for w in (last - j * step for j in range(k)):
            inside = [v for c, u, v in rows if c == key and u is not None and w <= u < w + reach]
            values = [float(v) for v in inside if v is not None]
            want.append((key, t, w, len(inside), np.mean(values) if values else -1.0, np.std(values, ddof=1) if len(values) > 1 else 0.0))
    want.sort()
    assert [g[:4] for g in got] == [tuple(x[:4]) for x in want]
    assert np.allclose([g[4:] for g in got], [x[4:] for x in want], rtol=1e-12, atol=1e-9)


def test_window_stats_multiply_rows_only_after_the_last_shuffle(spark):
    from rillstream.plans.features import windowed

    df = spark.createDataFrame([("a", at("2024-01-01"), Decimal(1))], "cc_num string, date_time timestamp_ntz, amount decimal(38,2)")
    plan = windowed(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate ") == 1 and "Expand" not in plan
    assert plan.index("Generate ") < plan.index("Exchange") and plan.count("Sort [") <= 4


def test_distinct_sketch_error(spark):
    from rillstream.operators.relational import count_distinct, estimate, sketch

    df = spark.range(40_000).selectExpr("id % 4 AS k", "id % 20000 AS v", "id % 7 AS block")
    merged = {r.k: r.estimate for r in estimate(sketch(df, ["k", "block"], ["v"]), ["k"]).collect()}
    exact = {r.k: r.n for r in count_distinct(df, ["k"], ["v"]).collect()}
    assert all(abs(merged[k] - exact[k]) <= 0.05 * exact[k] for k in exact)


def test_asof_join(spark):
    from rillstream.operators.relational import asof_latest

    rnd = random.Random(5)
    base = at("2024-01-01")
    left = [(i, rnd.randrange(3), base + timedelta(hours=rnd.randrange(200))) for i in range(80)]
    right = [(rnd.randrange(3), base + timedelta(hours=rnd.randrange(200)), i) for i in range(40)]
    a = spark.createDataFrame(left, "id int, k int, ts timestamp_ntz")
    b = spark.createDataFrame(right, "k int, ts timestamp_ntz, v int")
    got = {r.id: r.v for r in asof_latest(a, b, "k", "ts", ["v"]).collect()}
    for i, k, ts in left:
        seen = [(t, v) for kk, t, v in right if kk == k and t <= ts]
        assert got[i] == (max(seen)[1] if seen else None)
