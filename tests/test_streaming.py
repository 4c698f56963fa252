"""Any sequence of micro-batches ends in the state of one batch run."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from brute import CUST_DDL, TXN_DDL, at, schema, txn_row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstream.operators import windows as win
from rillstream.params import AlertParams
from rillstream.plans import cards
from rillstream.sources import files
from rillstream.streaming import maintain as mt
from rillstream.streaming import streams as st
from rillstream.streaming.cards import CardAlertMaintainer
from rillstream.streaming.store import History, KeyedStore

TXN = schema(TXN_DDL)
SPECS = {
    "n_3d": win.Trailing(win.days(3)), "sum_9d": win.Trailing(win.days(9), "sum", "amt"),
    "gifts": win.Trailing(win.days(9), where="category = 'gift card'")}


def shuffled_batches(seed, n=90, pieces=4):
    """Rows whose order is disturbed by up to five days, cut into random pieces."""
    rnd = random.Random(seed)
    rows = [
        txn_row(i, rnd.randrange(5), at("2024-01-01") + timedelta(hours=rnd.randrange(24 * 60)),
                rnd.choice(["gift card", "games"]), rnd.choice(["1.10", "2.35", None]), rnd.uniform(0, 40), 0.0)
        for i in range(n)]
    rows.sort(key=lambda r: r[2] + timedelta(days=rnd.uniform(0, 5)))
    cuts = sorted(rnd.sample(range(1, n), pieces - 1))
    return rows, [rows[a:b] for a, b in zip([0, *cuts], [*cuts, n])]


def bag(df, cols):
    return sorted(map(str, df.select(*cols).collect()))


@pytest.mark.parametrize(("seed", "span"), [(1, None), (2, win.days(2)), (3, win.days(30))])
def test_rolling_and_lag_batch_equals_stream(spark, tmp_path, seed, span):
    rows, batches = shuffled_batches(seed)
    keys = ["cc_num", "ts", "event_id"]
    whole = spark.createDataFrame(rows, TXN)
    roll_shape = T.StructType.fromDDL("cc_num bigint, ts timestamp_ntz, event_id bigint, n_3d bigint, sum_9d decimal(38,2), gifts bigint")
    lag_shape = T.StructType.fromDDL("cc_num bigint, ts timestamp_ntz, event_id bigint, pid bigint")
    roll = KeyedStore(spark, str(tmp_path / "r"), roll_shape, keys, 4, ["cc_num"], "ts", span)
    lag = KeyedStore(spark, str(tmp_path / "l"), lag_shape, keys, 4, ["cc_num"], "ts", span)
    roller = mt.RollingMaintainer(History(spark, str(tmp_path / "h1"), TXN, ["cc_num"], "ts", 4, span), roll, ["cc_num"], "ts", SPECS)
    lagger = mt.LagMaintainer(History(spark, str(tmp_path / "h2"), TXN, ["cc_num"], "ts", 4, span), lag, ["cc_num"], "ts", {"pid": "event_id"}, "event_id")
    for epoch, batch in enumerate(batches):
        df = spark.createDataFrame(batch, TXN)
        roller(df, epoch)
        lagger(df, epoch)
        if epoch == 1:  # a retried epoch changes nothing
            roller(df, epoch)
            lagger(df, epoch)
    full = win.rolling(whole, ["cc_num"], "ts", SPECS)
    assert bag(roll.current(), roll_shape.names) == bag(full, roll_shape.names)
    full = win.lag_cols(whole, ["cc_num"], "ts", {"pid": "event_id"}, "event_id")
    assert bag(lag.current(), lag_shape.names) == bag(full, lag_shape.names)
    assert mt.batch_stream_diff(full.select(*lag_shape.names), lag.current(), keys).isEmpty()


def files_in(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_step_reads_only_slots_within_reach(spark, tmp_path):
    """A step's files lie within one horizon of its rows, however long the history; a late row opens its own surroundings."""
    span, day = win.days(5), win.days(1)
    history = History(spark, str(tmp_path / "h"), TXN, ["cc_num"], "ts", 2, span)
    shape = T.StructType.fromDDL("cc_num bigint, ts timestamp_ntz, event_id bigint, n_3d bigint, sum_9d decimal(38,2), gifts bigint")
    store = KeyedStore(spark, str(tmp_path / "s"), shape, ["cc_num", "ts", "event_id"], 2, ["cc_num"], "ts", span)
    m = mt.RollingMaintainer(history, store, ["cc_num"], "ts", SPECS)
    rows = [txn_row(i, i % 3, at("2023-01-01") + day * (i % 400)) for i in range(800)]
    m(spark.createDataFrame(rows, TXN), 0)
    late = [txn_row(900, 1, at("2024-02-05")), txn_row(901, 1, at("2023-03-01"))]
    batch = spark.createDataFrame(late, TXN)
    seen = []
    read = history.read
    history.read = lambda upto, pieces: seen.append(pieces) or read(upto, pieces)
    m(batch, 1)
    opened = read(1, seen[0])
    assert len(files_in(opened)) <= 12 < len(files_in(read(1))) / 5
    assert "PartitionFilters" in (plan := opened._jdf.queryExecution().toString()) and "slot" in plan.split("PartitionFilters")[1]
    ages = {(r.ts - at("2023-03-01")).days if r.ts < at("2023-08-01") else (r.ts - at("2024-02-05")).days for r in opened.collect()}
    assert min(ages) >= -9 - 5 and max(ages) <= 9 + 5
    assert bag(store.current(), shape.names) == bag(win.rolling(spark.createDataFrame(rows + late, TXN), ["cc_num"], "ts", SPECS), shape.names)


def test_rows_without_a_time_and_far_apart_batches(spark, tmp_path):
    """Slots, stretches and rows without a time together: results equal one batch run."""
    span = win.days(3)
    shape = T.StructType.fromDDL("cc_num bigint, ts timestamp_ntz, event_id bigint, n_3d bigint, sum_9d decimal(38,2), gifts bigint")
    store = KeyedStore(spark, str(tmp_path / "s"), shape, ["cc_num", "ts", "event_id"], 2, ["cc_num"], "ts", span)
    m = mt.RollingMaintainer(History(spark, str(tmp_path / "h"), TXN, ["cc_num"], "ts", 2, span), store, ["cc_num"], "ts", SPECS)
    rnd, rows = random.Random(11), []
    for epoch in range(3):
        batch = [txn_row(100 * epoch + i, rnd.randrange(2), rnd.choice(
            [None, at("1969-12-25") + timedelta(hours=rnd.randrange(300)), at("2024-01-01") + timedelta(days=rnd.randrange(200))]))
            for i in range(25)]
        rows += batch
        m(spark.createDataFrame(batch, TXN), epoch)
    want = win.rolling(spark.createDataFrame(rows, TXN), ["cc_num"], "ts", SPECS)
    assert bag(store.current(), shape.names) == bag(want, shape.names)


def test_lag_finds_far_neighbours_through_the_slot_table(spark, tmp_path):
    span = win.days(2)
    shape = T.StructType.fromDDL("cc_num bigint, ts timestamp_ntz, event_id bigint, pid bigint")
    history = History(spark, str(tmp_path / "h"), TXN, ["cc_num"], "ts", 2, span)
    store = KeyedStore(spark, str(tmp_path / "s"), shape, ["cc_num", "ts", "event_id"], 2, ["cc_num"], "ts", span)
    m = mt.LagMaintainer(history, store, ["cc_num"], "ts", {"pid": "event_id"}, "event_id")
    other = [txn_row(50 + i, 2, at("2023-01-01") + timedelta(days=i)) for i in range(300)]
    steps = [[txn_row(1, 1, "2023-01-01"), txn_row(2, 1, "2024-01-01"), *other], [txn_row(3, 1, "2023-06-01"), txn_row(4, 1, "2023-06-01")],
             [txn_row(5, 1, "2022-01-01"), txn_row(6, 1, "2024-06-01"), txn_row(7, 1, "2023-05-31 23:00:00")]]
    seen = []
    read = history.read
    history.read = lambda upto, pieces: seen.append((upto, pieces)) or read(upto, pieces)
    for epoch, rows in enumerate(steps):
        m(spark.createDataFrame(rows, TXN), epoch)
    whole = spark.createDataFrame([r for rows in steps for r in rows], TXN)
    assert bag(store.current(), shape.names) == bag(win.lag_cols(whole, ["cc_num"], "ts", {"pid": "event_id"}, "event_id"), shape.names)
    upto, pieces = next(x for x in seen if x[0] == 1)
    assert len(files_in(read(upto, pieces))) <= 8 < len(files_in(read(upto))) / 5


def test_late_row_corrects_later_rows(spark, tmp_path):
    shape = T.StructType.fromDDL("cc_num bigint, ts timestamp_ntz, event_id bigint, n bigint")
    store = KeyedStore(spark, str(tmp_path / "s"), shape, ["cc_num", "ts", "event_id"], 4, ["cc_num"])
    m = mt.RollingMaintainer(
        History(spark, str(tmp_path / "h"), TXN, ["cc_num"], "ts", 4), store, ["cc_num"], "ts", {"n": win.Trailing(win.days(1))})
    df = lambda *r: spark.createDataFrame(list(r), TXN)
    m(df(txn_row(1, 1, "2024-01-01 10:00:00"), txn_row(2, 1, "2024-01-01 12:00:00"), txn_row(3, 1, "2024-01-05")), 0)
    changes = m(df(txn_row(4, 1, "2024-01-01 11:00:00")), 1).collect()
    assert {(r.op, r.event_id, r.n) for r in changes} == {("insert", 4, 2), ("update", 2, 3)}


def test_card_alerts_follow_batches_and_emit_deltas(spark, tmp_path):
    rows, batches = shuffled_batches(7, n=120, pieces=4)
    cust = spark.createDataFrame([(c, f"c{c}", 0.0, 0.0) for c in range(4)], CUST_DDL)  # card 4 unknown
    params = AlertParams(gift_30d=6, gift_45d=8, velocity_7d=5, displaced_3d=3)
    m = CardAlertMaintainer(spark, str(tmp_path), TXN, cust, params, 4)
    for epoch, batch in enumerate(batches):
        m(spark.createDataFrame(batch, TXN), epoch)
    cols = ["cc_num", "total_priority", "alert_amt", "alert_ts", "ts", "amt", "category", "distance", "review_priority"]
    want = cards.fraud_alert_details(spark.createDataFrame(rows, TXN), cust, params)
    assert bag(m.result.current(), cols) == bag(want, cols) and not want.isEmpty()


def test_step_reads_only_touched_buckets(spark, tmp_path):
    """The files a one-card step opens do not grow with the number of other cards."""
    history = History(spark, str(tmp_path / "h"), TXN, ["cc_num"], "ts", 16)
    rows = [txn_row(i, i % 200, at("2024-01-01") + timedelta(minutes=i)) for i in range(2000)]
    history.write(spark.createDataFrame(rows, TXN), 0)
    touched = history.buckets_of(spark.createDataFrame([(5,)], "cc_num bigint"))
    assert len(touched) == 1
    pruned = history.read(0, touched)
    assert "PartitionFilters: [isnotnull(epoch" in pruned._jdf.queryExecution().toString() or "kb" in pruned._jdf.queryExecution().toString()
    assert pruned.count() < 2000 / 4
    assert pruned.filter("cc_num = 5").count() == 10


def test_per_key_view_retracts(spark, tmp_path):
    """A key that stops qualifying is deleted from the view."""
    shape = T.StructType.fromDDL("cc_num bigint, avg double")
    store = KeyedStore(spark, str(tmp_path / "s"), shape, ["cc_num"], 4)
    compute = lambda rows: rows.groupBy("cc_num").agg(F.avg(F.col("amt").cast("double")).alias("avg")).filter("avg > 5")
    m = mt.KeyMaintainer(History(spark, str(tmp_path / "h"), TXN, ["cc_num"], "ts", 4), store, compute)
    df = lambda *r: spark.createDataFrame(list(r), TXN)
    m(df(txn_row(1, 1, "2024-01-01", amt="9.00"), txn_row(2, 2, "2024-01-01", amt="8.00")), 0)
    changes = m(df(txn_row(3, 1, "2024-01-02", amt="0.50")), 1).collect()
    assert [(r.op, r.cc_num) for r in changes] == [("delete", 1)]
    assert {r.cc_num for r in store.current().collect()} == {2}


def test_changing_join_retracts_on_either_side(spark, tmp_path):
    left = KeyedStore(spark, str(tmp_path / "m"), T.StructType.fromDDL("id bigint, user_id bigint, g bigint"), ["id"], 4)
    right = KeyedStore(spark, str(tmp_path / "u"), T.StructType.fromDDL("user_id bigint, banned boolean"), ["user_id"], 4)
    view = KeyedStore(spark, str(tmp_path / "v"), T.StructType.fromDDL("id bigint, user_id bigint, g bigint"), ["id"], 4)
    j = mt.JoinMaintainer(left, right, view, "user_id", lambda m, u: m.join(u.filter("NOT banned"), "user_id"))
    L, R = "op string, id bigint, user_id bigint, g bigint", "op string, user_id bigint, banned boolean"
    df = spark.createDataFrame
    j(df([("insert", 1, 10, 0), ("insert", 2, 11, 0)], L), df([("insert", 10, False), ("insert", 11, False)], R), 0)
    j(df([("update", 2, 10, 5)], L), df([], R), 1)  # the member moves to another user
    assert {tuple(r) for r in view.current().collect()} == {(1, 10, 0), (2, 10, 5)}
    changes = j(df([], L), df([("update", 10, True)], R), 2).collect()
    assert {(r.op, r.id) for r in changes} == {("delete", 1), ("delete", 2)}
    assert view.current().isEmpty()


def test_new_only_and_retry(spark, tmp_path):
    seen = KeyedStore(spark, str(tmp_path / "seen"), T.StructType.fromDDL("cc_num bigint"), ["cc_num"], 4)
    alerts = lambda *c: spark.createDataFrame([(x,) for x in c], "cc_num bigint")
    got = lambda a, e: sorted(r.cc_num for r in mt.new_only(a, seen, e).collect())
    assert got(alerts(1, 2), 0) == [1, 2]
    assert got(alerts(2, 3), 1) == [3]
    assert got(alerts(2, 3), 1) == [3]  # the retried epoch reports the same
    assert got(alerts(1, 3), 2) == []


def test_rows_beyond_lateness_are_reported(spark):
    df = lambda *r: spark.createDataFrame(list(r), TXN)
    kept, late, seen = st.late_rows(df(txn_row(1, 1, "2024-01-10")), "ts", None, "1 DAY")
    assert (kept.count(), late.count(), seen) == (1, 0, at("2024-01-10"))
    batch = df(txn_row(2, 1, "2024-01-09"), txn_row(3, 1, "2024-01-08 23:59:59"))
    kept, late, seen = st.late_rows(batch, "ts", seen, "1 DAY")
    assert [r.event_id for r in kept.collect()] == [2] and [r.event_id for r in late.collect()] == [3]
    assert seen == at("2024-01-10")


def replay_of(spark, tmp_path, rows, steps=3, files_per_step=8):
    """Rows stored as a preload and steps of several files each, written in disturbed order."""
    path = str(tmp_path / "replay")
    size = -(-len(rows) // (steps + 1))
    for step in (1, 0, -1, 2):
        part = rows[(step + 1) * size:(step + 2) * size]
        spark.createDataFrame(part, TXN).repartition(files_per_step).write.parquet(f"{path}/batch_id={step}")
    return files.replay(spark, path, str(tmp_path / "landing"), TXN)


def test_a_step_of_many_files_is_one_epoch_in_step_order(spark, tmp_path):
    rows = [txn_row(i, i % 3, at("2024-01-01") + timedelta(hours=i)) for i in range(80)]
    history, run = replay_of(spark, tmp_path, rows)
    assert history.count() == 20
    got = []
    query = run(lambda df, step: got.append((step, sorted(r.event_id for r in df.collect()))), str(tmp_path / "cp"))
    assert got == [(k, list(range(20 * (k + 1), 20 * (k + 2)))) for k in range(3)]
    assert query.lastProgress["batchId"] == 2


def test_late_rows_survive_a_stop_in_the_middle(spark, tmp_path):
    """A step that fails after writing part of its output is run again; kept and late rows equal an undisturbed run."""
    rnd = random.Random(4)
    rows = [txn_row(i, 1, at("2024-01-01") + timedelta(hours=3 * i - (rnd.choice([0, 0, 20, 40])))) for i in range(80)]
    rows[30] = txn_row(30, 1, None)
    out = {}
    for name, failing in (("plain", None), ("stopped", 1)):
        root = tmp_path / name
        history, run = replay_of(spark, root, rows)
        split = st.LateSplitter(spark, str(root / "split"), "ts", "1 DAY")
        split(history, 0)
        stop = {failing}

        def step(df, k, split=split, stop=stop):
            if k in stop:
                stop.clear()
                write = split._write
                split._write = lambda rows, part, epoch: write(rows.limit(2), part, epoch)  # half-written, newest time wrong too
                split(df, k + 1)
                split._write = write
                raise RuntimeError("executor lost")
            split(df, k + 1)

        if failing is not None:
            with pytest.raises(Exception, match="executor lost"):
                run(step, str(root / "cp"))
        run(step, str(root / "cp"))
        out[name] = sorted((r.event_id, r.late) for r in split.rows(TXN).collect())
    assert out["plain"] == out["stopped"] and len(out["plain"]) == 80
    seen, want = None, []
    for k in range(4):
        part = rows[20 * k:20 * (k + 1)]
        want += [(r[0], bool(seen and r[2] and r[2] < seen - timedelta(days=1))) for r in part]
        seen = max([r[2] for r in part if r[2]] + ([seen] if seen else []))
    assert out["plain"] == sorted(want) and any(late for _, late in want)


def test_changing_join_reads_only_touched_buckets(spark, tmp_path):
    side = lambda name, ddl, keys: KeyedStore(spark, str(tmp_path / name), T.StructType.fromDDL(ddl), keys, 16, ["user_id"])
    left, right = side("m", "id bigint, user_id bigint", ["id", "user_id"]), side("u", "user_id bigint, banned boolean", ["user_id"])
    view = side("v", "id bigint, user_id bigint", ["id", "user_id"])
    j = mt.JoinMaintainer(left, right, view, "user_id", lambda m, u: m.join(u.filter("NOT banned"), "user_id").select("id", "user_id"))
    ins = lambda df: df.withColumn("op", F.lit("insert"))
    j(ins(spark.range(200).selectExpr("id", "id % 50 AS user_id")), ins(spark.range(50).selectExpr("id AS user_id", "false AS banned")), 0)
    seen, current = [], left.current
    left.current = lambda upto=None, buckets=None, **kw: seen.append(buckets) or current(upto, buckets, **kw)
    none = spark.createDataFrame([], "op string, id bigint, user_id bigint")
    changes = j(none, spark.createDataFrame([("update", 7, True)], "op string, user_id bigint, banned boolean"), 1)
    assert {(r.op, r.id) for r in changes.collect()} == {("delete", 7 + 50 * k) for k in range(4)}
    assert seen and all(len(b) <= 1 for b in seen)


def test_unfinished_epoch_is_invisible(spark, tmp_path):
    from rillstream.operators.changes import commit_epoch
    from rillstream.streaming.store import EpochLog

    log = EpochLog(spark, str(tmp_path / "log"))
    store = KeyedStore(spark, str(tmp_path / "s"), T.StructType.fromDDL("k bigint"), ["k"], 2)
    rows = spark.createDataFrame([("insert", 1)], "op string, k bigint")

    def fail(_):
        raise RuntimeError("second table failed")

    assert log.last() == -1
    with pytest.raises(RuntimeError):
        commit_epoch(0, [lambda e: store.write(rows, e), fail], log)
    assert store.current(log.last()).isEmpty()
    commit_epoch(0, [lambda e: store.write(rows, e)], log)
    assert store.current(log.last()).count() == 1


def test_features_and_scores_follow_late_and_retried_rows(spark, tmp_path):
    """Kept features equal the batch view, and every score is that of its final features."""
    from rillstream.plans import features as ft
    from rillstream.streaming.scoring import FeatureMaintainer, ScoreMaintainer
    ddl = ("event_id bigint, cc_num bigint, trans_date_trans_time timestamp_ntz, amt decimal(12,2), unix_time bigint, "
           "is_fraud bigint")
    start = datetime(2024, 1, 1)
    when = [start + timedelta(hours=(k * 37) % 4000) for k in range(60)]
    rows = [(k, k % 4, t, Decimal(k) / 4, int((t - datetime(1970, 1, 1)).total_seconds()), 0) for k, t in enumerate(when)]
    txn = spark.createDataFrame(rows, ddl)
    demo = spark.createDataFrame([(k, k + 10, 100 * k) for k in range(3)], "cc_num bigint, zip bigint, city_pop bigint")
    whole = ft.feature_table(ft.feature_view(txn, demo, None, ["trans_date_trans_time"]))
    key, by = ["cc_num", "trans_date_trans_time", "event_id"], dict(
        bucket_by=["cc_num"], time="trans_date_trans_time", span=timedelta(days=7))
    features = KeyedStore(spark, str(tmp_path / "f"), whole.schema, key, 2, **by)
    shape = T.StructType([*[f for f in whole.schema if f.name in key], T.StructField("prediction", T.DoubleType())])
    scores = KeyedStore(spark, str(tmp_path / "s"), shape, key, 2, **by)
    history = History(spark, str(tmp_path / "h"), txn.schema, ["cc_num"], "trans_date_trans_time", 2, timedelta(days=7))
    rule = F.col("avg_spend_pw") + F.col("trans_freq_24") + F.col("avg_spend_p3m_over_d")
    keep = ScoreMaintainer(
        FeatureMaintainer(history, features, demo), lambda df: df.withColumn("prediction", rule), scores)
    for epoch, cond in enumerate(("event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2")):
        keep(txn.filter(cond), epoch)
    keep(txn.filter("event_id % 3 = 2"), 2)  # the last step again
    bag = lambda df: sorted(map(str, df.collect()))
    assert bag(features.current().select(*whole.columns)) == bag(whole)
    assert bag(scores.current().select(*key, "prediction")) == bag(whole.withColumn("prediction", rule).select(*key, "prediction"))
