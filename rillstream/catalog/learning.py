"""Evaluation, feature view and classifier queries."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from .. import fixtures as fx
from ..operators import relational as rel
from ..plans import cards, evaluation as ev, features as ft, ml
from .base import Catalog
from .cards import ALERTS, DETECT, FIVE_SQL

CATALOG = Catalog()
q = CATALOG.query
o = fx.oracle

PEAKS = """
rows AS (
  SELECT txn.cc_num, ts, category = 'gift card' AS gift,
    abs(shipping_lat - coalesce(lat, 0)) + abs(shipping_long - coalesce(long, 0)) > 20 AS far
  FROM txn LEFT JOIN cust USING (cc_num)),
counted AS (
  SELECT cc_num,
    count(*) FILTER (gift) OVER (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS a,
    count(*) FILTER (gift) OVER (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 45 DAY PRECEDING AND CURRENT ROW) AS b,
    count(*) OVER (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS c,
    count(*) FILTER (far) OVER (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW) AS e
  FROM rows),
top AS (SELECT cc_num, max(a) AS a, max(b) AS b, max(c) AS c, max(e) AS e FROM counted GROUP BY cc_num),
peaks AS (
  SELECT 'gift_card_burst_30d' AS signal, a AS peak, 18 AS current FROM top UNION ALL SELECT 'gift_card_burst_45d', b, 20 FROM top
  UNION ALL SELECT 'spend_velocity_7d', c, 25 FROM top UNION ALL SELECT 'repeated_displacement', e, 12 FROM top),
stats AS (
  SELECT signal, quantile_cont(CAST(peak AS DOUBLE), 0.5) AS p50, quantile_cont(CAST(peak AS DOUBLE), 0.9) AS p90,
    quantile_cont(CAST(peak AS DOUBLE), 0.95) AS p95, quantile_cont(CAST(peak AS DOUBLE), 0.99) AS p99, max(peak) AS max,
    count(*) AS n_cards,
    greatest(1, CAST(round_even(quantile_cont(CAST(peak AS DOUBLE), {pct}), 0) AS BIGINT)) AS suggested,
    CAST(any_value(current) AS BIGINT) AS current
  FROM peaks GROUP BY signal)
"""


@q("calibrate_thresholds", o("txn cust", PEAKS.replace("{pct}", "0.99") + """
SELECT s.signal, round(p50, 6) AS p50, round(p90, 6) AS p90, round(p95, 6) AS p95, round(p99, 6) AS p99, s.max, n_cards,
  suggested, s.current, (SELECT count(*) FROM peaks p WHERE p.signal = s.signal AND p.peak >= s.current) AS flagged_current,
  (SELECT count(*) FROM peaks p WHERE p.signal = s.signal AND p.peak >= s.suggested) AS flagged_suggested
FROM stats s"""))
def calibrate_thresholds(spark, d):
    out = ev.calibrate(fx.txn(spark, d), fx.cust(spark, d), ALERTS)
    return out.withColumns({p: F.round(p, 6) for p in ("p50", "p90", "p95", "p99")})


@q("clamp_threshold", o("txn cust", PEAKS.replace("{pct}", "0.6") + """,
tails AS (SELECT p.signal, p.peak, (SELECT count(*) FROM peaks x WHERE x.signal = p.signal AND x.peak >= p.peak) AS n
          FROM (SELECT DISTINCT signal, peak FROM peaks) p)
SELECT s.signal, suggested, CASE WHEN max(t.peak) >= suggested THEN max(t.peak) + 1 ELSE suggested END AS threshold
FROM stats s LEFT JOIN tails t ON t.signal = s.signal AND t.n > 0.10 * s.n_cards GROUP BY s.signal, suggested"""))
def clamp_threshold(spark, d):
    peaks = ev.signal_peaks(fx.txn(spark, d), fx.cust(spark, d), ALERTS.far_distance)
    hist = ev.peak_histogram(peaks)
    report = ev.calibrate_histogram(hist, {}, pct=60.0)
    return ev.clamp(hist, report.select("signal", "suggested"))


@q("card_sample", o("cust", """
SELECT count(*) // 10 AS n, count(*) // 10 AS n_distinct, count(*) // 10 AS n_known FROM cust"""))
def card_sample(spark, d):
    """Size of a tenth of all cards by seeded hash, how many are distinct and how many are cards."""
    cust = fx.cust(spark, d)
    sample = ev.sample_keys(cust, "cc_num", cust.count() // 10, seed=42)
    known = sample.join(cust.select("cc_num", F.lit(1).alias("k")).distinct(), "cc_num", "left")
    return known.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("cc_num").alias("n_distinct"), F.count("k").alias("n_known"))


SCORES = """
counts AS (SELECT cc_num, count(*) AS n FROM near_txn GROUP BY cc_num),
fraud AS (SELECT cc_num FROM labels_card WHERE label = 'fraud'),
flagged AS (SELECT 'exact' AS detector, cc_num FROM exact UNION ALL SELECT 'two_bucket', cc_num FROM two
            UNION ALL SELECT 'one_bucket', cc_num FROM one),
scores AS (
  SELECT detector, count(*) AS flagged, count(*) FILTER (f.cc_num IS NOT NULL) AS tp, count(*) FILTER (f.cc_num IS NULL) AS fp,
    (SELECT count(*) FROM fraud) - count(*) FILTER (f.cc_num IS NOT NULL) AS fn,
    CAST(sum(n) AS BIGINT) AS suspicious_txns, CAST(coalesce(sum(n) FILTER (f.cc_num IS NULL), 0) AS BIGINT) AS fp_txns
  FROM flagged g LEFT JOIN fraud f ON f.cc_num = g.cc_num LEFT JOIN counts c ON c.cc_num = g.cc_num GROUP BY detector)
"""


def _detectors(spark, d):
    return cards.detector_table(fx.near_txn(spark, d), fx.cust(spark, d), DETECT)


def _scores(spark, d):
    fraud = fx.labels_card(spark, d).filter("label = 'fraud'")
    return ev.score_all(_detectors(spark, d), cards.DETECTORS, fraud)


@q("detector_score", o("near_txn cust labels_card", FIVE_SQL + "," + SCORES + """
SELECT detector, flagged, tp, fp, fn, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 1.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 1.0 END AS recall, suspicious_txns, fp_txns FROM scores"""))
def detector_score(spark, d):
    return _scores(spark, d)


@q("signal_gap", o("near_txn cust labels_card", FIVE_SQL + """,
allc AS (SELECT cc_num FROM exact UNION SELECT cc_num FROM two UNION SELECT cc_num FROM one),
m AS (SELECT cc_num, cc_num IN (SELECT cc_num FROM exact) AS exact, cc_num IN (SELECT cc_num FROM two) AS two_bucket,
        cc_num IN (SELECT cc_num FROM one) AS one_bucket FROM allc)
SELECT m.*, coalesce(label, 'normal') AS label FROM m LEFT JOIN labels_card USING (cc_num)
WHERE NOT (exact = two_bucket AND exact = one_bucket)"""))
def signal_gap(spark, d):
    return ev.signal_gap(_detectors(spark, d), cards.DETECTORS, fx.labels_card(spark, d))


# An invented price list: provider, model, USD per million tokens in and out.
PRICES = [("north", "large", 5.0, 25.0), ("north", "small", 1.0, 5.0), ("south", "medium", 2.0, 12.0)]


@q("workload_cost", o("near_txn cust labels_card", FIVE_SQL + "," + SCORES + """
SELECT detector, provider, model, round(0.012 * price_in + 0.002 * price_out, 9) AS usd_per_txn, suspicious_txns,
  round(suspicious_txns * (0.012 * price_in + 0.002 * price_out), 6) AS usd_total,
  round(fp_txns * (0.012 * price_in + 0.002 * price_out), 6) AS usd_wasted
FROM scores CROSS JOIN (VALUES ('north', 'large', 5.0e0, 25.0e0), ('north', 'small', 1.0e0, 5.0e0), ('south', 'medium', 2.0e0, 12.0e0))
  AS p(provider, model, price_in, price_out)"""))
def workload_cost(spark, d):
    prices = spark.createDataFrame(PRICES, "provider string, model string, price_in double, price_out double")
    out = ev.workload_cost(_scores(spark, d), prices)
    return out.withColumns({
        "usd_per_txn": F.round("usd_per_txn", 9), "usd_total": F.round("usd_total", 6), "usd_wasted": F.round("usd_wasted", 6)})


@q("cost_series", o("txn", """
daily AS (SELECT category AS detector, CAST(CAST(ts AS DATE) AS VARCHAR) AS step, count(*) AS n FROM txn GROUP BY ALL),
cum AS (SELECT detector, step, n, CAST(sum(n) OVER (PARTITION BY detector ORDER BY step) AS BIGINT) AS suspicious_txns FROM daily)
SELECT detector, step, suspicious_txns, n AS new_txns, round(suspicious_txns * 0.11e0, 6) AS cost_usd FROM cum"""))
def cost_series(spark, d):
    daily = fx.txn(spark, d).groupBy(
        F.col("category").alias("detector"), F.to_date("ts").cast("string").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    cum = daily.select(
        "detector", "step", F.sum("n").over(Window.partitionBy("detector").orderBy("step")).alias("suspicious_txns"))
    return ev.cost_series(cum, 0.11).withColumn("cost_usd", F.round("cost_usd", 6))


# -- feature views ------------------------------------------------------------

FEATURES = """
features AS (
  SELECT event_id, cc_num, CAST(dayofweek(trans_date_trans_time) + 1 AS INTEGER) AS d,
    dayofweek(trans_date_trans_time) + 1 IN (6, 7) AS is_weekend, CAST(hour(trans_date_trans_time) AS INTEGER) AS hour_of_day,
    hour(trans_date_trans_time) <= 6 AS is_night,
    round(CAST(sum(amt) OVER d1 AS DOUBLE) / count(amt) OVER d1, 6) AS avg_spend_pd,
    round(CAST(sum(amt) OVER d7 AS DOUBLE) / count(amt) OVER d7, 6) AS avg_spend_pw,
    round(CAST(sum(amt) OVER d30 AS DOUBLE) / count(amt) OVER d30, 6) AS avg_spend_pm,
    round(coalesce(CAST(sum(amt) OVER m3 AS DOUBLE) / count(amt) OVER m3, 0), 6) AS avg_spend_p3m_over_d,
    count(*) OVER d1 AS trans_freq_24, CAST(amt AS DOUBLE) AS amt, unix_time, zip, city_pop, is_fraud
  FROM txn_ml JOIN demo USING (cc_num)
  WINDOW d1 AS (PARTITION BY cc_num ORDER BY unix_time RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW),
    d7 AS (PARTITION BY cc_num ORDER BY unix_time RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW),
    d30 AS (PARTITION BY cc_num ORDER BY unix_time RANGE BETWEEN 2592000 PRECEDING AND CURRENT ROW),
    m3 AS (PARTITION BY cc_num, day(trans_date_trans_time) ORDER BY unix_time RANGE BETWEEN 7776000 PRECEDING AND CURRENT ROW))
"""


def _features(spark, d):
    return ft.feature_view(fx.txn_ml(spark, d), fx.demo(spark, d))


def _rounded(df):
    names = ("avg_spend_pd", "avg_spend_pw", "avg_spend_pm", "avg_spend_p3m_over_d")
    return df.withColumns({**{c: F.round(c, 6) for c in names}, "amt": F.col("amt").cast("double")})


@q("feature_view", o("txn_ml demo", FEATURES + "SELECT * FROM features"))
def feature_view(spark, d):
    return _rounded(_features(spark, d))


EXPIRES = "CAST('20' || substr(cc_expiration_date, 4, 2) || '-' || substr(cc_expiration_date, 1, 2) || '-01 00:00:00' AS TIMESTAMP)"
COMBINED = f"""
combined AS (
  SELECT t.tid, t.date_time, t.cc_num, t.category, CAST(t.amount AS DOUBLE) AS amount, t.latitude, t.longitude, t.fraud_label,
    {EXPIRES} AS cc_expiration_date, date_sub('year', p.birthdate, t.date_time) AS age_at_transaction,
    date_sub('day', t.date_time, {EXPIRES}) AS days_until_card_expires
  FROM fs_txn t JOIN profiles p ON p.cc_num = t.cc_num),
hops AS (SELECT cc_num, date_time, amount, date_trunc('hour', date_time) - to_hours(k) AS window_start
         FROM fs_txn CROSS JOIN range(4) AS r(k)),
agg AS (SELECT cc_num, window_start, CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_amt, count(cc_num) AS trans,
          coalesce(stddev_samp(CAST(amount AS DOUBLE)), 0) AS stddev_amt FROM hops GROUP BY cc_num, window_start),
windowed AS (SELECT round(avg_amt, 6) AS avg_amt, trans, round(stddev_amt, 6) AS stddev_amt, date_time, h.cc_num, h.window_start
             FROM hops h JOIN agg a ON a.cc_num = h.cc_num AND a.window_start = h.window_start)
"""


@q("combined_features", o("fs_txn profiles", COMBINED + "SELECT * FROM combined"))
def combined_features(spark, d):
    return ft.combined(fx.fs_txn(spark, d), fx.profiles(spark, d))


def _windowed(spark, d, keep=False):
    return ft.windowed(fx.fs_txn(spark, d), keep_window=keep).withColumns({
        "avg_amt": F.round("avg_amt", 6), "stddev_amt": F.round("stddev_amt", 6)})


@q("windowed_features", o("fs_txn profiles", COMBINED + "SELECT avg_amt, trans, stddev_amt, date_time, cc_num FROM windowed"))
def windowed_features(spark, d):
    return _windowed(spark, d)


@q("feature_view_join", o("fs_txn profiles", COMBINED + """
SELECT c.tid, c.cc_num, c.date_time, c.age_at_transaction, w.avg_amt, w.trans, w.stddev_amt
FROM combined c JOIN windowed w ON w.cc_num = c.cc_num AND w.date_time = c.date_time"""))
def feature_view_join(spark, d):
    left = combined_features(spark, d).select("tid", "cc_num", "date_time", "age_at_transaction")
    return rel.feature_join(left, _windowed(spark, d), "cc_num", "equi", "date_time", ["avg_amt", "trans", "stddev_amt"])


@q("feature_view_asof", o("fs_txn profiles", COMBINED + """,
ends AS (SELECT cc_num, window_start + INTERVAL 4 HOUR AS at, round(avg_amt, 6) AS avg_amt, trans FROM agg)
SELECT c.tid, c.cc_num, c.date_time, e.avg_amt, e.trans
FROM combined c ASOF LEFT JOIN ends e ON e.cc_num = c.cc_num AND e.at <= c.date_time"""))
def feature_view_asof(spark, d):
    """The newest window statistics that were complete when the transaction happened."""
    stats = ft.windowed(fx.fs_txn(spark, d), keep_window=True).select(
        "cc_num", (F.col("window_start") + F.expr("INTERVAL 4 HOURS")).alias("date_time"),
        F.round("avg_amt", 6).alias("avg_amt"), "trans").distinct()
    left = combined_features(spark, d).select("tid", "cc_num", "date_time")
    return rel.feature_join(left, stats, "cc_num", "asof", "date_time", ["avg_amt", "trans"])


@q("category_encode", o("txn", "SELECT event_id, category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INTEGER) AS category_code FROM txn"))
def category_encode(spark, d):
    return ft.encode_category(fx.txn(spark, d).select("event_id", "category"), "category")


@q("train_test_split", o("txn", """
secs AS (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM txn),
cut AS (SELECT quantile_cont(CAST(s AS DOUBLE), 0.8) AS c FROM secs)
SELECT event_id, CASE WHEN s > c THEN 'test' ELSE 'train' END AS part FROM secs, cut"""))
def train_test_split(spark, d):
    train, test = ft.split(fx.txn(spark, d), "event_id", 0.2, "time", ts="ts")
    return train.select("event_id", F.lit("train").alias("part")).unionByName(
        test.select("event_id", F.lit("test").alias("part")))


MODEL_FEATURES = [c for c in ft.FEATURE_COLUMNS if c not in ("cc_num", "is_fraud", "unix_time")]


def label(rows):
    """Feature rows with a learnable label: large night-time spending."""
    risky = (F.col("amt") > 2 * F.col("avg_spend_pm")) & (F.col("hour_of_day") < 12)
    return rows.withColumn("is_fraud", risky.cast("int"))


def labelled(spark, d):
    return label(_features(spark, d))


@q("train_classifier", o("txn_ml demo", FEATURES + """,
cut AS (SELECT quantile_cont(CAST(unix_time AS DOUBLE), 0.8) AS c FROM features)
SELECT event_id, CAST(amt > 2 * avg_spend_pm AND hour_of_day < 12 AS INTEGER) AS is_fraud, true AS accurate
FROM features, cut WHERE unix_time > c"""))
def train_classifier(spark, d):
    """Fit on the earlier share of the feature view and predict the later one: its rows with their label, and
    whether at least nine tenths of the predictions are right."""
    train, test = ft.split(labelled(spark, d).withColumn("at", F.timestamp_seconds("unix_time")), "event_id", 0.2, "time", ts="at")
    pred = ml.predict(ml.train(train, MODEL_FEATURES, "is_fraud"), test)
    right = pred.agg(F.avg((F.col("prediction") == F.col("is_fraud")).cast("double")).alias("share"))
    return pred.select("event_id", "is_fraud").crossJoin(right).select(
        "event_id", "is_fraud", (F.col("share") >= 0.9).alias("accurate"))


@q("eval_metrics", o("txn", """
p AS (SELECT CAST(event_id % 5 = 0 AS INTEGER) AS y, CAST(event_id % 3 = 0 AND amt > 5 AS INTEGER) AS p FROM txn),
m AS (SELECT count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp,
        count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 1 AND p = 1) AS tp FROM p)
SELECT tn, fp, fn, tp, round(tp / CAST(tp + fp AS DOUBLE), 9) AS precision, round(tp / CAST(tp + fn AS DOUBLE), 9) AS recall,
  round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 9) AS f1,
  round((2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) + 2 * tn / CAST(2 * tn + fp + fn AS DOUBLE)) / 2, 9) AS macro_f1 FROM m"""))
def eval_metrics(spark, d):
    pred = fx.txn(spark, d).select(
        (F.col("event_id") % 5 == 0).cast("int").alias("y"),
        ((F.col("event_id") % 3 == 0) & (F.col("amt") > 5)).cast("int").alias("prediction"))
    out = ml.evaluate(pred, "y")
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1", "macro_f1")})


@q("latest_feature_lookup", o("txn_ml demo labels_card", FEATURES + """
SELECT cc_num, event_id, avg_spend_pd, trans_freq_24 FROM features
WHERE cc_num IN (SELECT cc_num FROM labels_card)
QUALIFY row_number() OVER (PARTITION BY cc_num ORDER BY unix_time DESC, event_id DESC) = 1"""))
def latest_feature_lookup(spark, d):
    rows = _rounded(_features(spark, d))
    return ft.latest_features(
        rows, fx.labels_card(spark, d), "cc_num", ["unix_time", "event_id"], ["event_id", "avg_spend_pd", "trans_freq_24"])
