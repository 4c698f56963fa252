"""Card alert and detector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators.relational import union_signals
from ..params import AlertParams, DetectorParams, SkimParams
from ..plans import cards
from .base import Catalog

CATALOG = Catalog()

# Thresholds that fire on the fixture's scale and geometry.
ALERTS = AlertParams(gift_30d=18, gift_45d=20, velocity_7d=25, displaced_3d=12, far_distance=20.0)
DETECT = DetectorParams(
    gift_30d=18, velocity_7d=26, displaced_3d=14, fan_out_day=9, far_distance=0.9,
    one_bucket_gift=10, one_bucket_velocity=22, one_bucket_displaced=9,
)
SKIM = SkimParams(spike_factor=1.8, rapid_seconds=3600, rapid_count=3, rare_share=0.14)

AGGREGATES = """
with_home AS (
  SELECT txn.*, abs(shipping_lat - lat) + abs(shipping_long - long) AS distance
  FROM txn LEFT JOIN cust USING (cc_num) WHERE ts IS NOT NULL),
features AS (
  SELECT *,
    CAST(sum(amt) OVER d7 AS DOUBLE) / count(amt) OVER d7 AS avg_7day,
    count(*) FILTER (category = 'gift card') OVER d30 AS g30,
    sum(amt) FILTER (category = 'gift card') OVER d30 AS g30_amt,
    count(*) FILTER (category = 'gift card') OVER d45 AS g45,
    sum(amt) FILTER (category = 'gift card') OVER d45 AS g45_amt,
    count(*) OVER d7 AS v7, sum(amt) OVER d7 AS v7_amt,
    count(*) FILTER (distance > 20) OVER d3 AS f3,
    sum(amt) FILTER (distance > 20) OVER d3 AS f3_amt
  FROM with_home
  WINDOW d3 AS (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW),
         d7 AS (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW),
         d30 AS (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW),
         d45 AS (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 45 DAY PRECEDING AND CURRENT ROW)),
alerts AS (
  SELECT cc_num, ts, g30_amt AS amt, 'gift_card_burst_30d' AS signal_type, 3 AS priority FROM features WHERE g30 >= 18
  UNION ALL SELECT cc_num, ts, g45_amt, 'gift_card_burst_45d', 4 FROM features WHERE g45 >= 20
  UNION ALL SELECT cc_num, ts, v7_amt, 'spend_velocity_7d', 1 FROM features WHERE v7 >= 25
  UNION ALL SELECT cc_num, ts, f3_amt, 'repeated_displacement', 5 FROM features WHERE f3 >= 12)
"""
SUMMARY = AGGREGATES + """,
summary AS (
  SELECT cc_num, CAST(sum(priority) AS BIGINT) AS total_priority, max(amt) AS alert_amt, max(ts) AS alert_ts
  FROM alerts GROUP BY cc_num)
"""


def details_sql(snapshot: str) -> str:
    return fx.oracle("txn cust", SUMMARY + f""",
snap AS ({snapshot})
SELECT cc_num, total_priority, CAST(alert_amt AS DOUBLE) AS alert_amt, alert_ts, snap.ts AS ts,
  CAST(snap.amt AS DOUBLE) AS amt, category, shipping_lat, shipping_long,
  round(distance, 3) AS distance, round(coalesce(avg_7day, 0), 6) AS avg_7day,
  total_priority * 1000.0e0 + least(CAST(snap.amt AS DOUBLE), 9999.0e0) AS review_priority
FROM snap JOIN summary USING (cc_num)""")


def plain(df):
    """Driver-friendly types: DECIMAL as DOUBLE, derived averages rounded."""
    return df.withColumns({
        "alert_amt": F.col("alert_amt").cast("double"),
        "amt": F.col("amt").cast("double"),
        "avg_7day": F.round("avg_7day", 6),
    })


@CATALOG.query("fraud_alert_details", details_sql(
    "SELECT * FROM features QUALIFY row_number() OVER (PARTITION BY cc_num ORDER BY ts DESC, event_id DESC) = 1"))
def fraud_alert_details(spark, sf_dir):
    return plain(cards.fraud_alert_details(fx.txn(spark, sf_dir), fx.cust(spark, sf_dir), ALERTS))


@CATALOG.query("min_snapshot", details_sql(
    "SELECT cc_num, max(ts) AS ts, min(amt) AS amt, min(category) AS category, min(shipping_lat) AS shipping_lat, "
    "min(shipping_long) AS shipping_long, min(distance) AS distance, min(avg_7day) AS avg_7day "
    "FROM features GROUP BY cc_num"))
def min_snapshot(spark, sf_dir):
    return plain(cards.fraud_alert_details(
        fx.txn(spark, sf_dir), fx.cust(spark, sf_dir), ALERTS, latest="min"))


@CATALOG.query("rolling_multi_window", fx.oracle("txn cust", AGGREGATES + """
SELECT event_id, cc_num, round(avg_7day, 6) AS avg_7day, g30 AS gift_count_30day,
  CAST(coalesce(g30_amt, 0) AS DOUBLE) AS gift_sum_30day, g45 AS gift_count_45day, v7 AS txn_count_7day,
  CAST(v7_amt AS DOUBLE) AS txn_sum_7day, f3 AS disp_count_3day,
  CAST(coalesce(f3_amt, 0) AS DOUBLE) AS disp_sum_3day FROM features"""))
def rolling_multi_window(spark, sf_dir):
    rows = cards.alert_aggregates(fx.txn(spark, sf_dir), fx.cust(spark, sf_dir), ALERTS)
    d = lambda c: F.col(c).cast("double").alias(c)
    return rows.select(
        "event_id", "cc_num", F.round("avg_7day", 6).alias("avg_7day"), "gift_count_30day",
        d("gift_sum_30day"), "gift_count_45day", "txn_count_7day", d("txn_sum_7day"),
        "disp_count_3day", d("disp_sum_3day"))


@CATALOG.query("union_all_signals", fx.oracle("txn cust", AGGREGATES + """
SELECT cc_num, ts, CAST(amt AS DOUBLE) AS amt, signal_type, priority FROM alerts"""))
def union_all_signals(spark, sf_dir):
    rows = cards.alert_aggregates(fx.txn(spark, sf_dir), fx.cust(spark, sf_dir), ALERTS)
    return cards.fraud_alerts(rows, ALERTS).withColumn("amt", F.col("amt").cast("double"))


@CATALOG.query("group_sum_max", fx.oracle("txn cust", SUMMARY + """
SELECT cc_num, total_priority, CAST(alert_amt AS DOUBLE) AS alert_amt, alert_ts FROM summary"""))
def group_sum_max(spark, sf_dir):
    from ..operators.relational import sum_max
    rows = cards.alert_aggregates(fx.txn(spark, sf_dir), fx.cust(spark, sf_dir), ALERTS)
    out = sum_max(cards.fraud_alerts(rows, ALERTS), ["cc_num"], {"total_priority": "priority"},
                  {"alert_amt": "amt", "alert_ts": "ts"})
    return out.withColumn("alert_amt", F.col("alert_amt").cast("double"))


FIVE_SQL = """
dist AS (
  SELECT n.*, abs(shipping_lat - lat) + abs(shipping_long - long) AS distance
  FROM near_txn n JOIN cust USING (cc_num)),
g AS (SELECT cc_num, count(*) OVER (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS c
      FROM near_txn WHERE category = 'gift card'),
v AS (SELECT cc_num, count(*) OVER (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS c
      FROM near_txn),
f AS (SELECT cc_num, count(*) OVER (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW) AS c
      FROM dist WHERE distance > 0.9e0),
cells AS (SELECT DISTINCT cc_num, CAST(ts AS DATE) AS d, floor(shipping_lat * 10) AS a, floor(shipping_long * 10) AS b FROM near_txn),
fan AS (SELECT cc_num, d, count(*) AS c FROM cells GROUP BY cc_num, d),
prev AS (SELECT *, lag(shipping_lat) OVER w AS plat, lag(shipping_long) OVER w AS plong, lag(ts) OVER w AS pts
         FROM near_txn WINDOW w AS (PARTITION BY cc_num ORDER BY ts, event_id)),
trav AS (SELECT cc_num FROM prev WHERE pts IS NOT NULL AND ts < pts + INTERVAL 1 HOUR
         AND abs(shipping_lat - plat) + abs(shipping_long - plong) > 1.0),
signals AS (
  SELECT cc_num,
    cc_num IN (SELECT cc_num FROM g WHERE c >= 18) AS gift_30d,
    cc_num IN (SELECT cc_num FROM v WHERE c >= 26) AS velocity_7d,
    cc_num IN (SELECT cc_num FROM f WHERE c >= 14) AS displaced_3d,
    cc_num IN (SELECT cc_num FROM trav) AS impossible_travel,
    cc_num IN (SELECT cc_num FROM fan WHERE c >= 9) AS fan_out
  FROM (SELECT DISTINCT cc_num FROM near_txn)),
exact AS (SELECT cc_num FROM signals WHERE gift_30d OR velocity_7d OR displaced_3d OR impossible_travel OR fan_out),
bk AS (
  SELECT 'gift' AS s, cc_num, CAST(floor(epoch(ts)) AS BIGINT) // 2592000 AS b FROM near_txn WHERE category = 'gift card'
  UNION ALL SELECT 'vel', cc_num, CAST(floor(epoch(ts)) AS BIGINT) // 604800 FROM near_txn
  UNION ALL SELECT 'far', cc_num, CAST(floor(epoch(ts)) AS BIGINT) // 259200 FROM dist WHERE distance > 0.9e0),
bc AS (SELECT s, cc_num, b, count(*) AS n FROM bk GROUP BY s, cc_num, b),
two AS (
  SELECT DISTINCT x.cc_num FROM bc x LEFT JOIN bc y ON x.s = y.s AND x.cc_num = y.cc_num AND y.b = x.b - 1
  WHERE x.n + coalesce(y.n, 0) >= CASE x.s WHEN 'gift' THEN 18 WHEN 'vel' THEN 26 ELSE 14 END
  UNION SELECT cc_num FROM fan WHERE c >= 9),
one AS (
  SELECT DISTINCT cc_num FROM bc
  WHERE n >= CASE s WHEN 'gift' THEN 10 WHEN 'vel' THEN 22 ELSE 9 END)
"""


def _five(body: str, views: str = "near_txn cust") -> str:
    return fx.oracle(views, FIVE_SQL + body)


@CATALOG.query("flagged_card_exact", _five("SELECT cc_num FROM exact"))
def flagged_card_exact(spark, sf_dir):
    return cards.flagged_exact(fx.near_txn(spark, sf_dir), fx.cust(spark, sf_dir), DETECT)


@CATALOG.query("card_signals", _five("SELECT * FROM signals"))
def card_signals(spark, sf_dir):
    return cards.card_signals(fx.near_txn(spark, sf_dir), fx.cust(spark, sf_dir), DETECT)


@CATALOG.query("flagged_card_two_bucket", _five("SELECT cc_num FROM two"))
def flagged_card_two_bucket(spark, sf_dir):
    return cards.flagged_two_bucket(fx.near_txn(spark, sf_dir), fx.cust(spark, sf_dir), DETECT)


@CATALOG.query("flagged_card_one_bucket", _five("SELECT cc_num FROM one"))
def flagged_card_one_bucket(spark, sf_dir):
    return cards.flagged_one_bucket(fx.near_txn(spark, sf_dir), fx.cust(spark, sf_dir), DETECT)


@CATALOG.query("alert_context", _five("""
SELECT s.cc_num,
  concat_ws(',', CASE WHEN gift_30d THEN 'gift_30d' END, CASE WHEN velocity_7d THEN 'velocity_7d' END,
    CASE WHEN displaced_3d THEN 'displaced_3d' END, CASE WHEN impossible_travel THEN 'impossible_travel' END,
    CASE WHEN fan_out THEN 'fan_out' END) AS signals,
  CAST(gift_30d AS INT) + CAST(velocity_7d AS INT) + CAST(displaced_3d AS INT) + CAST(impossible_travel AS INT)
    + CAST(fan_out AS INT) AS n_signals,
  CASE WHEN gift_30d OR CAST(velocity_7d AS INT) + CAST(displaced_3d AS INT) + CAST(impossible_travel AS INT)
    + CAST(fan_out AS INT) > 1 THEN 'high' ELSE 'medium' END AS confidence,
  t.event_id, t.ts, CAST(t.amt AS DOUBLE) AS amt, t.category, t.shipping_lat, t.shipping_long
FROM signals s JOIN exact e USING (cc_num)
JOIN (SELECT * FROM near_txn QUALIFY row_number() OVER (
  PARTITION BY cc_num ORDER BY amt DESC, ts DESC, event_id DESC) = 1) t ON t.cc_num = s.cc_num"""))
def alert_context(spark, sf_dir):
    txn = fx.near_txn(spark, sf_dir)
    signals = cards.card_signals(txn, fx.cust(spark, sf_dir), DETECT)
    return cards.alert_context(txn, signals).withColumn("amt", F.col("amt").cast("double"))


ONE_DAY = """
enriched AS (
  SELECT txn.*, sqrt((shipping_lat - lat) * (shipping_lat - lat) + (shipping_long - long) * (shipping_long - long)) AS distance
  FROM txn LEFT JOIN cust USING (cc_num)),
daily AS (
  SELECT *, CAST(sum(amt) OVER w AS DOUBLE) / count(amt) OVER w AS avg_1day,
    count(*) FILTER (distance > 0.5) OVER w AS count_1day
  FROM enriched
  WINDOW w AS (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW))
"""


@CATALOG.query("feature_enrich_1day", fx.oracle("txn cust", ONE_DAY + """
SELECT event_id, cc_num, ts, round(distance, 6) AS distance, round(avg_1day, 6) AS avg_1day, count_1day FROM daily"""))
def feature_enrich_1day(spark, sf_dir):
    out = cards.enrich_1day(fx.txn(spark, sf_dir), fx.cust(spark, sf_dir))
    return out.select("event_id", "cc_num", "ts", F.round("distance", 6).alias("distance"),
                      F.round("avg_1day", 6).alias("avg_1day"), "count_1day")


SKIM_SQL = ONE_DAY + """,
seq AS (SELECT *, lag(ts) OVER w AS pts, lag(shipping_lat) OVER w AS plat, lag(shipping_long) OVER w AS plong
        FROM daily WINDOW w AS (PARTITION BY cc_num ORDER BY ts, event_id)),
share AS (SELECT cc_num, category, count(*) AS n_cat, sum(count(*)) OVER (PARTITION BY cc_num) AS n_all
          FROM daily GROUP BY cc_num, category),
rapid AS (SELECT *, count(*) OVER (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS n_rapid
          FROM daily),
skims AS (
  SELECT cc_num, ts, amt, event_id, 'probe_charge' AS signal_type FROM daily WHERE amt <= 5
  UNION ALL SELECT cc_num, ts, amt, event_id, 'geo_impossible' FROM seq
    WHERE ts < pts + INTERVAL 1 HOUR AND abs(shipping_lat - plat) + abs(shipping_long - plong) > 0.5
  UNION ALL SELECT d.cc_num, ts, amt, event_id, 'unusual_category' FROM daily d
    JOIN share s ON d.cc_num = s.cc_num AND d.category = s.category AND n_cat <= n_all * 0.14e0
  UNION ALL SELECT cc_num, ts, amt, event_id, 'rapid_sequence' FROM rapid WHERE n_rapid >= 3
  UNION ALL SELECT cc_num, ts, amt, event_id, 'spend_spike' FROM daily WHERE CAST(amt AS DOUBLE) > avg_1day * 1.8e0)
"""


def _skims(spark, sf_dir):
    rows = cards.enrich_1day(fx.txn(spark, sf_dir), fx.cust(spark, sf_dir))
    return union_signals(cards.skim_signals(rows, SKIM), cards.SIGNAL_COLUMNS)


@CATALOG.query("skim_signals", fx.oracle("txn cust", SKIM_SQL + """
SELECT cc_num, ts, CAST(amt AS DOUBLE) AS amt, event_id, signal_type FROM skims"""))
def skim_signals(spark, sf_dir):
    return _skims(spark, sf_dir)


@CATALOG.query("classify_cards", fx.oracle("txn cust", AGGREGATES + """,
per AS (SELECT cc_num, count(DISTINCT signal_type) AS n_signals, count(*) AS hits,
          CAST(sum(amt) AS DOUBLE) AS total_amt FROM alerts GROUP BY cc_num)
SELECT cc_num, n_signals, hits, round(total_amt, 2) AS total_amt,
  CASE WHEN n_signals >= 2 OR total_amt / hits >= 100 THEN 'SUSPICIOUS' ELSE 'BENIGN' END AS verdict,
  CASE WHEN n_signals >= 2 THEN 'HIGH' WHEN total_amt / hits >= 500 THEN 'MEDIUM' ELSE 'LOW' END AS confidence,
  CASE WHEN n_signals >= 2 THEN 'MULTI_SIGNAL' WHEN total_amt / hits >= 500 THEN 'MEAN_AMT_500'
       WHEN total_amt / hits >= 100 THEN 'MEAN_AMT_100' ELSE 'MEAN_AMT_LOW' END AS reason
FROM per"""))
def classify_cards(spark, sf_dir):
    rows = cards.alert_aggregates(fx.txn(spark, sf_dir), fx.cust(spark, sf_dir), ALERTS)
    return cards.classify_cards(cards.fraud_alerts(rows, ALERTS))
