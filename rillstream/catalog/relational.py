"""Projection, join, aggregation, window, ordering, set and scalar queries."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Window, functions as F, types as T

from .. import fixtures as fx
from .. import functions as fn
from ..operators import relational as rel
from ..operators import windows as win
from ..params import DAY, register_sql_functions
from ..plans import cards
from .base import Catalog
from .cards import AGGREGATES, ALERTS, FIVE_SQL, DETECT, ONE_DAY, SKIM, SKIM_SQL

CATALOG = Catalog()
q = CATALOG.query
o = fx.oracle
JOINED = "SELECT txn.*, abs(shipping_lat - lat) + abs(shipping_long - long) AS distance FROM txn {} JOIN cust USING (cc_num)"


def _dbl(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


# -- projection and filters ---------------------------------------------------

@q("project_star_plus", o("txn", "SELECT event_id, cc_num, ts, category, CAST(amt AS DOUBLE) AS amt, shipping_lat, "
   "shipping_long, shipping_lat + shipping_long AS position, 'card' AS source FROM txn"))
def project_star_plus(spark, d):
    return _dbl(rel.with_columns(fx.txn(spark, d), {
        "position": F.col("shipping_lat") + F.col("shipping_long"), "source": F.lit("card")}), "amt")


@q("case_flag", o("txn", "SELECT event_id, CASE WHEN category = 'gift card' THEN 1 ELSE 0 END AS is_gift, "
   "CAST(CASE WHEN category = 'gift card' THEN amt ELSE 0 END AS DOUBLE) AS gift_amt, "
   "CASE WHEN hour(ts) <= 6 THEN true ELSE false END AS is_night FROM txn"))
def case_flag(spark, d):
    gift = F.col("category") == "gift card"
    return fx.txn(spark, d).select(
        "event_id", fn.flag(gift).alias("is_gift"),
        fn.flag(gift, F.col("amt"), 0).cast("double").alias("gift_amt"),
        fn.flag(fn.date_part("hour", "ts") <= 6, True, False).alias("is_night"))


@q("filter_predicates", o("txn", "SELECT event_id, cc_num, category FROM txn WHERE ts IS NOT NULL AND category <> 'games' "
   "AND amt > 5 AND dayofweek(ts) + 1 IN (6, 7) AND NOT (cc_num % 17 = 0) AND shipping_lat >= 30"))
def filter_predicates(spark, d):
    return rel.where_all(fx.txn(spark, d), [
        F.col("ts").isNotNull(), F.col("category") != "games", F.col("amt") > 5,
        fn.date_part("dayofweek", "ts").isin(6, 7), ~(F.col("cc_num") % 17 == 0),
        F.col("shipping_lat") >= 30]).select("event_id", "cc_num", "category")


@q("having_filter", o("txn", "SELECT cc_num, category, count(*) AS n FROM txn GROUP BY cc_num, category HAVING count(*) >= 20"))
def having_filter(spark, d):
    return rel.having(fx.txn(spark, d), ["cc_num", "category"], F.count(F.lit(1)).alias("n"), F.col("n") >= 20)


@q("param_constants", o("txn", "SELECT cc_num, sum(CASE WHEN category = 'gift card' THEN 1 ELSE 0 END)::BIGINT AS gifts, "
   "3 * 1000 AS tier FROM txn GROUP BY cc_num HAVING sum(CASE WHEN category = 'gift card' THEN 1 ELSE 0 END) >= 18"))
def param_constants(spark, d):
    register_sql_functions(spark, ALERTS)
    fx.txn(spark, d).createOrReplaceTempView("rill_txn")
    return spark.sql(
        "SELECT cc_num, count_if(category = 'gift card') AS gifts, prio_gb30() * review_scale() AS tier "
        "FROM rill_txn GROUP BY cc_num HAVING count_if(category = 'gift card') >= gb30()")


@q("membership_filter", o("near_txn cust", FIVE_SQL + "SELECT cc_num, count(*) AS n FROM near_txn "
   "WHERE cc_num IN (SELECT cc_num FROM exact) GROUP BY cc_num"))
def membership_filter(spark, d):
    txn = fx.near_txn(spark, d)
    flagged = cards.flagged_exact(txn, fx.cust(spark, d), DETECT)
    return rel.members(rel.count_by(txn, ["cc_num"]), flagged, ["cc_num"])


# -- joins --------------------------------------------------------------------

@q("left_enrich", o("txn cust", "SELECT event_id, cc_num, round(distance, 6) AS distance FROM (" + JOINED.format("LEFT") + ")"))
def left_enrich(spark, d):
    return cards.with_distance(fx.txn(spark, d), fx.cust(spark, d)).select(
        "event_id", "cc_num", F.round("distance", 6).alias("distance"))


@q("inner_enrich", o("txn cust", "SELECT event_id, cc_num, name FROM txn JOIN cust USING (cc_num)"))
def inner_enrich(spark, d):
    return rel.enrich(fx.txn(spark, d), fx.cust(spark, d), ["cc_num"], "inner").select("event_id", "cc_num", "name")


@q("star_join_3way", "SELECT o_orderkey, o_orderstatus, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey "
   "JOIN nation ON c_nationkey = n_nationkey")
def star_join_3way(spark, d):
    orders = fx.table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    nation = fx.table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return rel.star(orders, [
        (fx.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), ["c_custkey"]),
        (nation, ["c_nationkey"])]).select("o_orderkey", "o_orderstatus", "c_name", "n_name")


@q("using_join", o("txn cust", "SELECT * FROM (SELECT cc_num, count(*) AS n FROM txn GROUP BY cc_num) "
   "JOIN (SELECT cc_num, name FROM cust) USING (cc_num)"))
def using_join(spark, d):
    return rel.join_using(
        rel.count_by(fx.txn(spark, d), ["cc_num"]), fx.cust(spark, d).select("cc_num", "name"), ["cc_num"])


@q("adjacent_bucket_join", o("txn", """
b AS (SELECT cc_num, CAST(floor(epoch(ts)) AS BIGINT) // 259200 AS bucket, count(*) AS n FROM txn GROUP BY ALL)
SELECT x.cc_num, x.bucket, x.n + coalesce(y.n, 0) AS n2
FROM b x LEFT JOIN b y ON x.cc_num = y.cc_num AND y.bucket = x.bucket - 1"""))
def adjacent_bucket_join(spark, d):
    return rel.adjacent_buckets(rel.partials(fx.txn(spark, d), ["cc_num"], "ts", 3 * DAY), "cc_num", "bucket")


@q("semi_join", o("txn labels_card", "SELECT event_id, cc_num FROM txn WHERE cc_num IN (SELECT cc_num FROM labels_card WHERE label = 'fraud')"))
def semi_join(spark, d):
    fraud = fx.labels_card(spark, d).filter("label = 'fraud'").select("cc_num")
    return rel.semi(fx.txn(spark, d), fraud, ["cc_num"]).select("event_id", "cc_num")


@q("anti_join", o("txn labels_card", "SELECT event_id, cc_num FROM txn WHERE cc_num NOT IN (SELECT cc_num FROM labels_card)"))
def anti_join(spark, d):
    return rel.anti(fx.txn(spark, d), fx.labels_card(spark, d).select("cc_num"), ["cc_num"]).select("event_id", "cc_num")


@q("cross_join_unnest", o("txn", "SELECT cc_num, n, unnest(moments) AS ts FROM (SELECT cc_num, count(*) AS n, "
   "list(ts) AS moments FROM txn GROUP BY cc_num, CAST(ts AS DATE))"))
def cross_join_unnest(spark, d):
    packed = fx.txn(spark, d).groupBy("cc_num", fn.day("ts").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.collect_list("ts").alias("moments"))
    return rel.unnest(packed, "moments", "ts").select("cc_num", "n", "ts")


@q("residual_inequality", "SELECT o_orderkey, l_linenumber, l_returnflag, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey "
   "AND l_linestatus <> o_orderstatus")
def residual_inequality(spark, d):
    a = fx.table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    b = fx.table(spark, d, "orders")
    return rel.join_where(a, b, ["o_orderkey"], F.col("l_linestatus") != F.col("o_orderstatus")).select(
        "a.o_orderkey", "l_linenumber", "l_returnflag", "o_orderstatus")


# -- aggregations -------------------------------------------------------------

@q("group_count", o("txn", "SELECT cc_num, count(*) AS n FROM txn GROUP BY cc_num"))
def group_count(spark, d):
    return rel.count_by(fx.txn(spark, d), ["cc_num"])


@q("conditional_sum", o("txn", "SELECT cc_num, CAST(sum(CASE WHEN category = 'gift card' THEN 1 ELSE 0 END) AS BIGINT) AS gifts, "
   "CAST(sum(CASE WHEN category = 'gift card' THEN amt ELSE 0 END) AS DOUBLE) AS gift_amt FROM txn GROUP BY cc_num"))
def conditional_sum(spark, d):
    gift = F.col("category") == "gift card"
    return _dbl(rel.sum_if(fx.txn(spark, d), ["cc_num"], {
        "gifts": (gift, F.lit(1)), "gift_amt": (gift, F.col("amt"))}), "gift_amt")


@q("avg_stddev_group", o("txn", "SELECT cc_num, category, round(CAST(sum(amt) AS DOUBLE) / count(amt), 6) AS avg, "
   "round(coalesce(stddev_samp(CAST(amt AS DOUBLE)), 0), 6) AS stddev, count(amt) AS n FROM txn GROUP BY cc_num, category"))
def avg_stddev_group(spark, d):
    out = rel.moments(fx.txn(spark, d), ["cc_num", "category"], "amt")
    return out.withColumns({"avg": F.round("avg", 6), "stddev": F.round("stddev", 6)})


@q("array_agg", o("txn", "SELECT cc_num, category, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS items "
   "FROM txn GROUP BY cc_num, category"))
def array_agg(spark, d):
    out = rel.collect_sorted(fx.txn(spark, d), ["cc_num", "category"], "event_id")
    return out.withColumn("items", F.array_join(F.col("items").cast("array<string>"), ","))


@q("distinct_rows", o("txn", "SELECT DISTINCT cc_num, category FROM txn"))
def distinct_rows(spark, d):
    return rel.distinct(fx.txn(spark, d), ["cc_num", "category"])


_CELLS = ("SELECT cc_num, CAST(d AS VARCHAR) AS d, count(*) AS n FROM (SELECT DISTINCT cc_num, CAST(ts AS DATE) AS d, "
          "floor(shipping_lat * 10) AS a, floor(shipping_long * 10) AS b FROM txn) GROUP BY cc_num, d")


def _cells(spark, d):
    a, b = fn.geo_cell("shipping_lat", "shipping_long")
    return fx.txn(spark, d).select("cc_num", fn.day("ts").cast("string").alias("d"), a.alias("a"), b.alias("b"))


@q("count_distinct_exact", o("txn", _CELLS))
def count_distinct_exact(spark, d):
    return rel.count_distinct(_cells(spark, d), ["cc_num", "d"], ["a", "b"])


@q("count_distinct_sketch", o("txn", "SELECT cc_num, count(*) AS n, true AS within FROM (SELECT DISTINCT cc_num, "
   "floor(shipping_lat * 10) AS a, floor(shipping_long * 10) AS b FROM txn) GROUP BY cc_num"))
def count_distinct_sketch(spark, d):
    """Per card the exact count, and whether the estimate of merged per-day sketches is within a tenth of it."""
    daily = rel.sketch(_cells(spark, d), ["cc_num", "d"], ["a", "b"])
    exact = rel.count_distinct(_cells(spark, d), ["cc_num"], ["a", "b"])
    return rel.estimate(daily, ["cc_num"]).join(exact, "cc_num").select(
        "cc_num", "n", (F.abs(F.col("estimate") - F.col("n")) <= 1 + F.col("n") / 10).alias("within"))


@q("partial_state_merge", o("txn", "SELECT cc_num, CAST(floor(epoch(ts)) AS BIGINT) // 604800 AS bucket, count(*) AS n FROM txn GROUP BY ALL"))
def partial_state_merge(spark, d):
    """Each day arrives as one block; blocks keep partial counts that merge later."""
    blocks = rel.partials(fx.txn(spark, d), ["cc_num", fn.day("ts").alias("block")], "ts", 7 * DAY)
    return rel.merge_partials(blocks, "cc_num")


_LAST = ("SELECT cc_num, ts, CAST(amt AS DOUBLE) AS amt, category FROM txn "
         "QUALIFY row_number() OVER (PARTITION BY cc_num ORDER BY ts DESC, event_id DESC) = 1")


@q("argmax_group", o("txn", _LAST))
def argmax_group(spark, d):
    return _dbl(rel.latest(fx.txn(spark, d), ["cc_num"], ["ts", "event_id"], ["ts", "amt", "category"]), "amt")


@q("distinct_on_latest", o("txn", _LAST))
def distinct_on_latest(spark, d):
    out = rel.first_per_key(fx.txn(spark, d), ["cc_num"], [F.desc("ts"), F.desc("event_id")])
    return _dbl(out.select("cc_num", "ts", "amt", "category"), "amt")


@q("percentile_interp", o("txn", "SELECT " + ", ".join(
    f"round(quantile_cont(n, {p / 100}), 6) AS p{p}" for p in (50, 90, 95, 99)) +
   ", max(n) AS max FROM (SELECT cc_num, CAST(count(*) AS DOUBLE) AS n FROM txn GROUP BY cc_num)"))
def percentile_interp(spark, d):
    counts = rel.count_by(fx.txn(spark, d), ["cc_num"]).withColumn("n", F.col("n").cast("double"))
    out = rel.percentiles(counts, "n", [50, 90, 95, 99])
    return out.select(*[F.round(c, 6).alias(c) for c in ("p50", "p90", "p95", "p99")], "max")


@q("row_count", o("near_txn cust", FIVE_SQL + "SELECT count(*) AS n FROM exact"))
def row_count(spark, d):
    return rel.total(cards.flagged_exact(fx.near_txn(spark, d), fx.cust(spark, d), DETECT))


# -- windows ------------------------------------------------------------------

@q("rolling_range_seconds", o("txn_ml", """
SELECT event_id, count(*) OVER (PARTITION BY cc_num ORDER BY unix_time RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS n,
  round(CAST(sum(amt) OVER (PARTITION BY cc_num ORDER BY unix_time RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS DOUBLE)
    / count(amt) OVER (PARTITION BY cc_num ORDER BY unix_time RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW), 6) AS avg_week
FROM txn_ml"""))
def rolling_range_seconds(spark, d):
    out = win.rolling(fx.txn_ml(spark, d), ["cc_num"], "unix_time", {
        "n": win.Trailing(DAY), "avg_week": win.Trailing(7 * DAY, "avg", "amt")})
    return out.select("event_id", "n", F.round("avg_week", 6).alias("avg_week"))


@q("rolling_multi_key", o("txn_ml", """
SELECT event_id, round(coalesce(CAST(sum(amt) OVER w AS DOUBLE) / count(amt) OVER w, 0), 6) AS avg_3m
FROM txn_ml WINDOW w AS (PARTITION BY cc_num, day(trans_date_trans_time) ORDER BY unix_time
  RANGE BETWEEN 7776000 PRECEDING AND CURRENT ROW)"""))
def rolling_multi_key(spark, d):
    rows = fx.txn_ml(spark, d).withColumn("dom", fn.date_part("day", "trans_date_trans_time"))
    out = win.rolling(rows, ["cc_num", "dom"], "unix_time", {"avg_3m": win.Trailing(90 * DAY, "avg", "amt")})
    return out.select("event_id", F.round(F.coalesce("avg_3m", F.lit(0.0)), 6).alias("avg_3m"))


@q("rolling_filtered", o("txn", "SELECT event_id, count(*) OVER (PARTITION BY cc_num ORDER BY ts RANGE BETWEEN "
   "INTERVAL 30 DAY PRECEDING AND CURRENT ROW) AS n FROM txn WHERE category = 'gift card'"))
def rolling_filtered(spark, d):
    return win.rolling_where(
        fx.txn(spark, d), F.col("category") == "gift card", ["cc_num"], "ts", win.days(30)).select("event_id", "n")


@q("lag_pair", o("txn", "SELECT event_id, lag(shipping_lat) OVER w AS plat, lag(shipping_long) OVER w AS plong, "
   "lag(ts) OVER w AS pts FROM txn WINDOW w AS (PARTITION BY cc_num ORDER BY ts, event_id)"))
def lag_pair(spark, d):
    return win.lag_cols(fx.txn(spark, d), ["cc_num"], "ts", {
        "plat": "shipping_lat", "plong": "shipping_long", "pts": "ts"}, "event_id").select(
        "event_id", "plat", "plong", "pts")


@q("peak_window_count", o("txn", "SELECT cc_num, max(c) AS peak FROM (SELECT cc_num, count(*) FILTER (category = 'gift card') OVER "
   "(PARTITION BY cc_num ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS c FROM txn) GROUP BY cc_num"))
def peak_window_count(spark, d):
    return win.peak(fx.txn(spark, d), "cc_num", "ts", win.days(7), F.col("category") == "gift card")


@q("running_new_events", o("txn", """
daily AS (SELECT category AS series, CAST(CAST(ts AS DATE) AS VARCHAR) AS step, count(*) AS n FROM txn GROUP BY ALL),
cum AS (SELECT series, step, CAST(sum(n) OVER (PARTITION BY series ORDER BY step) AS BIGINT) AS total FROM daily)
SELECT series, step, total, total - coalesce(lag(total) OVER w, 0) AS new_total, max(total) OVER w AS max_total
FROM cum WINDOW w AS (PARTITION BY series ORDER BY step)"""))
def running_new_events(spark, d):
    daily = fx.txn(spark, d).groupBy(
        F.col("category").alias("series"), fn.day("ts").cast("string").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    cum = daily.select("series", "step", F.sum("n").over(Window.partitionBy("series").orderBy("step")).alias("total"))
    return win.step_delta(cum, "series", "step", "total")


def _engagement_sql(entity: str) -> str:
    spans = {"h": "1 HOUR", "d": "1 DAY", "w": "7 DAY"}
    cols = ", ".join(
        f"count(*) OVER {s} AS interaction_len_{s}, "
        f"round(CAST(sum(watch_time) OVER {s} AS DOUBLE) / count(watch_time) OVER {s}, 6) AS average_watch_time_{s}"
        for s in spans)
    wins = ", ".join(
        f"{s} AS (PARTITION BY {entity} ORDER BY interaction_date RANGE BETWEEN INTERVAL {i} PRECEDING AND CURRENT ROW)"
        for s, i in spans.items())
    return f"SELECT interaction_id, {entity}, interaction_type, {cols}, interaction_date AS hour_start FROM interactions WINDOW {wins}"


def _engagement(spark, d, entity):
    out = win.engagement(fx.interactions(spark, d), entity, "interaction_date", "watch_time")
    spans = ("h", "d", "w")
    return out.select(
        "interaction_id", entity, "interaction_type", *[f"interaction_len_{s}" for s in spans],
        *[F.round(f"average_watch_time_{s}", 6).alias(f"average_watch_time_{s}") for s in spans],
        F.col("interaction_date").alias("hour_start"))


@q("engagement_rolling", o("interactions", _engagement_sql("video_id")))
def engagement_rolling(spark, d):
    return _engagement(spark, d, "video_id")


@q("engagement_rolling_user", o("interactions", _engagement_sql("user_id")))
def engagement_rolling_user(spark, d):
    return _engagement(spark, d, "user_id")


# -- time windows and buckets -------------------------------------------------

@q("hop_window", o("txn", "SELECT event_id, date_trunc('hour', ts) - to_hours(k) AS window_start, "
   "date_trunc('hour', ts) - to_hours(k) + INTERVAL 4 HOUR AS window_end FROM txn CROSS JOIN range(4) AS r(k)"))
def hop_window(spark, d):
    return win.hop(fx.txn(spark, d), "ts", "4 hours", "1 hour").select("event_id", "window_start", "window_end")


@q("tumble_window", o("txn", "SELECT cc_num, time_bucket(INTERVAL 6 HOUR, ts) AS window_start, "
   "time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end, count(*) AS n FROM txn GROUP BY ALL"))
def tumble_window(spark, d):
    return rel.count_by(win.tumble(fx.txn(spark, d), "ts", "6 hours"), ["cc_num", "window_start", "window_end"])


@q("epoch_bucket", o("txn", "SELECT cc_num, CAST(floor(epoch(ts)) AS BIGINT) // 604800 AS bucket, count(*) AS n FROM txn GROUP BY ALL"))
def epoch_bucket(spark, d):
    return rel.partials(fx.txn(spark, d), ["cc_num"], "ts", 7 * DAY)


@q("calendar_day", o("txn", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS d, count(*) AS n FROM txn GROUP BY ALL"))
def calendar_day(spark, d):
    return fx.txn(spark, d).groupBy(fn.day("ts").cast("string").alias("d")).agg(F.count(F.lit(1)).alias("n"))


@q("month_stamp", o("txn", "SELECT event_id, date_trunc('month', ts) + (ts - date_trunc('day', ts)) AS month_ts FROM txn"))
def month_stamp(spark, d):
    return fx.txn(spark, d).select("event_id", fn.month_stamp("ts").cast("timestamp_ntz").alias("month_ts"))


# -- order, top-k, sets -------------------------------------------------------

@q("order_by_desc", o("txn cust", AGGREGATES + """
SELECT cc_num, CAST(sum(priority) AS BIGINT) AS total_priority FROM alerts GROUP BY cc_num ORDER BY total_priority DESC, cc_num"""))
def order_by_desc(spark, d):
    out = cards.fraud_alert_details(fx.txn(spark, d), fx.cust(spark, d), ALERTS)
    return rel.ordered(out.select("cc_num", "total_priority"), [F.desc("total_priority"), "cc_num"])


@q("top_k", o("interactions", "SELECT interaction_id, video_id, interaction_len_d FROM (" + _engagement_sql("video_id") + ") "
   "ORDER BY interaction_len_d DESC, interaction_id LIMIT 5"))
def top_k(spark, d):
    out = _engagement(spark, d, "video_id").select("interaction_id", "video_id", "interaction_len_d")
    return rel.top_k(out, "interaction_len_d", 5, ["interaction_id"])


@q("limit_sample", o("txn", "SELECT event_id, cc_num, ts FROM txn ORDER BY ts, event_id LIMIT 5"))
def limit_sample(spark, d):
    return rel.sample_rows(fx.txn(spark, d).select("event_id", "cc_num", "ts"), 5, ["ts", "event_id"])


@q("union_distinct", o("txn", "SELECT cc_num FROM txn WHERE category = 'gift card' UNION SELECT cc_num FROM txn WHERE amt > 30"))
def union_distinct(spark, d):
    txn = fx.txn(spark, d)
    return rel.union_distinct([
        txn.filter(F.col("category") == "gift card").select("cc_num"), txn.filter(F.col("amt") > 30).select("cc_num")])


@q("union_padded", o("txn", """
hourly AS (SELECT cc_num, time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n FROM txn GROUP BY ALL)
SELECT cc_num, ts, CAST(amt AS DOUBLE) AS amt, CAST(-1 AS BIGINT) AS metric_value, 'large_amount' AS signal_type FROM txn WHERE amt > 60
UNION ALL SELECT cc_num, window_start, -1.0e0, n, 'busy_hour' FROM hourly WHERE n >= 2"""))
def union_padded(spark, d):
    txn = fx.txn(spark, d)
    hourly = rel.count_by(win.tumble(txn, "ts", "1 hour"), ["cc_num", "window_start"], "metric_value")
    shape = T.StructType([
        T.StructField("cc_num", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("amt", T.DoubleType()), T.StructField("metric_value", T.LongType())])
    out = rel.union_signals(
        {"large_amount": txn.filter(F.col("amt") > 60), "busy_hour": hourly.filter("metric_value >= 2")},
        shape, {"window_start": "ts"})
    return out.fillna({"amt": -1.0, "metric_value": -1})


@q("set_algebra", o("near_txn cust labels_card", FIVE_SQL + """
SELECT coalesce(e.cc_num, l.cc_num) AS cc_num, e.cc_num IS NOT NULL AS in_a, l.cc_num IS NOT NULL AS in_b
FROM exact e FULL JOIN (SELECT cc_num FROM labels_card WHERE label = 'fraud') l ON e.cc_num = l.cc_num"""))
def set_algebra(spark, d):
    flagged = cards.flagged_exact(fx.near_txn(spark, d), fx.cust(spark, d), DETECT)
    fraud = fx.labels_card(spark, d).filter("label = 'fraud'").select("cc_num")
    return rel.set_ops(flagged, fraud, ["cc_num"])


# -- scalar functions ---------------------------------------------------------

@q("l1_distance", o("txn cust", "SELECT event_id, round(distance, 6) AS distance FROM (" + JOINED.format("") + ")"))
def l1_distance(spark, d):
    return cards.with_distance(fx.txn(spark, d), fx.cust(spark, d), "inner").select(
        "event_id", F.round("distance", 6).alias("distance"))


@q("euclid_distance", o("txn cust", ONE_DAY + "SELECT event_id, round(distance, 6) AS distance FROM enriched"))
def euclid_distance(spark, d):
    both = fx.txn(spark, d).join(fx.cust(spark, d), "cc_num", "left")
    return both.select("event_id", F.round(fn.euclid(
        F.col("shipping_lat"), F.col("shipping_long"), F.col("lat"), F.col("long")), 6).alias("distance"))


@q("geo_cell", o("txn", "SELECT event_id, CAST(floor(shipping_lat * 10) AS BIGINT) AS clat, "
   "CAST(floor(shipping_long * 10) AS BIGINT) AS clong FROM txn"))
def geo_cell(spark, d):
    a, b = fn.geo_cell("shipping_lat", "shipping_long")
    return fx.txn(spark, d).select("event_id", a.alias("clat"), b.alias("clong"))


@q("numeric_misc", o("txn", "SELECT event_id, round(shipping_lat / 3, 3) AS third, least(CAST(amt AS DOUBLE), 50.0e0) AS capped, "
   "coalesce(nullif(CAST(amt AS DOUBLE), 1.5e0), 0) AS filled, CAST(floor(CAST(amt AS DOUBLE)) AS BIGINT) AS whole FROM txn"))
def numeric_misc(spark, d):
    amt = F.col("amt").cast("double")
    return fx.txn(spark, d).select(
        "event_id", fn.round3(F.col("shipping_lat") / 3).alias("third"), fn.least_strict(amt, F.lit(50.0)).alias("capped"),
        fn.coalesce0(F.nullif(amt, F.lit(1.5))).alias("filled"), F.floor(amt).cast("bigint").alias("whole"))


@q("review_priority", o("txn", "SELECT cc_num, CAST(count(*) AS DOUBLE) * 1000 + least(CAST(max(amt) AS DOUBLE), 9999.0e0) AS review_priority "
   "FROM txn GROUP BY cc_num"))
def review_priority(spark, d):
    per = fx.txn(spark, d).groupBy("cc_num").agg(F.count(F.lit(1)).alias("n"), F.max("amt").alias("amt"))
    return per.select("cc_num", fn.review_priority(F.col("n"), F.col("amt")).alias("review_priority"))


@q("date_parts", o("txn", "SELECT event_id, CAST(dayofweek(ts) + 1 AS INTEGER) AS d, CAST(hour(ts) AS INTEGER) AS h, CAST(day(ts) AS INTEGER) AS dom, "
   "CAST(floor(epoch(ts)) AS BIGINT) AS secs FROM txn"))
def date_parts(spark, d):
    p = fn.date_part
    return fx.txn(spark, d).select(
        "event_id", p("dayofweek", "ts").alias("d"), p("hour", "ts").alias("h"), p("day", "ts").alias("dom"),
        p("epoch", "ts").alias("secs"))


_EXPIRY = "CAST('20' || substr(cc_expiration_date, 4, 2) || '-' || substr(cc_expiration_date, 1, 2) || '-01 00:00:00' AS TIMESTAMP)"


@q("age_and_expiry", o("fs_txn profiles", f"""
SELECT tid, date_sub('year', birthdate, date_time) AS age, date_sub('day', date_time, {_EXPIRY}) AS days_left
FROM fs_txn JOIN profiles USING (cc_num)"""))
def age_and_expiry(spark, d):
    both = fx.fs_txn(spark, d).join(fx.profiles(spark, d), "cc_num")
    return both.select(
        "tid", fn.age_years("birthdate", "date_time").alias("age"),
        fn.days_until("date_time", fn.parse_expiry("cc_expiration_date")).alias("days_left"))


@q("expiry_parse", o("profiles", f"SELECT cc_num, {_EXPIRY} AS expires FROM profiles"))
def expiry_parse(spark, d):
    return fx.profiles(spark, d).select("cc_num", fn.parse_expiry("cc_expiration_date").alias("expires"))


@q("interval_compare", o("txn", "SELECT event_id FROM (SELECT event_id, ts, lag(ts) OVER (PARTITION BY cc_num ORDER BY ts, event_id) AS p FROM txn) "
   "WHERE ts < p + INTERVAL 1 HOUR"))
def interval_compare(spark, d):
    rows = win.lag_cols(fx.txn(spark, d), ["cc_num"], "ts", {"p": "ts"}, "event_id")
    return rows.filter(fn.within("ts", "p", 3600)).select("event_id")


@q("variant_extract", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def variant_extract(spark, d):
    return fx.table(spark, d, "events").select("event_id", fn.json_field("props", "$.k", "int").alias("k"))


@q("html_to_text", r"""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '<script[^>]*>.*?</script>', ' ', 'gs'), '<style[^>]*>.*?</style>', ' ', 'gs'), '<[^>]+>', ' ', 'g'),
  '&[a-z#0-9]+;', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages""")
def html_to_text(spark, d):
    return fx.table(spark, d, "pages").select("page_id", fn.html_to_text("html").alias("text"))
