"""Card alerts: rolling signals, review ranking and the five-signal detector."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import epoch_bucket, euclid, geo_cell, l1, review_priority, round3, within
from ..operators.relational import signals_long
from ..operators.windows import (
    Trailing, days, lag_parts, lag_plain, lag_sliced, rolling_parts, rolling_plain, rolling_sliced,
    time_axis,
)
from ..params import DAY, AlertParams, DetectorParams, SkimParams
from ..skew import HOT_ROWS, HotSplit, bounded_broadcast, split_hot

GIFT = "gift card"


def _near_home(cust: DataFrame, parts: HotSplit) -> DataFrame:
    """Dimension rows of the hot keys only: at most one per hot key."""
    return bounded_broadcast(cust.join(parts.keys, "cc_num", "left_semi"), parts.n_keys)  # a NULL card has no home


def with_distance(txn: DataFrame, cust: DataFrame, how: str = "left") -> DataFrame:
    """Transactions with the L1 distance between shipping address and home."""
    home = cust.select("cc_num", "lat", "long")
    distance = l1(F.col("shipping_lat"), F.col("shipping_long"), F.col("lat"), F.col("long"))
    return txn.join(home, "cc_num", how).withColumn("distance", distance).drop("lat", "long")


def _per_card(txn, cust, hot_rows, build) -> DataFrame:
    """Run ``build`` on cold rows, and on hot rows (``parts`` None) with their few home rows."""
    values = [F.col("amt")] if isinstance(txn.schema["amt"].dataType, T.DecimalType) else []
    parts = split_hot(txn, ["cc_num"], time_axis(txn, "ts"), hot_rows, values)
    out = build(txn=parts.cold, cust=cust, parts=parts)
    if parts.hot is not None:
        hot = build(txn=parts.hot, cust=_near_home(cust, parts), parts=None)
        out = out.unionByName(hot.select(*out.columns))
    return out


def alert_aggregates(
    txn: DataFrame, cust: DataFrame, params: AlertParams, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Every transaction with its distance and all trailing features."""
    gift = F.col("category") == GIFT
    far = F.col("distance") > F.lit(params.far_distance)
    specs = {
        "avg_7day": Trailing(days(7), "avg", "amt"),
        "gift_count_30day": Trailing(days(30), where=gift),
        "gift_sum_30day": Trailing(days(30), "sum", "amt", gift),
        "gift_count_45day": Trailing(days(45), where=gift),
        "gift_sum_45day": Trailing(days(45), "sum", "amt", gift),
        "txn_count_7day": Trailing(days(7)),
        "txn_sum_7day": Trailing(days(7), "sum", "amt"),
        "disp_count_3day": Trailing(days(3), where=far),
        "disp_sum_3day": Trailing(days(3), "sum", "amt", far),
    }

    def build(txn, cust, parts):
        rows = with_distance(txn, cust)
        if parts is None:
            return rolling_sliced(rows, ["cc_num"], "ts", specs)
        return rolling_plain(rows, ["cc_num"], "ts", specs, parts)

    return _per_card(txn.filter(F.col("ts").isNotNull()), cust, hot_rows, build)


def alert_specs(params: AlertParams) -> list[tuple[str, Column, Column, int]]:
    """(signal, fires, alert amount, priority) for the four rolling signals."""
    p = params.priority
    c = F.col
    return [
        ("gift_card_burst_30d", c("gift_count_30day") >= params.gift_30d, c("gift_sum_30day"),
         p["gift_card_burst_30d"]),
        ("gift_card_burst_45d", c("gift_count_45day") >= params.gift_45d, c("gift_sum_45day"),
         p["gift_card_burst_45d"]),
        ("spend_velocity_7d", c("txn_count_7day") >= params.velocity_7d, c("txn_sum_7day"),
         p["spend_velocity_7d"]),
        ("repeated_displacement", c("disp_count_3day") >= params.displaced_3d, c("disp_sum_3day"),
         p["repeated_displacement"]),
    ]


def fraud_alerts(aggregates: DataFrame, params: AlertParams) -> DataFrame:
    """One row per (transaction, fired signal)."""
    return signals_long(aggregates, ["cc_num", "ts"], alert_specs(params))


LATEST = ["amt", "category", "shipping_lat", "shipping_long", "distance", "avg_7day"]


def fraud_alert_details(
    txn: DataFrame,
    cust: DataFrame,
    params: AlertParams,
    latest: str = "argmax",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """One row per flagged card with score, alert summary, snapshot and rank.

    The signals, the alert summary and the card snapshot are folded in one
    aggregation on the key the windows are already partitioned by, so the whole
    plan shuffles once. ``latest='argmax'`` snapshots the card's last row,
    ``'min'`` takes each column's minimum beside the last time.
    """
    rows = alert_aggregates(txn, cust, params, hot_rows)
    return review_cards(rows, params, latest)


def review_cards(rows: DataFrame, params: AlertParams, latest: str = "argmax") -> DataFrame:
    specs = alert_specs(params)
    fired = [F.when(cond, F.lit(prio)).otherwise(F.lit(0)) for _, cond, _, prio in specs]
    amounts = [F.when(cond, amt) for _, cond, amt, _ in specs]
    any_fired = sum(fired[1:], fired[0]) > 0
    tie = ["ts"] + [c for c in ("event_id",) if c in rows.columns]
    if latest == "argmax":
        snapshot = [F.max_by(F.struct("ts", *LATEST), F.struct(*tie)).alias("b")]
    elif latest == "min":
        snapshot = [F.struct(F.max("ts").alias("ts"), *[F.min(c).alias(c) for c in LATEST]).alias("b")]
    else:
        raise ValueError("latest must be 'argmax' or 'min'")
    per_card = rows.groupBy("cc_num").agg(
        F.sum(sum(fired[1:], fired[0])).alias("total_priority"),
        F.max(F.greatest(*amounts)).alias("alert_amt"),
        F.max(F.when(any_fired, F.col("ts"))).alias("alert_ts"),
        *snapshot,
    )
    return per_card.filter(F.col("total_priority") > 0).select(
        "cc_num", "total_priority", "alert_amt", "alert_ts",
        F.col("b.ts").alias("ts"), F.col("b.amt").alias("amt"), F.col("b.category").alias("category"),
        F.col("b.shipping_lat").alias("shipping_lat"), F.col("b.shipping_long").alias("shipping_long"),
        round3(F.col("b.distance")).alias("distance"),
        F.coalesce(F.col("b.avg_7day"), F.lit(0.0)).alias("avg_7day"),
        review_priority(
            F.col("total_priority"), F.col("b.amt"), params.review_scale, params.review_cap
        ).alias("review_priority"),
    )


# -- five-signal detector -----------------------------------------------------

FIVE = ["gift_30d", "velocity_7d", "displaced_3d", "impossible_travel", "fan_out"]


def card_signals(
    txn: DataFrame, cust: DataFrame, params: DetectorParams, hot_rows: int | None = HOT_ROWS,
    tie: str = "event_id",
) -> DataFrame:
    """Per card, whether each of the five signals ever fires.

    One pass: the previous-row lookup and all trailing counts share the card
    partitioning; the distinct (day, cell) count and the card rollup reuse it.
    """
    gift = F.col("category") == GIFT
    far = F.col("distance") > F.lit(params.far_distance)
    prev = {"__plat": "shipping_lat", "__plong": "shipping_long", "__pts": "ts"}
    specs = {
        "__gift": Trailing(days(30), where=gift),
        "__vel": Trailing(days(7)),
        "__far": Trailing(days(3), where=far),
    }

    def build(txn, cust, parts):
        rows = with_distance(txn, cust)
        if parts is not None:
            rows = lag_plain(rows, ["cc_num"], "ts", prev, tie)
            return rolling_plain(rows, ["cc_num"], "ts", specs, parts)
        lagged = lag_sliced(rows, ["cc_num"], "ts", prev, tie, keep_slice=True)
        return rolling_sliced(lagged, ["cc_num"], "ts", specs)

    rows = _per_card(txn, cust, hot_rows, build)
    jump = l1(F.col("shipping_lat"), F.col("shipping_long"), F.col("__plat"), F.col("__plong"))
    travel = (jump > params.travel_distance) & within("ts", "__pts", params.travel_seconds)
    clat, clong = geo_cell("shipping_lat", "shipping_long")
    cells = rows.groupBy("cc_num", F.to_date("ts").alias("d"), clat.alias("clat"), clong.alias("clong")).agg(
        F.max("__gift").alias("gift"), F.max("__vel").alias("vel"), F.max("__far").alias("far"),
        F.max(F.coalesce(travel, F.lit(False))).alias("travel"))
    per_day = cells.groupBy("cc_num", "d").agg(
        F.count(F.lit(1)).alias("nloc"), F.max("gift").alias("gift"), F.max("vel").alias("vel"),
        F.max("far").alias("far"), F.max("travel").alias("travel"))
    return per_day.groupBy("cc_num").agg(
        (F.max("gift") >= params.gift_30d).alias("gift_30d"),
        (F.max("vel") >= params.velocity_7d).alias("velocity_7d"),
        (F.max("far") >= params.displaced_3d).alias("displaced_3d"),
        F.max("travel").alias("impossible_travel"),
        (F.max("nloc") >= params.fan_out_day).alias("fan_out"),
    )


def flagged_exact(txn, cust, params: DetectorParams, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    fired = [F.col(c) for c in FIVE]
    any_fired = fired[0] | fired[1] | fired[2] | fired[3] | fired[4]
    return card_signals(txn, cust, params, hot_rows).filter(any_fired).select("cc_num")


def day_tiles(txn: DataFrame, cust: DataFrame, params: DetectorParams) -> DataFrame:
    """Per card and day: gift, all and far transactions and distinct places, from one scan.

    The first shuffle is on (card, day, place), so a hot card spreads over all tasks.
    """
    rows = with_distance(txn, cust)
    clat, clong = geo_cell("shipping_lat", "shipping_long")
    cells = rows.groupBy("cc_num", epoch_bucket("ts", DAY).alias("d"), clat.alias("clat"), clong.alias("clong")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("category") == GIFT).alias("gift"),
        F.count_if(F.col("distance") > params.far_distance).alias("far"))
    return cells.groupBy("cc_num", "d").agg(
        F.count(F.lit(1)).alias("nloc"), F.sum("n").alias("n"), F.sum("gift").alias("gift"), F.sum("far").alias("far"))


def bucket_flags(txn: DataFrame, cust: DataFrame, params: DetectorParams) -> DataFrame:
    """Per card: number of transactions and whether the two approximations flag it.

    ``two_bucket`` adds up two adjacent fixed buckets per window and also looks at the
    places of a day; ``one_bucket`` takes single buckets with lowered thresholds.
    Buckets of 3, 7 and 30 days are sums of the same day tiles.
    """
    tiles = day_tiles(txn, cust, params)
    part = lambda name, days_, n: F.struct(
        F.lit(name).alias("signal"), F.floor(F.col("d") / days_).alias("bk"), F.col(n).alias("n"))
    parts = tiles.select("cc_num", F.inline(F.array(
        part("gift", 30, "gift"), part("velocity", 7, "n"), part("displaced", 3, "far"),
        part("fan_out", 1, "nloc")))).filter("n > 0")
    sums = parts.groupBy("cc_num", "signal", "bk").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("cc_num", "signal").orderBy("bk")
    before = F.coalesce(F.when(F.lag("bk").over(w) == F.col("bk") - 1, F.lag("n").over(w)), F.lit(0))
    s, n, n2 = F.col("signal"), F.col("n"), F.col("n") + before
    two = (
        ((s == "gift") & (n2 >= params.gift_30d)) | ((s == "velocity") & (n2 >= params.velocity_7d))
        | ((s == "displaced") & (n2 >= params.displaced_3d)) | ((s == "fan_out") & (n >= params.fan_out_day)))
    one = (
        ((s == "gift") & (n >= params.one_bucket_gift)) | ((s == "velocity") & (n >= params.one_bucket_velocity))
        | ((s == "displaced") & (n >= params.one_bucket_displaced)))
    seen = sums.select("cc_num", s, n, two.alias("two"), one.alias("one"))
    return seen.groupBy("cc_num").agg(
        F.sum(F.when(s == "velocity", n)).alias("n"), F.max("two").alias("two_bucket"), F.max("one").alias("one_bucket"))


def flagged_two_bucket(txn: DataFrame, cust: DataFrame, params: DetectorParams) -> DataFrame:
    return bucket_flags(txn, cust, params).filter("two_bucket").select("cc_num")


def flagged_one_bucket(txn: DataFrame, cust: DataFrame, params: DetectorParams) -> DataFrame:
    return bucket_flags(txn, cust, params).filter("one_bucket").select("cc_num")


DETECTORS = ["exact", "two_bucket", "one_bucket"]


def detector_table(txn: DataFrame, cust: DataFrame, params: DetectorParams, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Per card: number of transactions and the verdict of every detector, from two scans."""
    signals = card_signals(txn, cust, params, hot_rows)
    any_fired = F.coalesce(F.greatest(*FIVE), F.lit(False))
    no = F.lit(False)
    both = signals.select("cc_num", F.lit(0).cast("bigint").alias("n"), any_fired.alias("exact"), no.alias("two_bucket"),
                          no.alias("one_bucket")).unionByName(
        bucket_flags(txn, cust, params).select("cc_num", "n", no.alias("exact"), "two_bucket", "one_bucket"))
    return both.groupBy("cc_num").agg(F.sum("n").alias("n"), *[F.max(d).alias(d) for d in DETECTORS])


def alert_context(txn: DataFrame, signals: DataFrame, period: tuple | None = None) -> DataFrame:
    """Per flagged card active in the period: signals, confidence, top transaction.

    Confidence is high when an exact long-window signal fired or several agree.
    """
    if period is not None:
        txn = txn.filter(F.col("ts").between(*[F.lit(p) for p in period]))
    names = F.array_compact(F.array(*[F.when(F.col(s), F.lit(s)) for s in FIVE]))
    flagged = signals.select("cc_num", names.alias("fired"), "gift_30d").filter(F.size("fired") > 0)
    top = txn.join(flagged.select("cc_num"), "cc_num", "left_semi").groupBy("cc_num").agg(
        F.max_by(
            F.struct("event_id", "ts", "amt", "category", "shipping_lat", "shipping_long"),
            F.struct("amt", "ts", "event_id")).alias("t"))
    confidence = F.when(F.col("gift_30d") | (F.size("fired") > 1), "high").otherwise("medium")
    return flagged.join(top, "cc_num").select(
        "cc_num", F.array_join("fired", ",").alias("signals"), F.size("fired").alias("n_signals"),
        confidence.alias("confidence"), "t.*")


# -- one-day enrichment and skimming signals ----------------------------------

def enrich_1day(txn: DataFrame, cust: DataFrame, far: float = 0.5, hot_rows=HOT_ROWS) -> DataFrame:
    """Planar distance in degrees, trailing day's average spend and far count."""
    specs = {
        "avg_1day": Trailing(days(1), "avg", "amt"),
        "count_1day": Trailing(days(1), where=F.col("distance") > F.lit(far)),
    }

    def build(txn, cust, parts):
        home = cust.select("cc_num", "lat", "long")
        rows = txn.join(home, "cc_num", "left").withColumn(
            "distance", euclid(F.col("shipping_lat"), F.col("shipping_long"), F.col("lat"), F.col("long"))
        ).drop("lat", "long")
        if parts is None:
            return rolling_sliced(rows, ["cc_num"], "ts", specs)
        return rolling_plain(rows, ["cc_num"], "ts", specs, parts)

    return _per_card(txn, cust, hot_rows, build)


def skim_signals(
    features: DataFrame, params: SkimParams = SkimParams(), hot_rows=HOT_ROWS
) -> dict[str, DataFrame]:
    """Five signal views over ``enrich_1day`` rows, each (cc_num, ts, amt, ...)."""
    parts = split_hot(features, ["cc_num"], time_axis(features, "ts"), hot_rows)
    prev = {"pts": "ts", "plat": "shipping_lat", "plong": "shipping_long"}
    seq = lag_parts(parts, ["cc_num"], "ts", prev, "event_id")
    jump = l1(F.col("shipping_lat"), F.col("shipping_long"), F.col("plat"), F.col("plong"))
    per_category = features.groupBy("cc_num", "category").agg(F.count(F.lit(1)).alias("n_cat"))
    per_card = per_category.groupBy("cc_num").agg(F.sum("n_cat").alias("n_all"))
    rare = per_category.join(per_card, "cc_num").filter(
        F.col("n_cat") <= F.col("n_all") * params.rare_share)
    burst = rolling_parts(
        parts, ["cc_num"], "ts", {"n_rapid": Trailing(timedelta(seconds=params.rapid_seconds))})
    base = ["cc_num", "ts", "amt", "event_id"]
    return {
        "probe_charge": features.filter(F.col("amt") <= params.probe_amount).select(*base),
        "geo_impossible": seq.filter(
            (jump > params.far_distance) & within("ts", "pts", params.travel_seconds)
        ).select(*base, "distance"),
        "unusual_category": features.join(
            rare.select("cc_num", "category"), ["cc_num", "category"], "left_semi").select(*base, "category"),
        "rapid_sequence": burst.filter(F.col("n_rapid") >= params.rapid_count).select(*base, "n_rapid"),
        "spend_spike": features.filter(
            F.col("amt").cast("double") > F.col("avg_1day") * params.spike_factor).select(*base, "avg_1day"),
    }


SIGNAL_COLUMNS = T.StructType([
    T.StructField("cc_num", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("event_id", T.LongType()),
])


def classify_cards(alerts: DataFrame) -> DataFrame:
    """Verdict per card from its alert rows (cc_num, signal_type, amt)."""
    per_signal = alerts.groupBy("cc_num", "signal_type").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("amt").alias("total_amt"))
    per_card = per_signal.groupBy("cc_num").agg(
        F.count(F.lit(1)).alias("n_signals"),
        F.sum("cnt").alias("hits"),
        F.coalesce(F.sum("total_amt").cast("double"), F.lit(0.0)).alias("total_amt"),
    )
    mean = F.col("total_amt") / F.col("hits")
    many = F.col("n_signals") >= 2
    return per_card.select(
        "cc_num", "n_signals", "hits", F.round("total_amt", 2).alias("total_amt"),
        F.when(many | (mean >= 100), "SUSPICIOUS").otherwise("BENIGN").alias("verdict"),
        F.when(many, "HIGH").when(mean >= 500, "MEDIUM").otherwise("LOW").alias("confidence"),
        F.when(many, "MULTI_SIGNAL").when(mean >= 500, "MEAN_AMT_500").when(mean >= 100, "MEAN_AMT_100")
        .otherwise("MEAN_AMT_LOW").alias("reason"),
    )
