"""Threshold calibration, detector scoring and workload pricing."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import l1, ratio
from ..operators.windows import Trailing, days, rolling
from ..params import AlertParams
from ..skew import HOT_ROWS
from .cards import GIFT

SIGNALS = ("gift_card_burst_30d", "gift_card_burst_45d", "spend_velocity_7d", "repeated_displacement")


def _hash(key: str, seed: int) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def sample_keys(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A seeded sample of exactly ``n`` distinct keys: those with the n smallest hashes.

    Deterministic for a seed and independent of partitioning. A hash cut-off
    slightly above the expected n-th value keeps the final sort near n rows; when
    the cut-off turns out too tight, all keys are sorted instead.
    """
    keys = df.select(key).distinct()
    total = keys.count()
    if total <= n:
        return keys
    share = min(1.0, (n + 10 * math.sqrt(n) + 10) / total)
    below = keys.filter(_hash(key, seed) < F.lit(int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1))
    if share == 1.0 or below.count() < n:
        below = keys
    return below.orderBy(_hash(key, seed), key).limit(n)


def sample_fraction(df: DataFrame, key: str, frac: float, seed: int) -> DataFrame:
    """Rows of a hash-selected share of keys; no shuffle, suits very large key sets."""
    bucket = F.pmod(_hash(key, seed), F.lit(1_000_000))
    return df.filter(bucket < F.lit(int(frac * 1_000_000)))


def signal_peaks(
    txn: DataFrame, cust: DataFrame, far_distance: float, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """(cc_num, signal, peak): the largest trailing count each card ever reaches.

    A missing home, address or amount counts as zero here, unlike in the alerts.
    """
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    rows = txn.filter(F.col("ts").isNotNull()).join(cust.select("cc_num", "lat", "long"), "cc_num", "left")
    rows = rows.select(
        "cc_num", "ts", (F.col("category") == GIFT).alias("gift"),
        (l1(zero("shipping_lat"), zero("shipping_long"), zero("lat"), zero("long")) > far_distance).alias("far"))
    counted = rolling(rows, ["cc_num"], "ts", {
        SIGNALS[0]: Trailing(days(30), where=F.col("gift")),
        SIGNALS[1]: Trailing(days(45), where=F.col("gift")),
        SIGNALS[2]: Trailing(days(7)),
        SIGNALS[3]: Trailing(days(3), where=F.col("far")),
    }, hot_rows)
    per_card = counted.groupBy("cc_num").agg(*[F.max(s).alias(s) for s in SIGNALS])
    return per_card.select("cc_num", F.inline(F.array(*[
        F.struct(F.lit(s).alias("signal"), F.col(s).alias("peak")) for s in SIGNALS])))


def peak_histogram(peaks: DataFrame) -> DataFrame:
    """Cards per (signal, peak): as many rows as distinct peak values."""
    return peaks.groupBy("signal", "peak").agg(F.count(F.lit(1)).alias("n"))


def calibrate_histogram(hist: DataFrame, current: dict[str, int], pct: float = 99.0) -> DataFrame:
    """Percentile report per signal and the threshold suggested at ``pct``."""
    stats = hist.groupBy("signal").agg(
        *[F.percentile("peak", p / 100.0, F.col("n")).alias(f"p{p}") for p in (50, 90, 95, 99)],
        F.max("peak").alias("max"),
        F.sum("n").alias("n_cards"),
        F.greatest(F.lit(1), F.bround(F.percentile("peak", pct / 100.0, F.col("n")), 0).cast("bigint")).alias("suggested"),
    )
    now: Column = F.lit(None).cast("bigint")
    for signal, value in current.items():
        now = F.when(F.col("signal") == signal, F.lit(value).cast("bigint")).otherwise(now)
    stats = stats.withColumn("current", now)
    joined = hist.join(stats.select("signal", "current", "suggested"), "signal")
    flagged = joined.groupBy("signal").agg(
        F.sum(F.when(F.col("peak") >= F.col("current"), F.col("n")).otherwise(0)).alias("flagged_current"),
        F.sum(F.when(F.col("peak") >= F.col("suggested"), F.col("n")).otherwise(0)).alias("flagged_suggested"))
    return stats.join(flagged, "signal")


def calibrate(
    txn: DataFrame, cust: DataFrame, params: AlertParams, pct: float = 99.0,
    sample: int | None = None, seed: int = 42,
) -> DataFrame:
    """Thresholds from the cards' own peaks, optionally on a seeded card sample."""
    if sample is not None:
        txn = txn.join(sample_keys(cust, "cc_num", sample, seed), "cc_num", "left_semi")
    current = dict(zip(SIGNALS, (params.gift_30d, params.gift_45d, params.velocity_7d, params.displaced_3d)))
    peaks = signal_peaks(txn, cust, params.far_distance)
    return calibrate_histogram(peak_histogram(peaks), current, pct)


def clamp(hist: DataFrame, suggested: DataFrame, max_frac: float = 0.10) -> DataFrame:
    """Raise a threshold that would flag more than ``max_frac`` of all cards.

    The answer is the smallest larger threshold within the share, i.e. one above
    the largest peak value whose tail is still too heavy.
    """
    tail = Window.partitionBy("signal").orderBy(F.desc("peak"))
    whole = Window.partitionBy("signal")
    cum = hist.select(
        "signal", "peak",
        (F.sum("n").over(tail) / F.sum("n").over(whole)).alias("frac"))
    heavy = cum.filter(F.col("frac") > max_frac).groupBy("signal").agg(F.max("peak").alias("heaviest"))
    out = suggested.join(heavy, "signal", "left")
    too_low = F.coalesce(F.col("heaviest") >= F.col("suggested"), F.lit(False))
    return out.select(
        "signal", "suggested",
        F.when(too_low, F.col("heaviest") + 1).otherwise(F.col("suggested")).alias("threshold"))


def score(flagged: DataFrame, labels: DataFrame, txn_counts: DataFrame) -> DataFrame:
    """One row: flagged, TP, FP, FN, precision, recall and transaction workload.

    ``labels`` lists the fraud cards; any other flagged card is a false positive.
    Precision and recall are 1.0 on an empty denominator.
    """
    tagged = reduce(lambda a, b: a.unionByName(b), [
        flagged.select("cc_num").distinct().select("cc_num", F.lit(1).alias("f"), F.lit(0).alias("l"), F.lit(0).alias("n")),
        labels.select("cc_num").distinct().select("cc_num", F.lit(0).alias("f"), F.lit(1).alias("l"), F.lit(0).alias("n")),
        txn_counts.select("cc_num", F.lit(0).alias("f"), F.lit(0).alias("l"), F.col("n")),
    ])
    cards = tagged.groupBy("cc_num").agg(
        (F.max("f") == 1).alias("f"), (F.max("l") == 1).alias("l"), F.sum("n").alias("n"))
    f, l = F.col("f"), F.col("l")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    counts = cards.agg(
        F.count_if(f).alias("flagged"), F.count_if(f & l).alias("tp"), F.count_if(f & ~l).alias("fp"),
        F.count_if(~f & l).alias("fn"), total(f).alias("suspicious_txns"), total(f & ~l).alias("fp_txns"))
    return counts.select(
        "flagged", "tp", "fp", "fn",
        ratio(F.col("tp"), F.col("tp") + F.col("fp"), 1.0).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn"), 1.0).alias("recall"),
        "suspicious_txns", "fp_txns")


def score_all(cards: DataFrame, names: Sequence[str], labels: DataFrame) -> DataFrame:
    """``score`` of several detectors at once, one row each.

    ``cards`` has a row per card: cc_num, its number of transactions n and a flag per
    detector; ``labels`` lists the fraud cards.
    """
    per_name = lambda f, l: F.inline(F.array(*[
        F.struct(F.lit(name).alias("detector"), f(name).alias("f"), l.alias("l")) for name in names]))
    tagged = cards.select("cc_num", "n", per_name(F.col, F.lit(False))).unionByName(
        labels.select("cc_num").distinct().select(
            "cc_num", F.lit(0).cast("bigint").alias("n"), per_name(lambda _: F.lit(False), F.lit(True))))
    each = tagged.groupBy("detector", "cc_num").agg(F.max("f").alias("f"), F.max("l").alias("l"), F.sum("n").alias("n"))
    f, l = F.col("f"), F.col("l")
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    counts = each.groupBy("detector").agg(
        F.count_if(f).alias("flagged"), F.count_if(f & l).alias("tp"), F.count_if(f & ~l).alias("fp"),
        F.count_if(~f & l).alias("fn"), total(f).alias("suspicious_txns"), total(f & ~l).alias("fp_txns"))
    return counts.select(
        "detector", "flagged", "tp", "fp", "fn",
        ratio(F.col("tp"), F.col("tp") + F.col("fp"), 1.0).alias("precision"),
        ratio(F.col("tp"), F.col("tp") + F.col("fn"), 1.0).alias("recall"),
        "suspicious_txns", "fp_txns")


def signal_gap(cards: DataFrame, names: Sequence[str], labels: DataFrame) -> DataFrame:
    """Cards on which the detectors disagree, with their label population."""
    agree = reduce(lambda a, b: a & b, [F.col(n) == F.col(names[0]) for n in names[1:]])
    return cards.filter(~agree).select("cc_num", *names).join(
        labels.select("cc_num", "label"), "cc_num", "left").withColumn("label", F.coalesce("label", F.lit("normal")))


def workload_cost(scores: DataFrame, prices: DataFrame, tokens_in: int = 12_000, tokens_out: int = 2_000) -> DataFrame:
    """Cost of analysing every flagged transaction, per detector and price row.

    Both inputs are report tables (one row per detector, one per price), so the
    product is a report as well.
    """
    per_txn = (F.lit(tokens_in / 1e6) * F.col("price_in")) + (F.lit(tokens_out / 1e6) * F.col("price_out"))
    return scores.crossJoin(prices).select(
        "detector", "provider", "model", per_txn.alias("usd_per_txn"), "suspicious_txns",
        (F.col("suspicious_txns") * per_txn).alias("usd_total"), (F.col("fp_txns") * per_txn).alias("usd_wasted"))


def cost_series(metrics: DataFrame, usd_per_txn: float, series: Sequence[str] = ("detector",)) -> DataFrame:
    """New suspicious transactions per step and the running cost."""
    w = Window.partitionBy(*series).orderBy("step")
    cum = F.col("suspicious_txns")
    return metrics.select(
        *series, "step", cum.alias("suspicious_txns"),
        (cum - F.coalesce(F.lag("suspicious_txns").over(w), F.lit(0))).alias("new_txns"),
        (cum * F.lit(usd_per_txn)).alias("cost_usd"))
