"""Feature views for training and serving."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import age_years, date_part, days_until, flag, parse_expiry
from ..functions.dates import micros
from ..operators.relational import latest, percentiles, running_total
from ..operators.windows import Trailing, rolling
from ..params import DAY
from ..skew import HOT_ROWS

FEATURE_COLUMNS = [
    "cc_num", "d", "is_weekend", "hour_of_day", "is_night", "avg_spend_pd", "avg_spend_pw", "avg_spend_pm",
    "avg_spend_p3m_over_d", "trans_freq_24", "amt", "unix_time", "zip", "city_pop", "is_fraud",
]
# Day numbers (1 = Sunday) that count as weekend: a fixed value of the feature's definition.
WEEKEND = (6, 7)


# A transaction changes features up to 90 days later; a second more, as windows are in whole seconds.
FEATURE_REACH = timedelta(seconds=90 * DAY + 1)


def feature_view(
    txn: DataFrame, demo: DataFrame, hot_rows: int | None = HOT_ROWS, keep: Sequence[str] = (),
) -> DataFrame:
    """Per transaction: calendar flags, trailing spend averages, demographics, label; and the columns to ``keep``.

    ``avg_spend_p3m_over_d`` groups by day of month. Trailing windows run on
    integer seconds before the demographics join, which adds no rows (one per
    card) and removes cards without demographics.
    """
    at = F.col("trans_date_trans_time")
    rows = txn.join(demo.select("cc_num", "zip", "city_pop"), "cc_num").withColumn("__dom", date_part("day", at))
    rows = rolling(rows, ["cc_num"], "unix_time", {
        "avg_spend_pd": Trailing(DAY, "avg", "amt"),
        "avg_spend_pw": Trailing(7 * DAY, "avg", "amt"),
        "avg_spend_pm": Trailing(30 * DAY, "avg", "amt"),
        "trans_freq_24": Trailing(DAY),
    }, hot_rows)
    rows = rolling(rows, ["cc_num", "__dom"], "unix_time", {"__p3m": Trailing(90 * DAY, "avg", "amt")}, hot_rows)
    extra = [c for c in ("event_id",) if c in rows.columns]
    return rows.withColumns({
        "d": date_part("dayofweek", at),
        "is_weekend": flag(date_part("dayofweek", at).isin(*WEEKEND), True, False),
        "hour_of_day": date_part("hour", at),
        "is_night": flag(date_part("hour", at) <= 6, True, False),
        "avg_spend_p3m_over_d": F.coalesce("__p3m", F.lit(0.0)),
    }).select(*extra, *keep, *FEATURE_COLUMNS)


def combined(txn: DataFrame, profiles: DataFrame) -> DataFrame:
    """Transactions with the card's expiry, holder's age and days until expiry.

    Expiry and birth date come from the same profile row, so one join serves both.
    """
    holder = profiles.select(
        "cc_num", parse_expiry("cc_expiration_date").alias("cc_expiration_date"), "birthdate")
    return txn.join(holder, "cc_num").select(
        *[F.col(c).cast("double").alias(c) if c == "amount" else F.col(c) for c in txn.columns],
        "cc_expiration_date",
        age_years("birthdate", "date_time").alias("age_at_transaction"),
        days_until("date_time", "cc_expiration_date").alias("days_until_card_expires"),
    )


def windowed(
    txn: DataFrame, size: str = "4 hours", slide: str = "1 hour", value: str = "amount", keep_window: bool = False,
    ts: str = "date_time", key: str = "cc_num",
) -> DataFrame:
    """Hopping-window spend statistics, one row per event and covering window.

    Events are folded once into panes, the tumbling stretches of one slide. A pane's covering windows are sums of
    neighbouring panes, so they come from range frames over the panes of a key (a row per pane, even for a hot key), and
    events are joined to their pane once. Nothing is multiplied before a shuffle: the row per window appears last.
    Deviations are merged from those of the panes about the common mean, which does not cancel.
    ``size`` must be a multiple of ``slide``. Events without a time or a key have no window.
    """
    step, reach = (pd.Timedelta(x).value // 1000 for x in (slide, size))
    if reach % step:
        raise ValueError("the window size must be a multiple of the slide")
    n_panes = reach // step
    rows = txn.filter(F.col(key).isNotNull()).withColumn("__w", F.window(ts, slide)).select(
        key, ts, F.col(value).alias("__value"), F.col("__w.start").alias("__pane"))
    n, x = F.count("__value"), F.col("__value").cast("double")
    panes = rows.groupBy(key, "__pane").agg(
        F.count(key).alias("__trans"), n.alias("__n"), F.sum("__value").alias("__sum"),
        F.coalesce(F.var_pop(x) * n, F.lit(0.0)).alias("__m2"))
    order = Window.partitionBy(key).orderBy(micros("__pane"))
    sums, stats = {}, []
    for back in range(n_panes):  # the window that starts ``back`` panes before this one
        frame = order.rangeBetween(-back * step, (n_panes - 1 - back) * step)
        for c in ("__trans", "__n", "__sum"):
            sums[f"{c}{back}"] = F.sum(c).over(frame)
        sums[f"__parts{back}"] = F.collect_list(F.struct("__n", "__sum", "__m2")).over(frame)  # n_panes at most
        stats.append(F.struct(
            (F.col("__pane") - F.make_dt_interval(secs=F.lit(back * step / 1e6))).alias("window_start"),
            _mean(F.col(f"__sum{back}"), F.col(f"__n{back}")).alias("avg_amt"), F.col(f"__trans{back}").alias("trans"),
            _deviation(F.col(f"__parts{back}"), F.col(f"__sum{back}"), F.col(f"__n{back}")).alias("stddev_amt")))
    windows = panes.withColumns(sums).select(key, "__pane", F.array(*stats).alias("__windows"))
    kept = ["window_start"] if keep_window else []
    joined = rows.select(key, ts, "__pane").join(windows, [key, "__pane"])
    return joined.select(key, ts, F.explode("__windows").alias("__w")).select(
        "__w.avg_amt", "__w.trans", "__w.stddev_amt", ts, key, *[f"__w.{c}" for c in kept])


def _mean(total: Column, n: Column) -> Column:
    return F.when(n > 0, total.cast("double") / n)


def _deviation(parts: Column, total: Column, n: Column) -> Column:
    """Sample deviation of merged groups (n, sum, squares about their own mean); 0 for fewer than two values."""
    mean = _mean(total, n)
    squares = F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + p["__m2"] + F.when(
        p["__n"] > 0, p["__n"] * F.pow(p["__sum"].cast("double") / p["__n"] - mean, F.lit(2.0))).otherwise(F.lit(0.0)))
    return F.when(n > 1, F.sqrt(squares / (n - 1))).otherwise(F.lit(0.0))


def encode_category(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Integer code of each category in alphabetical order, starting at 0.

    Only the distinct categories are ranked, range by range; the code is joined back,
    broadcast when the list is under Spark's size threshold. NULL has no code.
    """
    ranked = running_total(df.select(col).filter(F.col(col).isNotNull()).distinct(), [col], F.lit(1), "__code")
    codes = ranked.withColumn("__code", (F.col("__code") - 1).cast("int"))
    return df.join(codes, col, "left").withColumnRenamed("__code", out or f"{col}_code")


def split(df: DataFrame, key: str, test: float = 0.2, by: str = "hash", seed: int = 45, ts: str | None = None):
    """(train, test): a seeded random split by key hash, or the latest share by time.

    The time split cuts at the exact interpolated percentile of the event time,
    found through a histogram of whole seconds.
    """
    if by == "hash":
        part = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1000))
        is_test = part < F.lit(int(test * 1000))
    elif by == "time":
        secs = F.unix_timestamp(F.col(ts))
        cut = percentiles(df.select(secs.alias("s")), "s", [100 * (1 - test)]).first()[0]  # one number
        is_test = secs > F.lit(cut)
    else:
        raise ValueError("by must be 'hash' or 'time'")
    return df.filter(~is_test), df.filter(is_test)


def latest_features(features: DataFrame, keys: DataFrame, key: str, order, cols) -> DataFrame:
    """The newest feature vector of each requested key."""
    wanted = features.join(keys.select(key).distinct(), key, "left_semi")
    return latest(wanted, [key], order, cols)


def feature_table(df: DataFrame, path: str | None = None) -> DataFrame:
    """DECIMAL columns as DOUBLE, ready for ML; written as a table when a path is given."""
    out = df.select(*[
        F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])
    if path is None:
        return out
    out.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)

