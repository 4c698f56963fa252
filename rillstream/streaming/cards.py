"""Card alerts kept current.

Two levels of state keep the work per step bounded by the longest horizon, even
for a card with a very long history: (card, day) partials are recomputed for the
days a batch can affect, and a card's alert is rolled up from its days.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import review_priority, round3
from ..params import AlertParams
from ..plans.cards import LATEST, alert_aggregates, alert_specs
from ..skew import bounded_broadcast
from .maintain import emit, islands
from .store import History, KeyedStore

HORIZON = timedelta(days=45)

LAST = ["ts", "event_id", *LATEST]
DAY_SCHEMA = T.StructType([
    T.StructField("cc_num", T.LongType()), T.StructField("day", T.DateType()),
    T.StructField("priority", T.LongType()), T.StructField("alert_amt", T.DecimalType(38, 2)),
    T.StructField("alert_ts", T.TimestampNTZType()),
    T.StructField("last", T.StructType([
        T.StructField("ts", T.TimestampNTZType()), T.StructField("event_id", T.LongType()),
        T.StructField("amt", T.DecimalType(38, 2)), T.StructField("category", T.StringType()),
        T.StructField("shipping_lat", T.DoubleType()), T.StructField("shipping_long", T.DoubleType()),
        T.StructField("distance", T.DoubleType()), T.StructField("avg_7day", T.DoubleType())])),
])
RESULT_SCHEMA = T.StructType([
    T.StructField("cc_num", T.LongType()), T.StructField("total_priority", T.LongType()),
    T.StructField("alert_amt", T.DecimalType(38, 2)), T.StructField("alert_ts", T.TimestampNTZType()),
    *DAY_SCHEMA["last"].dataType.fields[:1], *DAY_SCHEMA["last"].dataType.fields[2:],
    T.StructField("review_priority", T.DoubleType()),
])


def day_partials(rows: DataFrame, params: AlertParams) -> DataFrame:
    """Alert totals and last row per (card, day)."""
    specs = alert_specs(params)
    fired = [F.when(cond, F.lit(prio)).otherwise(F.lit(0)) for _, cond, _, prio in specs]
    score = sum(fired[1:], fired[0])
    amounts = F.greatest(*[F.when(cond, amt) for _, cond, amt, _ in specs])
    return rows.groupBy("cc_num", F.to_date("ts").alias("day")).agg(
        F.sum(score).alias("priority"), F.max(amounts).alias("alert_amt"),
        F.max(F.when(score > 0, F.col("ts"))).alias("alert_ts"),
        F.max_by(F.struct(*LAST), F.struct("ts", "event_id")).alias("last"))


def roll_up(partials: DataFrame, params: AlertParams) -> DataFrame:
    """Flagged cards from their days, in the shape of the batch query."""
    cards = partials.groupBy("cc_num").agg(
        F.sum("priority").alias("total_priority"), F.max("alert_amt").alias("alert_amt"),
        F.max("alert_ts").alias("alert_ts"),
        F.max_by("last", F.struct("last.ts", "last.event_id")).alias("b"))
    return cards.filter("total_priority > 0").select(
        "cc_num", "total_priority", "alert_amt", "alert_ts", *[F.col(f"b.{c}").alias(c) for c in ["ts", *LATEST]],
        review_priority(F.col("total_priority"), F.col("b.amt"), params.review_scale, params.review_cap)
        .alias("review_priority"),
    ).withColumns({"distance": round3("distance"), "avg_7day": F.coalesce("avg_7day", F.lit(0.0))})


class CardAlertMaintainer:
    """``fraud_alert_details`` after every batch, late rows included."""

    def __init__(self, spark, root: str, txn_schema: T.StructType, cust: DataFrame, params: AlertParams, buckets=64,
                 span: timedelta | None = timedelta(days=15)):
        self.cust, self.params = cust, params
        self.history = History(spark, f"{root}/history", txn_schema, ["cc_num"], "ts", buckets, span)
        self.days = KeyedStore(spark, f"{root}/days", DAY_SCHEMA, ["cc_num", "day"], buckets, ["cc_num"])
        self.result = KeyedStore(spark, f"{root}/result", RESULT_SCHEMA, ["cc_num"], buckets)

    def __call__(self, batch: DataFrame, epoch: int) -> DataFrame:
        self.history.write(batch.filter(F.col("ts").isNotNull()), epoch)
        fresh = self.history.only(epoch)
        horizon = F.make_dt_interval(days=F.lit(HORIZON.days))
        one_day = F.make_dt_interval(days=F.lit(1))
        start_of = lambda c: F.date_trunc("day", c).cast("timestamp_ntz")
        # stretches farther apart than this share no row and no day
        apart = 2 * HORIZON + timedelta(days=3)
        ranges = islands(fresh, ["cc_num"], "ts", apart, self.history.slot(F.col("ts"))).select(
            "cc_num", start_of("__lo").alias("__lo"), (start_of("__hi") + horizon + one_day).alias("__hi")).persist()
        cached = ranges
        pieces, n = self.history.needed(ranges, F.col("__lo") - horizon, F.col("__hi"))
        buckets = pieces if self.history.span is None else pieces.buckets
        ranges = bounded_broadcast(ranges, n)
        context = self.history.read(epoch, pieces).join(ranges, "cc_num").filter(
            (F.col("ts") >= F.col("__lo") - horizon) & (F.col("ts") < F.col("__hi")))
        home = bounded_broadcast(self.cust.join(ranges, "cc_num", "left_semi"), n)
        rows = alert_aggregates(context, home, self.params, self.history.hot_limit(epoch, pieces))
        changed = day_partials(rows.filter(F.col("ts") >= F.col("__lo")), self.params)
        self.days.write(changed.withColumn("op", F.lit("insert")), epoch)
        touched = bounded_broadcast(cached.select("cc_num").distinct(), n)
        after = roll_up(self.days.current(epoch, buckets, only=touched, on=["cc_num"]), self.params)
        before = self.result.current(epoch - 1, buckets, only=touched)
        changes = emit(self.result, before, after.select(*RESULT_SCHEMA.names), epoch)
        cached.unpersist()
        return changes
