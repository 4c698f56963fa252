"""Keeping query results current, one micro-batch at a time.

Every maintainer follows the same steps inside ``foreachBatch``:

1. store the batch under its epoch (idempotent);
2. find the affected keys and time ranges of the batch;
3. read only those from the history;
4. run the *same* batch function as a full run would;
5. diff against the stored results and upsert the difference.

The result after any sequence of batches therefore equals one batch run over the
same rows, late rows included, and each step's work follows the batch rather than
the history: tables with a ``span`` are read only in the slots of time within reach
of the batch, a late row opening those around itself and not all since then.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..operators.changes import view_diff
from ..operators.windows import Trailing, lag_cols, rolling
from ..skew import bounded_broadcast
from .store import History, KeyedStore


def islands(rows: DataFrame, keys: Sequence[str], ts: str, gap: timedelta, slot) -> DataFrame:
    """(keys, __lo, __hi): per key the stretches of time with rows, parted where more than ``gap`` is empty.

    Rows without a time have a stretch of their own, with NULL ends. Rows are folded per key and slot first, so the
    window sees a row per slot only, even of a hot key.
    """
    parts = rows.groupBy(*keys, slot.alias("__slot")).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
    w = Window.partitionBy(*keys).orderBy("__lo")
    before = F.lag("__hi").over(w)
    starts = F.when(before.isNull() | (_shift("__lo", gap, -1) > before), 1).otherwise(0)
    numbered = parts.withColumn("__starts", starts).withColumn("__island", F.sum("__starts").over(w))
    return numbered.groupBy(*keys, "__island").agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi")).drop("__island")


def _shift(col: str, span: timedelta, sign: int):
    return F.col(col) + F.make_dt_interval(secs=F.lit(sign * span.total_seconds()))


def emit(store: KeyedStore, before: DataFrame, after: DataFrame, epoch: int) -> DataFrame:
    """Upsert the difference and return it."""
    store.write(view_diff(before, after, store.keys), epoch)
    return store.changes(epoch)


class RollingMaintainer:
    """Trailing windows kept current. ``result_key`` identifies one output row."""

    def __init__(
        self, history: History, store: KeyedStore, keys: Sequence[str], order: str, specs: dict[str, Trailing],
        prepare: Callable[[DataFrame], DataFrame] | None = None,
    ):
        self.history, self.store, self.keys, self.order, self.specs = history, store, list(keys), order, specs
        self.prepare = prepare or (lambda df: df)
        self.horizon = max(s.horizon for s in specs.values())

    def __call__(self, batch: DataFrame, epoch: int) -> DataFrame:
        self.history.write(batch, epoch)
        touched = self.history.only(epoch)
        slot = self.history.slot(F.col(self.order))
        ranges = islands(touched, self.keys, self.order, 2 * self.horizon, slot).persist()
        reach_lo, reach_hi = _shift("__lo", self.horizon, -1), _shift("__hi", self.horizon, 1)
        pieces, n = self.history.needed(ranges, reach_lo, reach_hi)
        small = bounded_broadcast(ranges, n)
        context = self.history.read(epoch, pieces).join(small, self.keys).filter(self._in(reach_lo, reach_hi))
        hot = self.history.hot_limit(epoch, pieces)
        full = self.build(context, hot)
        # rows up to one horizon after a late row change too
        after = full.filter(self._in(F.col("__lo"), reach_hi)).drop("__lo", "__hi")
        before = self._stored(small, pieces if self.store.shares_buckets(self.history) else None, epoch)
        changes = emit(self.store, before, after.select(*self.store.schema.names), epoch)
        ranges.unpersist()
        return changes

    def build(self, context: DataFrame, hot: int | None) -> DataFrame:
        return rolling(self.prepare(context), self.keys, self.order, self.specs, hot)

    def _stored(self, small: DataFrame, pieces, epoch: int) -> DataFrame:
        """Stored results in the affected ranges."""
        rows = self.store.current(epoch - 1, pieces, only=small, on=self.keys)
        return rows.join(small, self.keys).filter(
            self._in(F.col("__lo"), _shift("__hi", self.horizon, 1))).drop("__lo", "__hi")

    def _in(self, lo, hi):
        """Rows in a range of time; those without a time are one another's peers and always belong together."""
        return F.col(self.order).between(lo, hi) | (F.col(self.order).isNull() & F.col("__lo").isNull())


class LagMaintainer:
    """Previous-row values kept current: a late row also corrects its successor.

    The neighbours of a batch's rows may lie any time away. Where the history has slots, a small table of the (key,
    slot) pairs that hold rows tells which slots those neighbours are in, and only these are opened. Rows without a
    time take no part.
    """

    def __init__(self, history: History, store: KeyedStore, keys, order: str, cols: dict[str, str], tie: str):
        self.history, self.store, self.keys, self.order = history, store, list(keys), order
        self.cols, self.tie = cols, tie
        self.index = None
        if history.span:
            fields = [*[history.schema[k] for k in history.keys], T.StructField("slot_no", T.LongType())]
            self.index = History(
                history.spark, f"{history.path}-slots", T.StructType(fields), history.keys, "slot_no", history.buckets)

    def __call__(self, batch: DataFrame, epoch: int) -> DataFrame:
        self.history.write(batch, epoch)
        ts, slot = F.col(self.order), self.history.slot
        touched = self.history.only(epoch).filter(ts.isNotNull())
        if self.index:
            self.index.write(touched.select(*self.keys, slot(ts).alias("slot_no")).distinct(), epoch)
        gap = self.history.span or timedelta(0)
        ranges = islands(touched, self.keys, self.order, gap, slot(ts)).persist()
        pieces, n = self._pieces(ranges, epoch)
        rows = self.history.read(epoch, pieces)
        # Where the neighbours of each stretch lie.
        near = rows.join(bounded_broadcast(ranges, n), self.keys).groupBy(*self.keys, "__lo", "__hi").agg(
            F.coalesce(F.max(F.when(ts < F.col("__lo"), ts)), F.col("__lo")).alias("__from"),
            F.coalesce(F.min(F.when(ts > F.col("__hi"), ts)), F.col("__hi")).alias("__to"))
        cached = near.persist()
        near = bounded_broadcast(cached, n)
        context = self._within(rows, near, "__from")
        full = lag_cols(context, self.keys, self.order, self.cols, self.tie, self.history.hot_limit(epoch, pieces))
        pruned = pieces if self.store.shares_buckets(self.history) else None
        stored = self.store.current(epoch - 1, pruned, only=near, on=self.keys)
        changes = emit(
            self.store, self._within(stored, near, "__lo"),
            self._within(full, near, "__lo").select(*self.store.schema.names), epoch)
        ranges.unpersist()
        cached.unpersist()
        return changes

    def _pieces(self, ranges: DataFrame, epoch: int):
        lo, hi = F.col("__lo"), F.col("__hi")
        if self.index is None:
            return self.history.needed(ranges, lo, hi)
        own, n = self.history.needed(ranges, lo, hi)
        held, slot = self.index.read(epoch, own.buckets), F.col("slot_no")
        known = held.join(bounded_broadcast(ranges, n), self.keys).groupBy(*self.keys, "__lo", "__hi").agg(
            F.max(F.when(slot < self.history.slot(lo), slot)).alias("__before"),
            F.min(F.when(slot > self.history.slot(hi), slot)).alias("__after"))
        return self.history.needed(known, lo, hi, F.col("__before"), F.col("__after"))

    def _within(self, rows: DataFrame, near: DataFrame, start: str) -> DataFrame:
        """Rows from ``start`` to the successor of any stretch of their key, each once."""
        named = near.select(*[F.col(k).alias(f"__near_{k}") for k in self.keys], F.col(start).alias("__a"), F.col("__to").alias("__b"))
        same = [F.col(k) == F.col(f"__near_{k}") for k in self.keys]
        return rows.join(named, reduce(lambda x, y: x & y, same) & F.col(self.order).between(F.col("__a"), F.col("__b")), "left_semi")


class KeyMaintainer:
    """A per-key result kept current by recomputing the keys a batch touches.

    ``compute`` maps the full history rows of the touched keys to result rows and
    is the batch definition of the view (score, flags, totals, ...).
    """

    def __init__(self, history: History, store: KeyedStore, compute: Callable[[DataFrame], DataFrame]):
        self.history, self.store, self.compute = history, store, compute

    def __call__(self, batch: DataFrame, epoch: int) -> DataFrame:
        self.history.write(batch, epoch)
        touched = self.history.only(epoch).select(*self.history.keys).distinct()
        buckets, n = self.history.profile(touched)
        small = bounded_broadcast(touched, n)
        rows = self.history.read(epoch, buckets).join(small, self.history.keys, "left_semi")
        pruned = buckets if self.store.shares_buckets(self.history) else None
        before = self.store.current(epoch - 1, pruned, only=small, on=self.history.keys)
        return emit(self.store, before, self.compute(rows).select(*self.store.schema.names), epoch)


class PartialMaintainer:
    """Insert-triggered partial counts: each epoch appends its own, readers sum them."""

    def __init__(self, parts: History, compute: Callable[[DataFrame], DataFrame]):
        self.parts, self.compute = parts, compute

    def __call__(self, batch: DataFrame, epoch: int) -> None:
        self.parts.write(self.compute(batch), epoch)

    def merged(self, keys: Sequence[str], value: str = "n") -> DataFrame:
        return self.parts.read().groupBy(*keys).agg(F.sum(value).alias(value))


class JoinMaintainer:
    """A join view that follows changes of either side.

    Both sides are upsert tables. Join keys touched by either changelog, in their
    old or new rows, are recomputed; the view's difference is emitted, so rows
    that lose their partner are deleted. A side placed by the join key is read
    only in the buckets of the touched keys.
    """

    def __init__(
        self, left: KeyedStore, right: KeyedStore, view: KeyedStore, on: str,
        compute: Callable[[DataFrame, DataFrame], DataFrame],
    ):
        self.left, self.right, self.view, self.on, self.compute = left, right, view, on, compute

    def __call__(self, left_changes: DataFrame, right_changes: DataFrame, epoch: int) -> DataFrame:
        self.left.write(left_changes, epoch)
        self.right.write(right_changes, epoch)
        touched = self._touched(self.left, epoch).unionByName(self._touched(self.right, epoch)).distinct()
        touched = touched.persist()
        small = bounded_broadcast(touched, touched.count())
        pruned = {id(s): s.buckets_of(touched) if s.bucket_by == [self.on] else None for s in (self.left, self.right)}
        side = lambda store, upto: store.current(upto, pruned[id(store)]).join(small, self.on, "left_semi")
        before = self.compute(side(self.left, epoch - 1), side(self.right, epoch - 1))
        after = self.compute(side(self.left, epoch), side(self.right, epoch))
        names = self.view.schema.names
        changes = emit(self.view, before.select(*names), after.select(*names), epoch)
        touched.unpersist()
        return changes

    def _touched(self, store: KeyedStore, epoch: int) -> DataFrame:
        changed = store.changes(epoch)
        new = changed.filter(F.col("op") != "delete").select(self.on)
        old = store.current(epoch - 1, store.buckets_of(changed), only=changed, on=store.keys).select(self.on)
        return new.unionByName(old)


def new_only(alerts: DataFrame, seen: KeyedStore, epoch: int) -> DataFrame:
    """Alert keys not reported in an earlier epoch; they are remembered for later ones."""
    keys = alerts.select(*seen.keys).distinct()
    buckets = seen.buckets_of(keys)
    known = seen.current(epoch - 1, buckets).select(*seen.keys)
    fresh = keys.join(known, seen.keys, "left_anti").withColumn("op", F.lit("insert"))
    seen.write(fresh, epoch)
    return seen.changes(epoch).drop("op")


def step_metrics(flagged: DataFrame, counts: DataFrame, step: int, detector: str = "exact") -> DataFrame:
    """One row: flagged cards and transactions of flagged cards so far."""
    mine = counts.join(flagged.select("cc_num").distinct(), "cc_num", "left_semi")
    return mine.agg(
        F.lit(detector).alias("detector"), F.lit(step).alias("step"), F.count(F.lit(1)).alias("flagged_cards"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("suspicious_txns"))


def batch_stream_diff(batch_result: DataFrame, stream_result: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows on which a batch run and a micro-batched run disagree; must be empty."""
    return view_diff(batch_result, stream_result.select(*batch_result.columns), key)
