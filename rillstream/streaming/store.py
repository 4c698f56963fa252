"""Tables that micro-batches write to: plain partitioned Parquet.

Every epoch writes its own ``epoch=<n>`` directories and a retried epoch
overwrites exactly those, so replays change nothing and a lost executor costs
only its tasks. Rows are placed in a fixed number of key buckets (``kb``), which
lets a small batch read only the buckets its keys fall into. A table with a
``span`` is also cut into slots of time (``slot``), so a step opens only files
within reach of its batch, however long the history is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..skew import HOT_ROWS

EPOCH, BUCKET, SLOT, OP = "epoch", "kb", "slot", "op"
# Terms of a partition filter; beyond that the buckets share the slots of all of them.
MAX_TERMS = 200


@dataclass(frozen=True)
class Pieces:
    """The parts of a table that a step needs: buckets and, for each, runs of slots
    (first, last); ``None`` in place of a run stands for rows without a time."""

    span: timedelta
    runs: dict[int, tuple[tuple[int, int] | None, ...]]

    @classmethod
    def of(cls, span: timedelta, wanted: Sequence[tuple[int, int | None]]) -> "Pieces":
        by_bucket: dict[int, list] = {}
        for bucket, slot in wanted:
            by_bucket.setdefault(bucket, []).append(slot)
        return cls(span, {b: _runs(slots) for b, slots in by_bucket.items()})

    @property
    def buckets(self) -> list[int]:
        return sorted(self.runs)

    def condition(self) -> Column:
        alike: dict[tuple, list[int]] = {}
        for bucket, runs in self.runs.items():
            alike.setdefault(runs, []).append(bucket)
        if sum(len(runs) for runs in alike) > MAX_TERMS:
            slots = [x for runs in alike for r in runs for x in ([None] if r is None else range(r[0], r[1] + 1))]
            alike = {_runs(slots): self.buckets}
        slot = F.col(SLOT)
        terms = [
            F.col(BUCKET).isin(buckets) & reduce(
                lambda x, y: x | y, [slot.isNull() if r is None else slot.between(*r) for r in runs])
            for runs, buckets in alike.items()]
        return reduce(lambda x, y: x | y, terms, F.lit(False))


def _runs(slots) -> tuple:
    """Neighbouring numbers joined to runs."""
    out: list = [None] if None in slots else []
    for x in sorted({x for x in slots if x is not None}):
        if out and out[-1] is not None and out[-1][1] == x - 1:
            out[-1] = (out[-1][0], x)
        else:
            out.append((x, x))
    return tuple(out)


class _EpochTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int,
                 bucket_by: Sequence[str] | None = None, time: str | None = None, span: timedelta | None = None):
        self.spark, self.path, self.keys, self.buckets = spark, path, list(keys), buckets
        self.bucket_by = list(bucket_by or keys)
        self.time, self.span = time, span
        self.schema = schema
        self._places = [*([T.StructField(SLOT, T.LongType())] if span else []), T.StructField(BUCKET, T.IntegerType())]
        self._full = T.StructType([*schema.fields, T.StructField(EPOCH, T.LongType()), *self._places])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.bucket_by]), F.lit(self.buckets)).cast("int")

    def slot(self, at: Column) -> Column:
        """The slot of a time; one for all without a span, NULL without a time."""
        if self.span is None:
            return F.when(at.isNotNull(), F.lit(0)).cast("bigint")
        return F.floor(F.unix_timestamp(at) / F.lit(int(self.span.total_seconds()))).cast("bigint")

    def needed(self, ranges: DataFrame, lo: Column, hi: Column, *more: Column) -> tuple["Pieces | list[int]", int]:
        """What to read for ranges of time of the given keys, and how many ranges there are, in one job.

        ``more`` are further slots, NULL for none. At most a number per bucket and slot reaches the driver.
        """
        at = F.explode_outer(F.when(lo.isNull(), F.array(F.lit(None).cast("bigint"))).otherwise(
            F.array_union(F.sequence(self.slot(lo), self.slot(hi)), F.array_compact(F.array(self.slot(lo), *more)))))
        own = ranges.select(self.bucket().alias(BUCKET), self.slot(lo).alias("__own"), at.alias(SLOT))
        found = own.groupBy(BUCKET, SLOT).agg(
            F.count_if(F.col(SLOT).eqNullSafe(F.col("__own"))).alias("n")).collect()
        n = sum(r["n"] for r in found)
        wanted = [(r[BUCKET], r[SLOT]) for r in found]
        return (sorted({b for b, _ in wanted}) if self.span is None else Pieces.of(self.span, wanted)), n

    def shares_buckets(self, other: "_EpochTable") -> bool:
        """True when a key's rows are in equally numbered buckets of both tables."""
        return self.buckets == other.buckets and self.bucket_by == other.bucket_by

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """Buckets the given keys fall into: at most ``self.buckets`` numbers."""
        return sorted(r[0] for r in keys.select(self.bucket().alias(BUCKET)).distinct().collect())

    def profile(self, keys: DataFrame) -> tuple[list[int], int]:
        """Buckets and number of the given distinct keys, in one job."""
        found = keys.groupBy(self.bucket().alias(BUCKET)).agg(F.count(F.lit(1)).alias("n")).collect()
        return sorted(r[BUCKET] for r in found), sum(r["n"] for r in found)

    def _place(self, rows: DataFrame, epoch: int, order: Sequence[str]) -> None:
        """Replace the epoch's directory: clustered by bucket, sorted inside for row-group pruning.

        AQE may split a bucket that got too large (a hot key): a bucket is a
        directory, not a single file.
        """
        names = list(self._placed())
        (
            rows.withColumns(self._placed())
            .hint("rebalance", *names).sortWithinPartitions(*names, *order)
            .write.mode("overwrite").option("partitionOverwriteMode", "static")
            .partitionBy(*names).parquet(f"{self.path}/{EPOCH}={epoch}")
        )

    def _placed(self) -> dict[str, Column]:
        return {**({SLOT: self.slot(F.col(self.time))} if self.span else {}), BUCKET: self.bucket()}

    def _typed(self, rows: DataFrame) -> list[Column]:
        return [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema
        ]

    def _read(self, upto: int | None, buckets: "Sequence[int] | Pieces | None", epoch: int | None = None) -> DataFrame:
        """Rows up to an epoch, or of one epoch, whose directory alone is listed then."""
        try:
            reader = self.spark.read.schema(self._full).option("basePath", self.path)
            rows = reader.parquet(self.path if epoch is None else f"{self.path}/{EPOCH}={epoch}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = self.spark.createDataFrame([], self._full)  # nothing written yet
        if upto is not None:
            rows = rows.filter(F.col(EPOCH) <= upto)
        if isinstance(buckets, Pieces):
            rows = rows.filter(
                buckets.condition() if buckets.span == self.span else F.col(BUCKET).isin(buckets.buckets))
        elif buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(list(buckets)))
        return rows.drop(SLOT) if self.span else rows


class History(_EpochTable):
    """Append-only rows keyed for lookup by (keys, ts)."""

    def __init__(self, spark, path, schema, keys, ts: str, buckets: int = 64, span: timedelta | None = None):
        super().__init__(spark, path, schema, keys, buckets, time=ts, span=span)
        self.ts = ts

    def write(self, rows: DataFrame, epoch: int) -> None:
        self._place(rows.select(*self._typed(rows)), epoch, [*self.keys, self.ts])

    def read(self, upto: int | None = None, buckets: Sequence[int] | Pieces | None = None) -> DataFrame:
        return self._read(upto, buckets).drop(EPOCH, BUCKET)

    def hot_limit(self, upto: int, buckets: Sequence[int] | Pieces) -> int | None:
        """None when the buckets hold too few rows for any key to be hot.

        A count of whole files comes from their footers.
        """
        return HOT_ROWS if self.read(upto, buckets).count() > HOT_ROWS else None

    def only(self, epoch: int) -> DataFrame:
        """The rows one epoch brought."""
        return self._read(None, None, epoch).drop(EPOCH, BUCKET)

    def compact(self, path: str, upto: int, keep_from: Column | None = None) -> "History":
        """A new table with all epochs up to ``upto`` merged, without rows before ``keep_from``."""
        merged = History(self.spark, path, self.schema, self.keys, self.ts, self.buckets, self.span)
        rows = self.read(upto)
        merged.write(rows if keep_from is None else rows.filter(F.col(self.ts) >= keep_from), upto)
        return merged


class KeyedStore(_EpochTable):
    """Upserts by key. Each epoch appends its changes; the current row of a key is
    the one from its latest epoch, deletes leaving none."""

    def __init__(self, spark, path, schema: T.StructType, keys, buckets: int = 64, bucket_by=None,
                 time: str | None = None, span: timedelta | None = None):
        if span and time not in keys:
            raise ValueError("the time of a slotted table must be one of its keys")
        super().__init__(spark, path, schema, keys, buckets, bucket_by, time, span)
        self._with_op()

    def _with_op(self) -> None:
        self._full = T.StructType([
            *self.schema.fields, T.StructField(OP, T.StringType()), T.StructField(EPOCH, T.LongType()), *self._places])

    def write(self, changes: DataFrame, epoch: int) -> None:
        """``changes``: op (insert/update/delete) and columns, one change per key.

        Columns the table does not have yet are added (NULL for older rows).
        """
        known = set(self.schema.names)
        fresh = [f for f in changes.schema if f.name not in known and f.name != OP]
        if fresh:
            self.schema = T.StructType([*self.schema.fields, *fresh])
            self._with_op()
        typed = changes.select(*self._typed(changes), F.col(OP).cast("string").alias(OP))
        self._place(typed, epoch, self.keys)

    def changes(self, epoch: int) -> DataFrame:
        """What one epoch changed."""
        return self._read(None, None, epoch).drop(EPOCH, BUCKET)

    def current(
        self, upto: int | None = None, buckets: Sequence[int] | Pieces | None = None, only: DataFrame | None = None,
        on: Sequence[str] | None = None,
    ) -> DataFrame:
        """Current rows; ``only`` restricts them to given values of the columns ``on``,
        which must be a subset of the keys."""
        rows = self._read(upto, buckets).drop(BUCKET)
        if only is not None:
            rows = rows.join(only, list(on or self.keys), "left_semi")
        rest = [c for c in rows.columns if c not in [*self.keys, EPOCH]]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest), F.col(EPOCH)).alias("__r"))
        return last.select(*self.keys, "__r.*").filter(F.col(OP) != "delete").select(*self.schema.names)

    def compact(self, path: str, upto: int) -> "KeyedStore":
        merged = KeyedStore(
            self.spark, path, self.schema, self.keys, self.buckets, self.bucket_by, self.time, self.span)
        merged.write(self.current(upto).withColumn(OP, F.lit("insert")), upto)
        return merged


class EpochLog:
    """Which epochs of a group of tables are complete.

    The mark is written after all tables of the epoch, and readers ask for the
    tables ``upto`` the last mark, so they see all of an epoch or nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def mark(self, epoch: int) -> None:
        self.spark.range(epoch, epoch + 1).toDF("committed").write.mode("overwrite").parquet(
            f"{self.path}/{EPOCH}={epoch}")

    def last(self) -> int:
        schema = T.StructType([T.StructField("committed", T.LongType())])
        try:
            marks = self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1
        top = marks.agg(F.max("committed")).first()[0]
        return -1 if top is None else top
