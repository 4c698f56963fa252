"""Projection, join, aggregation, ordering and set operators.

Join strategies are left to Catalyst and AQE: sides under
``spark.sql.autoBroadcastJoinThreshold`` are broadcast, larger ones are
shuffled, and AQE splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ..functions import epoch_bucket
from ..session import cut
from ..skew import bounded_broadcast


# -- projection and filters ---------------------------------------------------

def with_columns(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    return df.select("*", *[e.alias(n) for n, e in exprs.items()])


def where_all(df: DataFrame, conds: Sequence[Column]) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, conds))


def having(df: DataFrame, keys: Sequence[str], agg: Column, cond: Column) -> DataFrame:
    return df.groupBy(*keys).agg(agg).filter(cond)


def members(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys_df, list(on), "left_semi")


# -- joins --------------------------------------------------------------------

def enrich(fact: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    return fact.join(dim, list(on), how)


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    return reduce(lambda acc, d: acc.join(d[0], list(d[1]), "inner"), dims, fact)


def join_using(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    return a.join(b, list(cols))


def semi(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys, list(on), "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys, list(on), "left_anti")


def join_where(a: DataFrame, b: DataFrame, on: Sequence[str], residual: Column) -> DataFrame:
    """Equi-join of the aliased sides ``a`` and ``b`` with a further predicate."""
    equal = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in on]
    return a.alias("a").join(b.alias("b"), reduce(lambda x, y: x & y, [*equal, residual]))


def unnest(df: DataFrame, array_col: str, alias: str) -> DataFrame:
    return df.select("*", F.explode(array_col).alias(alias)).drop(array_col)


def adjacent_buckets(counts: DataFrame, key: str, bucket: str, n: str = "n") -> DataFrame:
    """Sum of each bucket and the one directly before it (absent counts as 0).

    A lag with a gap test replaces the self join: one pass over bucket counts,
    which are already aggregated to one row per key and bucket.
    """
    w = Window.partitionBy(key).orderBy(bucket)
    previous = F.when(F.lag(bucket).over(w) == F.col(bucket) - 1, F.lag(n).over(w))
    return counts.select(key, bucket, (F.col(n) + F.coalesce(previous, F.lit(0))).alias("n2"))


def feature_join(
    a: DataFrame, b: DataFrame, key: str, mode: str = "equi", ts: str | None = None,
    features: Sequence[str] = (),
) -> DataFrame:
    """Join two feature groups.

    ``equi``: on the shared key (and event time when given).
    ``asof``: for every row of ``a`` the latest ``b`` row at or before it, from
    one union sorted by (key, ts). Keys with very many rows go through the
    time-sliced variant, see ``asof_latest``.
    """
    if mode == "equi":
        on = [key] if ts is None else [key, ts]
        return a.join(b.select(*on, *features), on)
    return asof_latest(a, b, key, ts, features)


def asof_latest(a: DataFrame, b: DataFrame, key: str, ts: str, features: Sequence[str]) -> DataFrame:
    """Latest feature values at or before each row, sliced so no key is one task.

    Rows of both sides share (key, calendar day) slices. The last feature row of
    the earlier days is carried in from a pre-aggregated (key, day) table. A row with
    NULL key or time stays, with NULL features.
    """
    b = b.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    payload = F.struct(*features)
    day = F.to_date(F.col(ts))
    left = a.select(
        key, ts, day.alias("__day"), F.lit(1).alias("__side"), F.struct(*a.columns).alias("__row"))
    left = left.withColumn("__feat", F.lit(None).cast(b.select(payload.alias("f")).schema["f"].dataType))
    right = b.select(
        key, ts, day.alias("__day"), F.lit(0).alias("__side"),
        F.lit(None).cast(left.schema["__row"].dataType).alias("__row"), payload.alias("__feat"))
    both = left.unionByName(right)
    per_day = both.groupBy(key, "__day").agg(
        F.max_by(F.col("__feat"), F.when(F.col("__side") == 0, F.struct(ts, "__feat"))).alias("__last"))
    earlier = Window.partitionBy(key).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_day.select(
        F.col(key).alias("__ckey"), F.col("__day").alias("__cday"), F.last("__last", ignorenulls=True).over(earlier).alias("__carry"))
    w = Window.partitionBy(key, "__day").orderBy(ts, "__side", "__feat").rowsBetween(
        Window.unboundedPreceding, 0)
    seen = (
        both.join(carry, F.col(key).eqNullSafe(F.col("__ckey")) & F.col("__day").eqNullSafe(F.col("__cday")))
        .withColumn("__now", F.coalesce(F.last("__feat", ignorenulls=True).over(w), F.col("__carry")))
        .filter(F.col("__side") == 1)
    )
    return seen.select("__row.*", *[F.col(f"__now.{f}").alias(f) for f in features])


# -- aggregations -------------------------------------------------------------

def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_max(df: DataFrame, keys, sums: dict[str, str], maxes: dict[str, str]) -> DataFrame:
    aggs = [F.sum(c).alias(n) for n, c in sums.items()] + [F.max(c).alias(n) for n, c in maxes.items()]
    return df.groupBy(*keys).agg(*aggs)


def sum_if(df: DataFrame, keys, specs: dict[str, tuple[Column, Column]]) -> DataFrame:
    return df.groupBy(*keys).agg(
        *[F.sum(F.when(cond, val).otherwise(F.lit(0))).alias(n) for n, (cond, val) in specs.items()])


def moments(df: DataFrame, keys, col: str) -> DataFrame:
    """Average, sample deviation (0 for a single row) and non-null count."""
    value = F.col(col).cast("double")
    return df.groupBy(*keys).agg(
        (F.sum(col).cast("double") / F.count(col)).alias("avg"),
        F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("stddev"),
        F.count(col).alias("n"),
    )


def collect_sorted(df: DataFrame, keys, col: str, alias: str = "items") -> DataFrame:
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(col)).alias(alias))


def distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def count_distinct(df: DataFrame, keys, cols: Sequence[str], name: str = "n") -> DataFrame:
    """Exact distinct count in two hash aggregations: dedup first, then count.

    The first shuffle is on (keys, cols), so a hot key spreads over all tasks.
    """
    return df.select(*keys, *cols).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sketch(df: DataFrame, keys, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.xxhash64(*cols)).alias("sketch"))


def estimate(sketches: DataFrame, keys) -> DataFrame:
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def partials(df: DataFrame, keys: Sequence[str | Column], ts: str, seconds: int) -> DataFrame:
    """Mergeable per-bucket counts of one or more blocks of rows."""
    return df.groupBy(*keys, epoch_bucket(ts, seconds).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"))


def merge_partials(parts: DataFrame, key: str) -> DataFrame:
    return parts.groupBy(key, "bucket").agg(F.sum("n").alias("n"))


def latest(df: DataFrame, keys, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Values of the last row per key; combined map-side, so no per-key sort."""
    best = F.max_by(F.struct(*cols), F.struct(*order)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*")


def first_per_key(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    """One whole row per key by an arbitrary order. Spark turns rank <= 1 into a
    window group limit, which keeps one row per key on the map side."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def min_snapshot(df: DataFrame, keys, ts: str, cols: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(ts).alias(ts), *[F.min(c).alias(c) for c in cols])


def running_total(df: DataFrame, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add the running total of ``value`` over the whole table in the given order.

    Rows are range-partitioned, each range adds up its own rows and starts from the totals
    of the ranges before it, so no task sees more than one range.
    """
    placed = cut(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    sums = placed.groupBy("__range").agg(F.sum(value).alias("__sum"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sums.select("__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return placed.withColumn("__run", F.sum(value).over(inside)).join(starts, "__range").select(
        *df.columns, (F.col("__start") + F.col("__run")).alias(name))


def percentiles(df: DataFrame, col: str, ps: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated percentiles, of the whole table or per key, NULL being a key of its own.

    Equal values are counted first. One running total over all (keys, value) ranges then places each value among those
    of its key, so the values of a hot key spread over ranges; what meets per key afterwards is one partial row per task. Keys without any value have no row.
    """
    hist = df.filter(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("__n"))
    run = running_total(hist, [*keys, col], F.col("__n"), "__upto")
    first = F.col("__upto") - F.col("__n")
    spans = run.groupBy(*[F.col(k).alias(f"__of_{k}") for k in keys]).agg(
        F.min(first).alias("__start"), F.max("__upto").alias("__end"))
    if keys:
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
        placed = run.join(bounded_broadcast(spans, spans.count()), same)
    else:
        placed = run.crossJoin(F.broadcast(spans))  # one row
    holds = lambda k: (F.col("__upto") - F.col("__start") > k) & (first - F.col("__start") <= k)
    value, last = F.col(col).cast("double"), F.col("__end") - F.col("__start") - 1
    aggs = []
    for p in ps:
        rank = F.lit(p / 100.0) * last
        low = F.floor(rank)
        below = F.sum(F.when(holds(low), (low + 1 - rank) * value))
        above = F.sum(F.when(holds(F.least(low + 1, last)), (rank - low) * value))
        aggs.append((below + above).alias(f"p{p:g}".replace(".", "_")))
    return placed.groupBy(*keys).agg(*aggs, F.max(col).alias("max"))


def total(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


# -- order, top-k, sets -------------------------------------------------------

def ordered(df: DataFrame, cols: Sequence[Column | str]) -> DataFrame:
    return df.orderBy(*cols)


def top_k(df: DataFrame, metric: str, k: int, tie: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc(metric), *tie).limit(k)


def sample_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def union_distinct(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs).distinct()


def union_signals(
    signals: dict[str, DataFrame], required: StructType, renames: dict[str, str] | None = None
) -> DataFrame:
    """UNION ALL of views with different columns.

    Keeps the ``required`` columns; a view that lacks one contributes a typed
    NULL. ``signal_type`` is the view's name. ``renames`` maps a source column to
    the required column it may stand for, e.g. window_start -> ts.
    """
    branches = []
    for name, df in signals.items():
        have = {new: old for old, new in (renames or {}).items() if old in df.columns}
        have |= {c: c for c in df.columns}
        cols = [
            (F.col(have[f.name]) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in required.fields
        ]
        branches.append(df.select(*cols, F.lit(name).alias("signal_type")))
    return reduce(lambda a, b: a.unionByName(b), branches)


def signals_long(
    df: DataFrame, keep: Sequence[str], specs: Sequence[tuple[str, Column, Column, int]]
) -> DataFrame:
    """One row per (row, fired signal) in a single pass instead of one scan per signal.

    Each spec is (signal name, condition, amount, priority).
    """
    fired = F.array(
        *[
            F.when(cond, F.struct(
                amt.alias("amt"), F.lit(name).alias("signal_type"), F.lit(prio).alias("priority")))
            for name, cond, amt, prio in specs
        ]
    )
    return df.select(*keep, F.inline(F.array_compact(fired)))


def set_ops(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """Membership of every key in either set: intersection, both differences."""
    tagged = a.select(*on, F.lit(1).alias("ia"), F.lit(0).alias("ib")).unionByName(
        b.select(*on, F.lit(0).alias("ia"), F.lit(1).alias("ib")))
    return tagged.groupBy(*on).agg(
        (F.max("ia") == 1).alias("in_a"), (F.max("ib") == 1).alias("in_b"))


def adhoc(spark: SparkSession, views: dict[str, DataFrame], sql: str) -> DataFrame:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)
