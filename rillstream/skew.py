"""Finding keys too heavy for one task and routing their rows separately.

A window partition is one task, so a key that holds a third of a table cannot go
through an ordinary ``Window.partitionBy(key)``. ``split_hot`` counts rows per
key (a key-column scan with map-side combine) and, only when some key exceeds
the limit, returns the cold and the hot rows as two frames. Operators then use
the plain plan for the cold rows and a time-sliced plan for the hot ones; no row
is dropped or capped on either path.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Rows per key above which the time-sliced plan is used: about what one task
# sorts and scans in a few seconds.
HOT_ROWS = 2_000_000
# Rows aimed at per (key, slice) of a hot key.
SLICE_ROWS = 200_000
# Most slices of a key; the quantiles that bound them are off by a tenth of such a slice at most.
MAX_SLICES = 1024
# A key table with at most this many rows (about 40 bytes each) is broadcast.
BROADCAST_ROWS = 500_000


@dataclass(frozen=True)
class HotSplit:
    cold: DataFrame
    hot: DataFrame | None  # hot rows, with the number of slices of their key in SLICE_COL
    keys: DataFrame | None  # one row per hot key
    n_keys: int
    limit: int | None = None  # no cold key has more rows; None when unchecked
    peak: Decimal | None = None  # largest absolute value of the checked columns


SLICE_COL = "__slices"


def bounded_broadcast(df: DataFrame, n_rows: int) -> DataFrame:
    """Broadcast hint only for a counted, small table; else leave it to AQE."""
    return F.broadcast(df) if n_rows <= BROADCAST_ROWS else df


def key_stats(df: DataFrame, keys: Sequence[str], at: Column, values: Sequence[Column]) -> DataFrame:
    """Rows, rows with a time and largest absolute value per key."""
    peaks = [F.max(F.abs(v)).alias(f"__peak{i}") for i, v in enumerate(values)]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.count(at).alias("__timed"), *peaks)


def hot_keys(stats: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """Keys with more than ``limit`` rows and into how many slices their rows go."""
    slices = F.least(F.ceil(F.col("__timed") / F.lit(SLICE_ROWS)), F.lit(MAX_SLICES))
    return stats.filter(F.col("__n") > F.lit(limit)).select(
        *keys, F.greatest(slices, F.lit(1)).cast("int").alias(SLICE_COL))


def halvings(bounds: Column, most: int) -> Column:
    """The strides of a binary search in ``bounds``: powers of two up to their number, falling."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(most.bit_length()))])
    return F.filter(steps, lambda step: step <= F.size(bounds))


def position(bounds: Column, steps: Column, value: Column) -> Column:
    """How many of the ascending ``bounds`` are at or below ``value``; ``steps`` are their ``halvings``."""
    return F.aggregate(steps, F.lit(0), lambda pos, step: F.when(
        F.get(bounds, pos + step - F.lit(1)) <= value, pos + step).otherwise(pos))


def equi_depth(rows: DataFrame, keys: Sequence[str], at: str, points: DataFrame | None = None) -> DataFrame:
    """Add ``__slice``: the place of ``at`` between approximate quantiles of its key, so a burst of different times
    is cut as finely as it is dense. Equal times share a slice; rows without a time are in the first.

    ``rows`` are those of hot keys with SLICE_COL. ``points`` (keys, SLICE_COL, ``at``) are what the quantiles
    are taken of, if not the rows. A key's quantiles are one row, folded from sketches of all tasks; they are broadcast
    where the counted number of keys, which SLICE_COL has in its metadata, bounds their size.
    """
    grid = F.percentile_approx(at, [k / MAX_SLICES for k in range(1, MAX_SLICES)], F.lit(10 * MAX_SLICES))
    found = (points or rows).groupBy(*keys).agg(grid.alias("__grid"), F.max(SLICE_COL).alias("__parts"))
    every = F.greatest(F.lit(1), F.floor(F.lit(MAX_SLICES) / F.col("__parts"))).cast("int")
    kept = F.array_distinct(F.filter("__grid", lambda _, i: (i + 1) % every == 0))
    bounds = found.select(*[F.col(k).alias(f"__of_{k}") for k in keys], kept.alias("__bounds")).withColumn(
        "__steps", halvings(F.col("__bounds"), MAX_SLICES))
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in keys])
    n_keys = rows.schema[SLICE_COL].metadata.get("keys", BROADCAST_ROWS)
    return rows.join(bounded_broadcast(bounds, n_keys * MAX_SLICES // 5), same).select(  # 8 bytes a bound, not 40
        *rows.columns, position(F.col("__bounds"), F.col("__steps"), F.col(at)).alias("__slice"))


def split_hot(
    df: DataFrame,
    keys: Sequence[str],
    at: Column,
    limit: int | None = HOT_ROWS,
    values: Sequence[Column] = (),
) -> HotSplit:
    """Route rows by how heavy their key is. ``limit=None`` skips the check.

    One job over the key, time and value columns yields a single row: the number
    of hot keys and the largest absolute value.
    """
    keys = list(keys)
    if limit is None:
        return HotSplit(df, None, None, 0)
    stats = key_stats(df, keys, at, values)
    row = stats.agg(
        F.count_if(F.col("__n") > limit).alias("n"),
        *[F.max(f"__peak{i}").alias(f"p{i}") for i in range(len(values))],
    ).first()
    known = [v for v in row[1:] if v is not None]
    peak = max((Decimal(v) for v in known), default=Decimal(0)) if values else None
    if row.n == 0:
        return HotSplit(df, None, None, 0, limit, peak)
    hot = hot_keys(stats, keys, limit)
    # Null-safe: rows with a NULL key form one window partition, which may be hot like any other.
    named = bounded_broadcast(hot.select(*[F.col(k).alias(f"__hot_{k}") for k in keys], SLICE_COL), row.n)
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"__hot_{k}")) for k in keys])
    return HotSplit(
        df.join(named.drop(SLICE_COL), same, "left_anti"),
        df.join(named, same, "inner").select(*df.columns, F.col(SLICE_COL).alias(SLICE_COL, metadata={"keys": row.n})),
        hot.select(*keys),
        row.n,
        limit,
        peak,
    )
