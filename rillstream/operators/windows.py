"""Trailing windows, previous-row lookups and time windows.

``rolling`` evaluates any number of trailing RANGE aggregates over one
partition/order in a single pass. Frames are inclusive at both ends and include
rows with an equal time, as SQL RANGE frames are.

Two plans give identical results:

* cold keys: Spark window functions, one Exchange and one Sort for all horizons; a
  trailing sum is the difference of two running sums, so time is linear in the rows;
* hot keys: every row becomes one arrival (+value) and, per horizon, one expiry
  (-value) just after it leaves the frame. A trailing sum is then a running sum,
  which splits at any point in time: (key, slice) totals are pre-aggregated, their
  running total is the carry into each slice, and slices run in parallel.

Running sums are subtracted in both plans, so summed values must be integral or DECIMAL.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import timedelta
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.dates import micros
from ..skew import HOT_ROWS, SLICE_COL, HotSplit, equi_depth, split_hot

EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.BooleanType)


@dataclass(frozen=True)
class Trailing:
    """One trailing aggregate.

    ``horizon`` is a timedelta for a time axis or a whole number in the unit of a
    numeric axis. ``where`` restricts what is counted or summed (SUM(CASE ...)).
    """

    horizon: timedelta | int
    agg: str = "count"  # count | sum | avg
    value: Column | str | None = None
    where: Column | str | None = None  # a string is SQL text

    def bound(self) -> int:
        if isinstance(self.horizon, timedelta):
            return self.horizon // timedelta(microseconds=1)
        return int(self.horizon)

    def inputs(self) -> dict[str, Column]:
        """The additive inputs this aggregate needs."""
        where = F.expr(self.where) if isinstance(self.where, str) else self.where
        hit = F.lit(True) if where is None else F.coalesce(where, F.lit(False))
        if self.agg == "count":
            seen = hit if self.value is None else hit & self._value().isNotNull()
            return {"n": F.when(seen, F.lit(1)).otherwise(F.lit(0)).cast("bigint")}
        value = self._value()
        if self.where is not None:
            value = F.when(hit, value).otherwise(F.lit(0))
        return {"s": value, "n": value.isNotNull().cast("bigint")}

    def _value(self) -> Column:
        return F.col(self.value) if isinstance(self.value, str) else self.value

    def result(self, sums: dict[str, Column]) -> Column:
        if self.agg == "count":
            return sums["n"]
        total = F.when(sums["n"] > 0, sums["s"])
        if self.agg == "sum":
            return total
        if self.agg == "avg":
            return total.cast("double") / sums["n"].cast("double")
        raise ValueError(f"unsupported trailing aggregate {self.agg!r}")


def days(n: float) -> timedelta:
    return timedelta(days=n)


def time_axis(df: DataFrame, order: str) -> Column:
    kind = df.schema[order].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return micros(order)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(order).cast("bigint")
    raise TypeError(f"{order}: trailing windows need a time or integral axis, got {kind}")


def _check_exact(df: DataFrame, specs: dict[str, Trailing]) -> None:
    for name, spec in specs.items():
        if spec.agg != "count":
            kind = df.select(spec.inputs()["s"].alias("s")).schema["s"].dataType
            if not isinstance(kind, EXACT):
                raise TypeError(f"{name}: cast {kind.simpleString()} to DECIMAL or BIGINT first")


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    specs: dict[str, Trailing],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add one trailing aggregate column per entry of ``specs``."""
    _check_exact(df, specs)
    parts = split_hot(df, keys, time_axis(df, order), hot_rows, decimal_values(df, specs))
    return rolling_parts(parts, keys, order, specs)


def decimal_values(df: DataFrame, specs: dict[str, Trailing]) -> list[Column]:
    """The DECIMAL values that are summed."""
    values = {str(s.value): s._value() for s in specs.values() if s.agg != "count"}
    kinds = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values.values())]).schema if values else []
    return [v for v, f in zip(values.values(), kinds) if isinstance(f.dataType, T.DecimalType)]


def fits_long(parts: HotSplit, scale: int) -> bool:
    """True when no cold key's sum can leave 64 bits, counted in units of 10^-scale."""
    if parts.limit is None or parts.peak is None or scale > 18:
        return False
    return parts.peak * parts.limit * 10**scale < 2**62 and parts.peak * 10**scale < 10**17


def rolling_parts(
    parts: HotSplit, keys: Sequence[str], order: str, specs: dict[str, Trailing]
) -> DataFrame:
    out = rolling_plain(parts.cold, keys, order, specs, parts)
    if parts.hot is not None:
        sliced = rolling_sliced(parts.hot, keys, order, specs)
        out = out.unionByName(sliced.select(*out.columns))
    return out


def rolling_plain(df, keys, order, specs, parts: HotSplit | None = None) -> DataFrame:
    """Difference of two running sums: everything up to now minus everything before the frame.

    Both have an unbounded start, which Spark extends row by row, so a partition
    costs its number of rows; a sliding frame would be summed anew for each row.
    DECIMAL values are summed as 64-bit units where ``parts`` proves that they fit.
    """
    inputs: dict[str, tuple[str, Column]] = {}  # equal inputs are summed once
    wanted: dict[str, dict[str, tuple[str, int]]] = {}
    for name, spec in specs.items():
        for part, c in spec.inputs().items():
            acc, _ = inputs.setdefault(str(c), (f"__acc{len(inputs)}", c))
            wanted.setdefault(name, {})[part] = (acc, spec.bound())

    rows = df.select("*", time_axis(df, order).alias("__at"), *[
        F.coalesce(c, F.lit(0)).alias(a) for a, c in inputs.values()])
    scales = {
        a: rows.schema[a].dataType.scale for a, _ in inputs.values()
        if isinstance(rows.schema[a].dataType, T.DecimalType) and parts is not None
        and fits_long(parts, rows.schema[a].dataType.scale)
    }
    kinds = {a: _sum_type(rows.schema[a].dataType) for a, _ in inputs.values()}
    if scales:
        # At most 18 digits, so neither the cast nor the product loses any.
        rows = rows.withColumns({
            a: (F.col(a).cast(T.DecimalType(18, s)) * F.lit(Decimal(10**s))).cast("bigint") for a, s in scales.items()})
    # SQL text keeps the many small expressions to one call each.
    over = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)} ORDER BY __at RANGE BETWEEN UNBOUNDED PRECEDING AND"
    pairs = sorted({pair for parts in wanted.values() for pair in parts.values()})
    rows = rows.selectExpr(
        *[f"`{c}`" for c in df.columns], "__at",
        *[f"sum({a}) {over} CURRENT ROW) AS {a}_now" for a, _ in inputs.values()],
        *[f"coalesce(sum({a}) {over} {h + 1} PRECEDING), 0) AS {a}_{h}" for a, h in pairs])
    # Rows without a time are one another's peers and have nothing before them.
    trailing = {}
    for a, h in pairs:
        total = F.expr(f"{a}_now - CASE WHEN __at IS NULL THEN 0 ELSE {a}_{h} END")
        if a in scales:
            total = total.cast(T.DecimalType(19, 0)) * F.lit(Decimal(1).scaleb(-scales[a]))
        trailing[a, h] = total.cast(kinds[a])
    results = [
        specs[name].result({part: trailing[pair] for part, pair in parts.items()}).alias(name)
        for name, parts in wanted.items()
    ]
    return rows.select(*df.columns, *results)


def rolling_sliced(df: DataFrame, keys: Sequence[str], order: str, specs: dict[str, Trailing]) -> DataFrame:
    """The hot-key plan. ``df`` carries the number of slices of its key in SLICE_COL.

    Slices hold about equally many arrivals and expiries, as both count in their bounds.
    """
    keys = list(keys)
    columns = [c for c in df.columns if c != SLICE_COL]
    accs = [(name, k, c) for name, spec in specs.items() for k, c in spec.inputs().items()]
    acc_names = [f"__{k}_{name}" for name, k, _ in accs]
    horizons = sorted({spec.bound() for spec in specs.values()})

    typed = df.select(
        *[F.col(k) for k in keys],
        F.col(SLICE_COL),
        time_axis(df, order).alias("__at"),
        F.struct(*columns).alias("__row"),
        *[
            F.coalesce(c, F.lit(0)).alias(a)
            for a, (_, _, c) in zip(acc_names, accs)
        ],
    )
    row_type = typed.schema["__row"].dataType
    kinds = {a: typed.schema[a].dataType for a in acc_names}

    def event(at: Column, kind: int, row: Column, value: Callable[[str, str], Column]) -> Column:
        return F.struct(
            at.alias("__t"),
            F.lit(kind).alias("__kind"),
            row.alias("__row"),
            *[value(name, a).cast(kinds[a]).alias(a) for a, (name, _, _) in zip(acc_names, accs)],
        )

    arrival = event(F.col("__at"), 0, F.col("__row"), lambda _, a: F.col(a))
    expiries = [
        event(
            F.col("__at") + F.lit(h),
            1,
            F.lit(None).cast(row_type),
            lambda name, a, h=h: -F.col(a) if specs[name].bound() == h else F.lit(0),
        )
        for h in horizons
    ]
    events = typed.select(*keys, SLICE_COL, F.inline(F.array(arrival, *expiries)))
    points = typed.select(*keys, SLICE_COL, F.explode(F.array(
        F.col("__at"), *[F.col("__at") + F.lit(h) for h in horizons])).alias("__t"))
    events = equi_depth(events, keys, "__t", points)

    totals = events.groupBy(*keys, "__slice").agg(
        *[F.sum(a).alias(f"__tot{a}") for a in acc_names]
    )
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carries = totals.select(
        *keys,
        "__slice",
        *[F.coalesce(F.sum(f"__tot{a}").over(before), F.lit(0)).alias(f"__in{a}") for a in acc_names],
    )
    # Null-safe: keys and times may be NULL, as in any SQL window partition.
    left, right = events.alias("e"), carries.alias("c")
    on = reduce(
        lambda x, y: x & y,
        [F.col(f"e.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "__slice"]],
    )
    joined = left.join(right, on).select("e.*", *[f"c.__in{a}" for a in acc_names])

    within = Window.partitionBy(*keys, "__slice").orderBy("__t", "__kind").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = joined.withColumns(
        {f"__run{a}": F.sum(a).over(within) + F.col(f"__in{a}") for a in acc_names}
    ).filter(F.col("__kind") == 0)

    by_spec: dict[str, dict[str, Column]] = {}
    for a, (name, k, _) in zip(acc_names, accs):
        kind = _sum_type(kinds[a])
        by_spec.setdefault(name, {})[k] = F.col(f"__run{a}").cast(kind)
    return running.select(
        "__row.*", *[specs[name].result(sums).alias(name) for name, sums in by_spec.items()]
    )


def _sum_type(kind: T.DataType) -> T.DataType:
    """Result type of SUM over ``kind``, so that both plans agree."""
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(38, kind.precision + 10), kind.scale)
    return T.LongType()


def rolling_where(df, cond: Column, keys, order: str, horizon, name: str = "n", hot_rows=HOT_ROWS):
    """Trailing count over the rows that satisfy ``cond`` only."""
    return rolling(df.filter(cond), keys, order, {name: Trailing(horizon)}, hot_rows)


def peak(df, key: str, order: str, horizon, cond: Column | None = None, hot_rows=HOT_ROWS) -> DataFrame:
    """Largest trailing count each key ever reaches."""
    counted = rolling(df, [key], order, {"__n": Trailing(horizon, where=cond)}, hot_rows)
    return counted.groupBy(key).agg(F.max("__n").alias("peak"))


def engagement(df: DataFrame, entity: str, order: str, watch: str, hot_rows=HOT_ROWS) -> DataFrame:
    """Trailing hour, day and week count and average watch time per entity."""
    spans = {"h": timedelta(hours=1), "d": days(1), "w": days(7)}
    specs = {f"interaction_len_{s}": Trailing(h) for s, h in spans.items()}
    specs |= {f"average_watch_time_{s}": Trailing(h, "avg", watch) for s, h in spans.items()}
    return rolling(df, [entity], order, specs, hot_rows)


def lag_cols(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    cols: dict[str, str],
    tie: str,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add the previous row's values; equal times are ordered by ``tie``."""
    parts = split_hot(df, keys, time_axis(df, order), hot_rows)
    return lag_parts(parts, keys, order, cols, tie)


def lag_parts(parts: HotSplit, keys, order, cols: dict[str, str], tie: str) -> DataFrame:
    out = lag_plain(parts.cold, keys, order, cols, tie)
    if parts.hot is not None:
        out = out.unionByName(lag_sliced(parts.hot, keys, order, cols, tie).select(*out.columns))
    return out


def lag_plain(df, keys, order, cols, tie) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(time_axis(df, order), tie)
    return df.withColumns({new: F.lag(old).over(w) for new, old in cols.items()})


def lag_sliced(df: DataFrame, keys, order, cols: dict[str, str], tie: str, keep_slice: bool = False) -> DataFrame:
    """Previous-row lookup for hot keys: within a slice, else the last row before it."""
    keys = list(keys)
    out_cols = [c for c in df.columns if keep_slice or c != SLICE_COL]
    rows = equi_depth(df.withColumn("__at", time_axis(df, order)), keys, "__at")
    payload = F.struct(*[F.col(old).alias(new) for new, old in cols.items()])
    last = rows.groupBy(*keys, "__slice").agg(
        F.max_by(payload, F.struct("__at", tie)).alias("__last")
    )
    carry = last.select(
        *keys,
        "__slice",
        F.lag("__last").over(Window.partitionBy(*keys).orderBy("__slice")).alias("__carry"),
    )
    on = reduce(
        lambda x, y: x & y,
        [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in [*keys, "__slice"]],
    )
    joined = rows.alias("r").join(carry.alias("c"), on).select("r.*", "c.__carry")
    w = Window.partitionBy(*keys, "__slice").orderBy("__at", tie)
    joined = joined.withColumn("__prev", F.lag(payload).over(w)).withColumn(
        "__prev", F.coalesce("__prev", "__carry")
    )
    return joined.select(*out_cols, *[F.col(f"__prev.{new}").alias(new) for new in cols])


def step_delta(df: DataFrame, series: str, step: str, col: str) -> DataFrame:
    """Change of a cumulative series since its previous step, and its running peak.

    The first step reports its whole value.
    """
    w = Window.partitionBy(series).orderBy(step)
    return df.withColumns(
        {
            f"new_{col}": F.col(col) - F.coalesce(F.lag(col).over(w), F.lit(0)),
            f"max_{col}": F.max(col).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )


def hop(df: DataFrame, ts: str, size: str, slide: str) -> DataFrame:
    """One row per covering window, with its bounds."""
    return _with_bounds(df, F.window(ts, size, slide))


def tumble(df: DataFrame, ts: str, size: str) -> DataFrame:
    return _with_bounds(df, F.window(ts, size))


def _with_bounds(df: DataFrame, window: Column) -> DataFrame:
    return (
        df.withColumn("__w", window)
        .withColumns({"window_start": F.col("__w.start"), "window_end": F.col("__w.end")})
        .drop("__w")
    )
