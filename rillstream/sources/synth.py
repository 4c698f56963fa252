"""Distributed synthetic tables from per-field plans.

Every value is a pure function of (row number, field, seed), so a table is
reproducible under any partitioning and a stream of row numbers yields the same
rows as a batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_SYLLABLES = ["ba", "ce", "di", "fo", "gu", "ha", "ke", "li", "mo", "nu", "pa", "re", "si", "to", "vu", "za"]
_AGENTS = ["Mozilla/5.0 (X11; Linux x86_64)", "Mozilla/5.0 (Windows NT 10.0)", "Mozilla/5.0 (Macintosh)"]


@dataclass(frozen=True)
class FieldPlan:
    """How one column is made.

    ``increment`` (default) walks ``bounds`` in steps of ``scale`` and wraps;
    ``uniform`` and ``zipf`` draw from ``bounds``; ``values`` cycles a list.
    Timestamps use the same strategies with bounds as ISO text and a scale in
    milliseconds.
    """

    strategy: str = "increment"
    bounds: Sequence | None = None
    values: Sequence | None = None
    null_pct: int = 0
    scale: int = 1


@dataclass(frozen=True)
class TablePlan:
    rows: int
    fields: dict[str, FieldPlan] = field(default_factory=dict)
    rate: int | None = None  # rows per second when streamed


def _unit(i: Column, name: str, seed: int) -> Column:
    """Uniform in [0, 1) from a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(i, F.lit(name), F.lit(seed)), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def _draw(plan: FieldPlan, lo: int, span: int, i: Column, name: str, seed: int) -> Column:
    u = _unit(i, name, seed)
    if plan.strategy == "uniform":
        pick = F.floor(u * span)
    elif plan.strategy == "zipf":
        # Inverse of the cumulative 1/k law on 1..span.
        pick = F.floor(F.exp(u * F.log(F.lit(float(span + 1))))) - 1
    else:
        pick = F.pmod(i * plan.scale, F.lit(span))
    return F.lit(lo) + F.least(pick, F.lit(span - 1)).cast("bigint")


def _word(i: Column, name: str, seed: int, parts: int) -> Column:
    table = F.array(*[F.lit(s) for s in _SYLLABLES])
    picks = [
        F.element_at(table, (F.floor(_unit(i, f"{name}/{p}", seed) * len(_SYLLABLES)) + 1).cast("int"))
        for p in range(parts)
    ]
    return F.concat(*picks)


def _value(plan: FieldPlan, kind: T.DataType, i: Column, name: str, seed: int) -> Column:
    if plan.values is not None:
        table = F.array(*[F.lit(v) for v in plan.values])
        out = F.element_at(table, (F.pmod(i, F.lit(len(plan.values))) + 1).cast("int"))
    elif plan.strategy == "word":
        out = _word(i, name, seed, 3)
    elif plan.strategy == "name":
        out = F.concat_ws(" ", F.initcap(_word(i, name + "/first", seed, 2)), F.initcap(_word(i, name + "/last", seed, 3)))
    elif plan.strategy == "ipv4":
        out = F.concat_ws(".", *[
            F.floor(_unit(i, f"{name}/{p}", seed) * 256).cast("string") for p in range(4)])
    elif plan.strategy == "user_agent":
        table = F.array(*[F.lit(v) for v in _AGENTS])
        out = F.element_at(table, (F.floor(_unit(i, name, seed) * len(_AGENTS)) + 1).cast("int"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        lo, hi = (int(_utc(b).timestamp() * 1000) for b in plan.bounds or ("1970-01-01", "2070-01-01"))
        out = F.timestamp_millis(_draw(plan, lo, hi - lo, i, name, seed))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        lo, hi = plan.bounds or (0.0, 1.0)
        out = F.lit(float(lo)) + _unit(i, name, seed) * F.lit(float(hi - lo))
    else:
        lo, hi = plan.bounds or (0, 2**62)
        out = _draw(plan, int(lo), int(hi) - int(lo), i, name, seed)
    out = out.cast(kind)
    if plan.null_pct:
        out = F.when(_unit(i, name + "/null", seed) * 100 >= plan.null_pct, out)
    return out


def _utc(text: str) -> dt.datetime:
    at = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
    return at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)


def synth_columns(i: Column, schema: T.StructType, plan: TablePlan, seed: int) -> list[Column]:
    return [
        _value(plan.fields.get(f.name, FieldPlan()), f.dataType, i, f.name, seed).alias(f.name) for f in schema
    ]


def synth(spark: SparkSession, schema: T.StructType, plans: Sequence[TablePlan], seed: int = 0) -> DataFrame:
    """All rows of all plans, generated where they are used."""
    parts = [
        spark.range(p.rows).select(*synth_columns(F.col("id"), schema, p, seed + n)) for n, p in enumerate(plans)
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def synth_stream(spark: SparkSession, schema: T.StructType, plan: TablePlan, seed: int = 0) -> DataFrame:
    """The same rows at ``plan.rate`` rows per second."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", plan.rate or 1).load()
    return ticks.select(*synth_columns(F.col("value"), schema, plan, seed))
