"""Small scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column, then=1, other=0) -> Column:
    """CASE WHEN cond THEN then ELSE other: an unknown condition yields ``other``."""
    wrap = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(cond, wrap(then)).otherwise(wrap(other))


def round3(c) -> Column:
    return F.round(_col(c), 3)


def least_strict(a, b) -> Column:
    """LEAST that is NULL when either side is NULL (Spark's own skips NULLs)."""
    a, b = _col(a), _col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def coalesce0(c) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def ratio(num: Column, den: Column, empty: float | None = None) -> Column:
    """num / den as DOUBLE, ``empty`` when the denominator is zero."""
    fallback = F.lit(empty).cast("double")
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(fallback)


def review_priority(total, amt, scale: int = 1000, cap: float = 9999.0) -> Column:
    """Priority tier first, capped amount within the tier."""
    amount = _col(amt).cast("double")
    return _col(total).cast("double") * F.lit(float(scale)) + least_strict(amount, F.lit(cap))


def json_field(c, path: str, type_: str = "string") -> Column:
    """Typed field of JSON text through VARIANT; NULL for malformed text."""
    return F.try_variant_get(F.try_parse_json(_col(c)), path, type_)
