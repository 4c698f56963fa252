"""Thresholds, horizons and priorities shared by the detectors.

Fixed values: signal names, priorities, horizons, review scale and cap are part
of the result contract and are therefore stated as plain text here.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession

MINUTE = 60
HOUR = 3600
DAY = 86_400


def _priorities() -> dict[str, int]:
    return {
        "gift_card_burst_30d": 3,
        "gift_card_burst_45d": 4,
        "spend_velocity_7d": 1,
        "repeated_displacement": 5,
    }


@dataclass(frozen=True)
class AlertParams:
    """Rolling alert signals and the review ranking built on them."""

    gift_30d: int = 2
    gift_45d: int = 2
    velocity_7d: int = 2
    displaced_3d: int = 2
    far_distance: float = 20.0
    review_scale: int = 1000
    review_cap: float = 9999.0
    priority: dict[str, int] = field(default_factory=_priorities)

    def with_(self, **changes) -> "AlertParams":
        return replace(self, **changes)


@dataclass(frozen=True)
class DetectorParams:
    """Five-signal card detector; the bucket variants reuse the same thresholds."""

    gift_30d: int = 23
    velocity_7d: int = 35
    displaced_3d: int = 25
    fan_out_day: int = 10
    far_distance: float = 0.5
    travel_distance: float = 1.0
    travel_seconds: int = HOUR
    one_bucket_gift: int = 12
    one_bucket_velocity: int = 18
    one_bucket_displaced: int = 13

    def with_(self, **changes) -> "DetectorParams":
        return replace(self, **changes)


@dataclass(frozen=True)
class AccessParams:
    """Access anomaly detectors (window sizes in seconds)."""

    enumeration_window: int = HOUR
    enumeration_folders: int = 20
    hot_folder_window: int = 6 * HOUR
    hot_folder_users: int = 40

    def with_(self, **changes) -> "AccessParams":
        return replace(self, **changes)


@dataclass(frozen=True)
class SkimParams:
    """Signals read from a card-skimming report."""

    probe_amount: float = 5.0
    far_distance: float = 0.5
    travel_seconds: int = HOUR
    rare_share: float = 0.10
    rapid_seconds: int = 10 * MINUTE
    rapid_count: int = 3
    spike_factor: float = 3.0

    def with_(self, **changes) -> "SkimParams":
        return replace(self, **changes)


# What a SQL user calls each parameter: zero-argument constant functions.
SQL_FUNCTIONS = {
    "gb30": ("gift_30d", "INT"),
    "gb45": ("gift_45d", "INT"),
    "sv7": ("velocity_7d", "INT"),
    "disp": ("displaced_3d", "INT"),
    "dist": ("far_distance", "DOUBLE"),
    "review_scale": ("review_scale", "INT"),
    "review_cap": ("review_cap", "DOUBLE"),
}
SQL_PRIORITY_FUNCTIONS = {
    "prio_gb30": "gift_card_burst_30d",
    "prio_gb45": "gift_card_burst_45d",
    "prio_sv7": "spend_velocity_7d",
    "prio_disp": "repeated_displacement",
}


def register_sql_functions(spark: SparkSession, params: AlertParams) -> list[str]:
    """Expose the parameters to SQL text as foldable temporary functions."""
    bodies = {name: (kind, getattr(params, attr)) for name, (attr, kind) in SQL_FUNCTIONS.items()}
    bodies |= {name: ("INT", params.priority[sig]) for name, sig in SQL_PRIORITY_FUNCTIONS.items()}
    for name, (kind, value) in bodies.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS {kind} "
            f"RETURN CAST({value!r} AS {kind})"
        )
    return sorted(bodies)
