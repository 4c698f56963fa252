from .dates import (
    age_years,
    date_part,
    day,
    days_until,
    epoch_bucket,
    micros,
    month_stamp,
    parse_expiry,
    within,
)
from .geo import euclid, geo_cell, geo_cell_hash, l1
from .scalars import coalesce0, flag, json_field, least_strict, ratio, review_priority, round3
from .text import html_to_text

__all__ = [
    "age_years", "coalesce0", "date_part", "day", "days_until", "epoch_bucket", "euclid",
    "flag", "geo_cell", "geo_cell_hash", "html_to_text", "json_field", "l1", "least_strict",
    "micros", "month_stamp", "parse_expiry", "ratio", "review_priority", "round3", "within",
]
