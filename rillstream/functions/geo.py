"""Planar geometry on degrees."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def l1(lat1, lon1, lat2, lon2) -> Column:
    return F.abs(_col(lat1) - _col(lat2)) + F.abs(_col(lon1) - _col(lon2))


def euclid(lat1, lon1, lat2, lon2) -> Column:
    dlat = _col(lat1) - _col(lat2)
    dlon = _col(lon1) - _col(lon2)
    return F.sqrt(dlat * dlat + dlon * dlon)


def geo_cell(lat, lon, scale: int = 10) -> tuple[Column, Column]:
    """Grid cell of a point as two whole numbers."""
    return (
        F.floor(_col(lat) * F.lit(scale)).cast("bigint"),
        F.floor(_col(lon) * F.lit(scale)).cast("bigint"),
    )


def geo_cell_hash(lat, lon, scale: int = 10) -> Column:
    return F.xxhash64(*geo_cell(lat, lon, scale))
