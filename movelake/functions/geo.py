"""Great-circle distance and grid cells as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km; the same formula is used by the oracle."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = F.radians(_c(lat2) - _c(lat1))
    dlmb = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def grid_cell(x, size_deg: float) -> Column:
    return F.floor(_c(x) / F.lit(float(size_deg))).cast("long")
