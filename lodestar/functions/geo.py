"""Points on a sphere, expressed with built-in math functions only.

A point is kept as two DOUBLE columns (longitude, latitude); Spark has no
geography type.  Distances use the haversine great-circle formula; joins
use unit-sphere x/y/z and the chord length, which needs no trigonometry per
pair (see ``operators.spatial``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Fixed value: mean Earth radius in metres used for spherical distances.
EARTH_RADIUS_M = 6371008.8


def valid_point(lon, lat) -> Column:
    """True when both coordinates are present and in range."""
    lo, la = as_col(lon), as_col(lat)
    return (lo.isNotNull() & la.isNotNull() & lo.between(-180.0, 180.0)
            & la.between(-90.0, 90.0))


def geo_point(lon, lat) -> Column:
    """``struct(lon, lat)`` - longitude first - or NULL if not a valid point."""
    lo, la = as_col(lon).cast("double"), as_col(lat).cast("double")
    return F.when(valid_point(lo, la), F.struct(lo.alias("lon"), la.alias("lat")))


def unit_vector(lon, lat) -> list[Column]:
    """x, y, z of the point on the unit sphere (NULL for invalid points)."""
    lo, la = as_col(lon), as_col(lat)
    ok = valid_point(lo, la)
    phi, lam = F.radians(la), F.radians(lo)
    return [
        F.when(ok, F.cos(phi) * F.cos(lam)),
        F.when(ok, F.cos(phi) * F.sin(lam)),
        F.when(ok, F.sin(phi)),
    ]


def haversine_m(lon1, lat1, lon2, lat2, radius_m: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres (NULL if any coordinate is NULL)."""
    p1, p2 = F.radians(as_col(lat1)), F.radians(as_col(lat2))
    dphi = p2 - p1
    dlam = F.radians(as_col(lon2)) - F.radians(as_col(lon1))
    h = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlam / 2), 2)
    return F.lit(2.0 * radius_m) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def within_radius(lon1, lat1, lon2, lat2, metres: float,
                  radius_m: float = EARTH_RADIUS_M) -> Column:
    """Inclusive distance test, never NULL: a missing point is not within."""
    ok = valid_point(lon1, lat1) & valid_point(lon2, lat2)
    return F.coalesce(ok & (haversine_m(lon1, lat1, lon2, lat2, radius_m) <= F.lit(float(metres))),
                      F.lit(False))


def chord_limit_sq(metres: float, radius_m: float = EARTH_RADIUS_M) -> float:
    """Squared unit-sphere chord equal to an arc of ``metres``:
    arc <= r  <=>  chord^2 <= (2 sin(r / 2R))^2."""
    half = min(metres / (2.0 * radius_m), math.pi / 2)
    return (2.0 * math.sin(half)) ** 2
