"""Great-circle distance and unit-sphere coordinates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres used for every distance.
EARTH_RADIUS_KM = 6371.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_from_radians(
    lat1: Column, lon1: Column, cos_lat1: Column,
    lat2: Column, lon2: Column, cos_lat2: Column,
    radius: float = EARTH_RADIUS_KM,
) -> Column:
    """Haversine distance from coordinates already in radians.

    ``cos_lat*`` are passed in so that a side reused many times (the sites)
    computes its cosine once.  ``1 - a`` is clamped at 0: rounding can push
    ``a`` a hair above 1 for antipodal pairs.
    """
    half_dlat = F.sin((lat2 - lat1) / 2)
    half_dlon = F.sin((lon2 - lon1) / 2)
    a = half_dlat * half_dlat + cos_lat1 * cos_lat2 * (half_dlon * half_dlon)
    return 2 * F.lit(radius) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0))))


def haversine_km(
    lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str,
    radius: float = EARTH_RADIUS_KM,
) -> Column:
    """Great-circle distance in km between two points given in degrees."""
    p1, l1 = F.radians(_col(lat1)), F.radians(_col(lon1))
    p2, l2 = F.radians(_col(lat2)), F.radians(_col(lon2))
    return haversine_from_radians(p1, l1, F.cos(p1), p2, l2, F.cos(p2), radius)


def unit_vector(lat_rad: Column, lon_rad: Column) -> tuple[Column, Column, Column]:
    """Point on the unit sphere for a (lat, lon) in radians.

    Straight-line (chord) distance between two such points grows with the
    great-circle distance, so a nearest-site search can bound candidates with
    a plain 3-D grid and no special cases at the poles or the date line.
    """
    cl = F.cos(lat_rad)
    return cl * F.cos(lon_rad), cl * F.sin(lon_rad), F.sin(lat_rad)


def usable_coordinates(lat: Column | str, lon: Column | str) -> Column:
    """Whether both coordinates (doubles) are finite numbers; never null.

    The one condition for points and sites: values outside the usual ranges
    are numbers and stay.
    """
    def finite(c: Column) -> Column:
        return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))

    return finite(_col(lat)) & finite(_col(lon))
