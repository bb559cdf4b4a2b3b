"""Great-circle distance as a column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in metres used for the geodesic distance.
EARTH_RADIUS_M = 6_371_008.8


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    """Haversine distance in metres between two lon/lat points."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    p1, p2 = F.radians(c(lat1)), F.radians(c(lat2))
    dphi = p2 - p1
    dlmb = F.radians(c(lon2)) - F.radians(c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(a))
