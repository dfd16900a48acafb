"""Great-circle distance on a sphere, as one built-in expression written in SQL text.

Locations are (lat, lon) in degrees. The distance uses the haversine form with
``a`` clamped to 1 so rounding can never push ``asin`` out of its domain; any NULL
coordinate gives a NULL distance.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
EARTH_RADIUS_M = 6371008.8   # mean Earth radius (IUGG), metres
METRES_PER_MILE = 1609       # the mile used by the business reports
METRES_PER_KM = 1000


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """sin^2(dphi/2) + cos(phi1) cos(phi2) sin^2(dlambda/2) as SQL text, at most 1; NULL if a coordinate is."""
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    # clamp to 1 but keep NULL: least() would skip a NULL and return 1
    return f"CASE WHEN {a} > 1.0D THEN 1.0D ELSE {a} END"


def great_circle_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius_m: float = EARTH_RADIUS_M) -> str:
    return f"{2.0 * radius_m!r}D * asin(sqrt({haversine_sql(lat1, lon1, lat2, lon2)}))"


def great_circle_m(lat1: str, lon1: str, lat2: str, lon2: str, radius_m: float = EARTH_RADIUS_M) -> Column:
    """Distance in metres between two points, given by column names or SQL text; NULL if any coordinate is NULL."""
    return F.expr(great_circle_sql(lat1, lon1, lat2, lon2, radius_m))


def unit_vector_sql(lat: str, lon: str) -> tuple[str, str, str]:
    """Point on the unit sphere; straight-line (chord) distance grows with arc length."""
    phi, lam = f"radians({lat})", f"radians({lon})"
    return f"cos({phi}) * cos({lam})", f"cos({phi}) * sin({lam})", f"sin({phi})"
