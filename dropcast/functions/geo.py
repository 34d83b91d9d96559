"""Geographic column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS-84 ellipsoid.
WGS84_A_KM = 6378.137
WGS84_F = 1 / 298.257223563
MEAN_EARTH_RADIUS_KM = 6371.0088
KM_PER_DEGREE_LAT = 111.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def geodesic_km(lat1, lng1, lat2, lng2) -> Column:
    """Ellipsoidal (WGS-84) distance in km by Lambert's closed-form formula.

    Missing or out-of-range latitudes give 0.0, as does a zero distance.
    The guards act on the inputs (NULL-ing them) and the formula itself is
    branch-free, so common-subexpression elimination can share the repeated
    terms inside one generated function. With h = haversine of the reduced
    latitudes: sin^2(s/2) = h, cos^2(s/2) = 1 - h, sin(s) = 2 sqrt(h(1-h)).
    """
    lat1, lng1, lat2, lng2 = map(_c, (lat1, lng1, lat2, lng2))
    la1 = F.when(F.abs(lat1) <= 90.0, lat1)
    la2 = F.when(F.abs(lat2) <= 90.0, lat2)
    lo1 = F.when(~F.isnan(lng1), lng1)
    lo2 = F.when(~F.isnan(lng2), lng2)
    b1 = F.atan((1 - WGS84_F) * F.tan(F.radians(la1)))
    b2 = F.atan((1 - WGS84_F) * F.tan(F.radians(la2)))
    sq = F.sin((b2 - b1) / 2)
    sl = F.sin(F.radians(lo2 - lo1) / 2)
    h = F.least(sq * sq + F.cos(b1) * F.cos(b2) * sl * sl, F.lit(1.0))
    sigma = 2 * F.asin(F.sqrt(h))
    sin_sigma = 2 * F.sqrt(h * (1 - h))
    sp = F.sin((b1 + b2) / 2)
    cp = F.cos((b1 + b2) / 2)
    cq = F.cos((b2 - b1) / 2)
    x = F.try_divide((sigma - sin_sigma) * sp * sp * cq * cq, 1 - h)
    y = F.try_divide((sigma + sin_sigma) * cp * cp * sq * sq, h)
    return F.coalesce(WGS84_A_KM * (sigma - WGS84_F / 2 * (x + y)), F.lit(0.0))


def haversine_km(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle distance on the mean-radius sphere."""
    lat1, lng1, lat2, lng2 = map(_c, (lat1, lng1, lat2, lng2))
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * MEAN_EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def bearing_deg(lat1, lng1, lat2, lng2) -> Column:
    """Initial compass bearing in [0, 360)."""
    lat1, lng1, lat2, lng2 = map(_c, (lat1, lng1, lat2, lng2))
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dl = F.radians(lng2 - lng1)
    x = F.sin(dl) * F.cos(p2)
    y = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)
    return F.pmod(F.degrees(F.atan2(x, y)) + 360.0, F.lit(360.0))


def bearing_sin(bearing) -> Column:
    return F.sin(F.radians(_c(bearing)))


def bearing_cos(bearing) -> Column:
    return F.cos(F.radians(_c(bearing)))


def coordinate_diffs(lat1, lng1, lat2, lng2) -> dict[str, Column]:
    """Absolute degree differences and their sum (Manhattan proxy)."""
    lat1, lng1, lat2, lng2 = map(_c, (lat1, lng1, lat2, lng2))
    lat_diff = F.abs(lat2 - lat1)
    lng_diff = F.abs(lng2 - lng1)
    return {"lat_diff": lat_diff, "lng_diff": lng_diff, "manhattan_proxy": lat_diff + lng_diff}


def offset_point(lat, lng, distance_km, angle_rad, bounds: dict | None = None) -> dict[str, Column]:
    """Point at ``distance_km`` and angle from (lat, lng), optionally clipped to bounds.

    Flat-earth step: dlat = d/111 * cos(angle), dlng = d/(111 * cos(lat)) * sin(angle).
    """
    lat, lng, d, a = map(_c, (lat, lng, distance_km, angle_rad))
    new_lat = lat + d / KM_PER_DEGREE_LAT * F.cos(a)
    new_lng = lng + d / (KM_PER_DEGREE_LAT * F.cos(F.radians(lat))) * F.sin(a)
    if bounds:
        new_lat = clip(new_lat, bounds["lat_min"], bounds["lat_max"])
        new_lng = clip(new_lng, bounds["lng_min"], bounds["lng_max"])
    return {"lat": new_lat, "lng": new_lng}


def clip(c, lo, hi) -> Column:
    """Clip keeping NULL as NULL (``least``/``greatest`` would skip NULLs)."""
    c = _c(c)
    lo_c = lo if isinstance(lo, Column) else F.lit(float(lo))
    hi_c = hi if isinstance(hi, Column) else F.lit(float(hi))
    return F.when(c < lo_c, lo_c).when(c > hi_c, hi_c).otherwise(c)


__all__ = [
    "geodesic_km", "haversine_km", "bearing_deg", "bearing_sin", "bearing_cos",
    "coordinate_diffs", "offset_point", "clip",
]
