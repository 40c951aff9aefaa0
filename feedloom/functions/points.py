"""Locations as ``struct<lat,lon>`` and distances between them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: sphere radius in km used for every published distance.
RADIUS_KM = 6373.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_tokens(c) -> Column:
    """All numbers of a location text, split at commas, blanks and brackets."""
    parts = F.regexp_extract_all(_col(c), F.lit(r"([^,\s()]+)"), F.lit(1))
    return F.transform(parts, lambda x: x.try_cast("double"))


def parse_point(c) -> Column:
    """``(lat, lon)``, ``lat, lon`` or ``lat lon`` to a struct; else NULL."""
    t = number_tokens(c)
    lat, lon = F.try_element_at(t, F.lit(1)), F.try_element_at(t, F.lit(2))
    ok = (F.size(t) == 2) & lat.isNotNull() & lon.isNotNull()
    return F.when(ok, F.struct(lat.alias("lat"), lon.alias("lon")))


def point_text(lat, lon) -> Column:
    """Text form ``(lat, lon)``."""
    return F.concat(F.lit("("), _col(lat).cast("string"), F.lit(", "),
                    _col(lon).cast("string"), F.lit(")"))


def great_circle_km(lat1, lon1, lat2, lon2) -> Column:
    """Haversine distance in km."""
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_lat = F.sin((p2 - p1) / 2)
    half_lon = F.sin((F.radians(_col(lon2)) - F.radians(_col(lon1))) / 2)
    h = half_lat * half_lat + F.cos(p1) * F.cos(p2) * half_lon * half_lon
    return F.lit(2 * RADIUS_KM) * F.atan2(F.sqrt(h), F.sqrt(F.lit(1.0) - h))


def unit_vector(lat, lon) -> tuple[Column, Column, Column]:
    """Position on the unit sphere; straight-line distance orders like the arc."""
    p, q = F.radians(_col(lat)), F.radians(_col(lon))
    return F.cos(p) * F.cos(q), F.cos(p) * F.sin(q), F.sin(p)


def bounding_box(a, b) -> Column:
    """Box (south, west, north, east) of two points."""
    a, b = _col(a), _col(b)
    return F.struct(
        F.least(a["lat"], b["lat"]).alias("south"),
        F.least(a["lon"], b["lon"]).alias("west"),
        F.greatest(a["lat"], b["lat"]).alias("north"),
        F.greatest(a["lon"], b["lon"]).alias("east"),
    )


def box_text(box) -> Column:
    """``south,west,north,east`` as one comma-separated text."""
    box = _col(box)
    return F.concat_ws(",", *[box[k].cast("string")
                              for k in ("south", "west", "north", "east")])
