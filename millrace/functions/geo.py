"""Positions, units, regions and grid cells as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Named boxes as (min lat, max lat, min lon, max lon) of the ingest regions.
REGION_BOXES = {
    "EUROPE": (35.0, 72.0, -25.0, 45.0),
    "NORTH_AMERICA": (7.0, 72.0, -168.0, -60.0),
    "SOUTH_AMERICA": (-56.0, 15.0, -90.0, -30.0),
    "ASIA": (-10.0, 82.0, 45.0, 180.0),
    "AUSTRALIA": (-50.0, -10.0, 110.0, 180.0),
    "AFRICA": (-35.0, 37.0, -20.0, 52.0),
    "GLOBAL": (-90.0, 90.0, -180.0, 180.0),
}

# Boxes of the flight report regions, in the same order of bounds.
REPORT_BOXES = {
    "europe": (35.0, 60.0, -12.0, 30.0),
    "north-america": (24.0, 50.0, -125.0, -66.0),
    "australia": (-44.0, -10.0, 112.0, 154.0),
}

# Longitude bands of the regional tables; bands overlap and one wraps at the date line.
LONGITUDE_BANDS = {
    "americas": [(-170.0, -30.0)],
    "emea": [(-30.0, 75.0)],
    "apac": [(60.0, 180.0), (-180.0, -120.0)],
}

# Unit factors.
FEET_PER_METRE = 3.28084
KNOTS_PER_MPS = 1.94384
FPM_PER_MPS = 196.85
EARTH_RADIUS_M = 6371000.0


def region_box(name: str, boxes: dict[str, tuple] | None = None) -> tuple:
    boxes = REGION_BOXES if boxes is None else boxes
    if name not in boxes:
        raise ValueError(f"unknown region {name!r}; known: {', '.join(sorted(boxes))}")
    return boxes[name]


def in_box(lat: Column, lon: Column, box: tuple) -> Column:
    """Inclusive bounding box; plain comparisons, so it reaches the parquet scan."""
    south, north, west, east = box
    return lat.between(south, north) & lon.between(west, east)


def in_band(lon: Column, spans: list[tuple[float, float]]) -> Column:
    out = F.lit(False)
    for west, east in spans:
        out = out | lon.between(west, east)
    return out


def grid_cell(lat: Column, lon: Column, degrees: float) -> Column:
    """Id of the square cell of the given width, as ``row:column``.

    Counts per cell are comparable between runs, not with hexagonal cells.
    """
    row, col = F.floor(lat / degrees).cast("bigint"), F.floor(lon / degrees).cast("bigint")
    return F.concat_ws(":", row.cast("string"), col.cast("string"))


def sphere_point(lat: Column, lon: Column, alt: Column) -> dict[str, Column]:
    """Geocentric coordinates in earth radii: x to latitude 0 and longitude 0, y to longitude 90 east, z to the north pole.

    The altitude in metres is added to the radius of a spherical earth.
    """
    phi, lam = F.radians(lat), F.radians(lon)
    radius = 1 + alt / EARTH_RADIUS_M
    return {"x": radius * F.cos(phi) * F.cos(lam), "y": radius * F.cos(phi) * F.sin(lam), "z": radius * F.sin(phi)}


def metres_to_feet(col: Column) -> Column:
    return col * FEET_PER_METRE


def mps_to_knots(col: Column) -> Column:
    return col * KNOTS_PER_MPS


def mps_to_fpm(col: Column) -> Column:
    return col * FPM_PER_MPS


def degree_minutes(value: Column, axis: str) -> Column:
    """``48° 21.36' N``: the angle in hundredths of a minute, split again, so 59.999' becomes the next degree."""
    letters = {"lat": ("N", "S"), "lon": ("E", "W")}[axis]
    hundredths = F.round(F.abs(value) * 6000).cast("bigint")
    side = F.element_at(F.array(*map(F.lit, letters)), F.when(value < 0, 2).otherwise(1))
    return F.format_string("%d° %.2f' %s", F.floor(hundredths / 6000), (hundredths % 6000) / 100, side)


def dead_reckoning(lat: Column, lon: Column, track: Column, speed: Column, seconds: float) -> dict[str, Column]:
    """Where a great circle leads in so many seconds: degrees, the longitude from -180 to below 180; null without course or speed."""
    phi, course = F.radians(lat), F.radians(track)
    angle = speed * seconds / EARTH_RADIUS_M
    # Rounding may lead a little past the pole.
    sine = F.sin(phi) * F.cos(angle) + F.cos(phi) * F.sin(angle) * F.cos(course)
    ahead = F.asin(F.when(F.abs(sine) > 1, F.signum(sine)).otherwise(sine))
    turned = F.degrees(F.atan2(F.sin(course) * F.sin(angle) * F.cos(phi), F.cos(angle) - F.sin(phi) * F.sin(ahead)))
    return {"lat_ahead": F.degrees(ahead), "lon_ahead": F.pmod(lon + turned + 180, F.lit(360.0)) - 180}


def best_altitude(geo_alt: Column, baro_alt: Column) -> Column:
    return F.coalesce(geo_alt, baro_alt)
