"""Great-circle and drawing geometry as column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth radius in km, drawing scale in km per degree, default city centre.
EARTH_RADIUS_KM = 6371.0088
KM_PER_DEGREE = 111.0
CENTRE_LAT = 51.0447
CENTRE_LON = -114.0719


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    lat1, lon1, lat2, lon2 = map(_lit, (lat1, lon1, lat2, lon2))
    half_lat = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2.0)
    half_lon = F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2.0)
    chord = half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def bearing_deg(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing from point 1 to point 2, clockwise from north, in [0, 360)."""
    lat1, lon1, lat2, lon2 = map(_lit, (lat1, lon1, lat2, lon2))
    phi1, phi2, turn = F.radians(lat1), F.radians(lat2), F.radians(lon2 - lon1)
    east = F.sin(turn) * F.cos(phi2)
    north = F.cos(phi1) * F.sin(phi2) - F.sin(phi1) * F.cos(phi2) * F.cos(turn)
    return wrap_degrees(F.degrees(F.atan2(east, north)))


def wrap_degrees(angle: Column) -> Column:
    """Into [0, 360). ``%`` keeps the sign of the dividend, ``pmod`` does not."""
    return F.pmod(angle, F.lit(360.0))


def angular_diff_deg(a, b) -> Column:
    """Smallest absolute angle between two directions, in [0, 180]."""
    return F.abs(wrap_degrees(_lit(a) - _lit(b) + 180.0) - 180.0)


@dataclass(frozen=True)
class Box:
    """Latitude / longitude ranges that hold every point within a radius of a centre."""

    south: float
    north: float
    west: float
    east: float
    all_longitudes: bool

    def contains(self, lat: Column, lon: Column) -> Column:
        """Plain range tests on the raw columns, so they reach the Parquet scan as filters."""
        rows = lat.between(self.south, self.north)
        if self.all_longitudes:
            return rows
        return rows & lon.between(self.west, self.east)


def bounding_box(lat: float, lon: float, radius_km: float, margin_deg: float = 1e-6) -> Box:
    """A box slightly larger than the circle. Circles over a pole or the date line keep all longitudes."""
    arc = radius_km / EARTH_RADIUS_KM
    reach = math.degrees(arc) + margin_deg
    south, north = lat - reach, lat + reach
    across = math.sin(arc) / math.cos(math.radians(lat)) if arc < math.pi / 2 else 2.0
    if south <= -90 or north >= 90 or across >= 1:
        return Box(max(south, -90.0), min(north, 90.0), -180.0, 180.0, True)
    half = math.degrees(math.asin(across)) + margin_deg
    west, east = lon - half, lon + half
    return Box(south, north, west, east, west < -180 or east > 180)


def _linestring(points) -> Column:
    return F.struct(F.lit("LineString").alias("type"), F.array(*points).alias("coordinates"))


def wind_arrow(lat, lon, wind_from, speed, cap: float | None = 0.3) -> Column:
    """LineString pointing where the wind blows to; ``cap=None`` leaves the length unbounded."""
    lat, lon = _lit(lat), _lit(lon)
    length = F.lit(0.05) + speed * 0.04
    if cap is not None:
        length = F.when(speed.isNotNull(), F.least(F.lit(cap), length))
    heading = F.radians(wrap_degrees(wind_from + 180.0))
    end_lat = lat + length * F.cos(heading)
    end_lon = lon + length * F.sin(heading) / F.cos(F.radians(lat))
    return _linestring([F.array(lon, lat), F.array(end_lon, end_lat)])


def ellipse_polygon(lat, lon, major_km, minor_km, direction_deg, vertices: int = 64) -> Column:
    """Rotated ellipse as a Polygon: ``vertices`` angles from 0 to 2*pi inclusive plus the closing point.

    The compass direction is used directly as the rotation angle, as the drawings expect.
    """
    lat, lon = _lit(lat), _lit(lon)
    turn = F.radians(direction_deg)
    lon_scale = F.lit(KM_PER_DEGREE) * F.cos(F.radians(lat))
    step = 2 * math.pi / (vertices - 1)

    def vertex(i: Column) -> Column:
        x = major_km * F.cos(i * step)
        y = minor_km * F.sin(i * step)
        along = x * F.cos(turn) - y * F.sin(turn)
        across = x * F.sin(turn) + y * F.cos(turn)
        return F.array(lon + along / lon_scale, lat + across / KM_PER_DEGREE)

    ring = F.transform(F.sequence(F.lit(0), F.lit(vertices - 1)), vertex)
    closed = F.concat(ring, F.slice(ring, 1, 1))
    return F.struct(F.lit("Polygon").alias("type"), F.array(closed).alias("coordinates"))
