"""Great-circle distance and the box that surely contains a circle."""

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import EARTH_RADIUS_KM


def distance_km(latitude: Column, longitude: Column, at_latitude: float, at_longitude: float) -> Column:
    """Haversine distance in km from every row to one point."""
    here_lat, here_lon = F.radians(F.lit(float(at_latitude))), F.radians(F.lit(float(at_longitude)))
    row_lat, row_lon = F.radians(latitude.cast("double")), F.radians(longitude.cast("double"))
    chord = F.pow(F.sin((row_lat - here_lat) / 2), 2) + F.cos(here_lat) * F.cos(row_lat) * F.pow(
        F.sin((row_lon - here_lon) / 2), 2
    )
    # antipodes can give 1 + epsilon, for which asin is not a number
    return F.asin(F.sqrt(F.least(F.lit(1.0), chord))) * (2 * EARTH_RADIUS_KM)


def inside_box(latitude: Column, longitude: Column, at_latitude: float, at_longitude: float, km: float) -> Column:
    """Plain comparisons that hold for every point within ``km``.

    They compare a bare column with literals, so the file scan can skip blocks.
    Rows whose stored coordinates lie beyond the usual ranges are all kept: the
    distance takes them as angles, which repeat. Where the circle covers a pole every longitude qualifies; where it crosses
    the date line the longitudes form two ranges.
    """
    usual = _box(latitude, longitude, at_latitude, at_longitude, km)
    beyond = (longitude < _coordinate(-180)) | (longitude > _coordinate(180))
    return usual | beyond | (latitude < _coordinate(-90)) | (latitude > _coordinate(90))


def _box(latitude: Column, longitude: Column, at_latitude: float, at_longitude: float, km: float) -> Column:
    """The box for rows with usual coordinates, around a point that is brought into the usual ranges."""
    up = (at_latitude + 180) % 360 - 180
    if abs(up) > 90:
        # past a pole the same place has another latitude and the opposite longitude
        up, at_longitude = math.copysign(180, up) - up, at_longitude + 180
    at_latitude, at_longitude = up, (at_longitude + 180) % 360 - 180
    radius = km / EARTH_RADIUS_KM
    reach = math.degrees(radius)
    slack = 1e-6
    box = latitude.between(_coordinate(at_latitude - reach - slack), _coordinate(at_latitude + reach + slack))
    if abs(at_latitude) + reach >= 90 or radius >= math.pi / 2:
        return box
    half_width = math.degrees(math.asin(min(1.0, math.sin(radius) / math.cos(math.radians(at_latitude))))) + slack
    west, east = at_longitude - half_width, at_longitude + half_width
    if half_width >= 180:
        return box
    if west < -180:
        return box & ((longitude >= _coordinate(west + 360)) | (longitude <= _coordinate(east)))
    if east > 180:
        return box & ((longitude >= _coordinate(west)) | (longitude <= _coordinate(east - 360)))
    return box & longitude.between(_coordinate(west), _coordinate(east))


def _coordinate(degrees: float) -> Column:
    """Literal of the stored coordinate type, so that no cast lands on the column."""
    return F.lit(max(-999.0, min(999.0, degrees))).cast("decimal(10,7)")
