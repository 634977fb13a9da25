"""Spherical and planar geometry as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6378.137
KM_PER_DEGREE = 111.319
GRID = 0.1


def c(x) -> Column:
    """A column by name, a column as it is, anything else as a literal."""
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def haversine_km(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance, rounded half to even at 1e-8 km."""
    lon1, lat1, lon2, lat2 = c(lon1), c(lat1), c(lon2), c(lat2)
    a = F.pow(F.sin((F.radians(lat1) - F.radians(lat2)) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin((F.radians(lon1) - F.radians(lon2)) / 2), 2)
    return F.rint(2 * F.asin(F.sqrt(a)) * EARTH_KM * 1e8) / 1e8


def haversine(lon1: float, lat1: float, lon2: float, lat2: float) -> float:
    """The same for plain numbers, inside kernels."""
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p1 - p2) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((math.radians(lon1) - math.radians(lon2)) / 2) ** 2
    return round(2 * math.asin(math.sqrt(a)) * EARTH_KM * 1e8) / 1e8


def cell_id(lon, lat, grade: float = GRID) -> Column:
    """Number of the grid cell, counted along longitude first, from the north-west."""
    lon, lat = c(lon), c(lat)
    n, middle_x, middle_y = 360.0 / grade, (360.0 / grade - 1) / 2, (180.0 / grade - 1) / 2
    x = F.when(lon < 0, F.lit(middle_x) - F.floor(F.abs(lon / grade))).otherwise(F.lit(middle_x) + F.ceil(lon / grade))
    y = F.when(lat < 0, F.lit(middle_y) + F.ceil(F.abs(lat / grade))).otherwise(F.lit(middle_y) - F.floor(lat / grade))
    return (x + y * n).cast("long")


def near_cells(lon, lat, radius_km: float, grade: float = GRID) -> Column:
    """The distinct cells that may hold a point within ``radius_km``: steps of one cell in both directions, longitudes wrapped, latitudes beyond the poles left out."""
    lon, lat = c(lon), c(lat)
    steps_y = int(radius_km / (KM_PER_DEGREE * grade)) + 1
    widest = F.greatest(F.cos(F.radians(F.least(F.abs(lat) + steps_y * grade, F.lit(89.9)))), F.lit(1e-3))
    steps_x = F.least((F.floor(radius_km / (KM_PER_DEGREE * grade * widest)) + 1).cast("int"), F.lit(int(180 / grade)))
    xs = F.transform(F.sequence(-steps_x, steps_x), lambda i: lon + i * grade)
    ys = F.filter(F.transform(F.sequence(F.lit(-steps_y), F.lit(steps_y)), lambda i: lat + i * grade), lambda y: F.abs(y) <= 90)
    wrapped = F.transform(xs, lambda x: F.when(x > 180, x - 360).when(x < -180, x + 360).otherwise(x))
    return F.array_distinct(F.flatten(F.transform(wrapped, lambda x: F.transform(ys, lambda y: cell_id(x, y, grade)))))


def point_in_polygon(lon, lat, vertices) -> Column:
    """Even-odd rule over ``array<struct<lon,lat>>``; edges are half-open in latitude, crossings count strictly west."""
    lon, lat, v = c(lon), c(lat), c(vertices)

    def toggled(inside: Column, i: Column) -> Column:
        a, b = v[i], v[(i + 1) % F.size(v)]
        straddles = (a["lat"] > lat) != (b["lat"] > lat)
        crossing = a["lon"] + (lat - a["lat"]) / (b["lat"] - a["lat"]) * (b["lon"] - a["lon"])
        return F.when(straddles & (crossing < lon), ~inside).otherwise(inside)

    return F.aggregate(F.sequence(F.lit(0), F.size(v) - 1), F.lit(False), toggled)


def centroid(vertices) -> Column:
    """Mean of the vertices."""
    v = c(vertices)
    mean = lambda name: F.aggregate(v, F.lit(0.0), lambda s, p: s + p[name]) / F.size(v)
    return F.struct(mean("lon").alias("lon"), mean("lat").alias("lat"))


def triangle_area2(ax, ay, bx, by, px, py) -> Column:
    """Twice the signed area of a, b, p."""
    ax, ay, bx, by, px, py = map(c, (ax, ay, bx, by, px, py))
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def lines_cross(ax, ay, bx, by, px, py, qx, qy) -> Column:
    """Whether segments ab and pq meet; touching counts, and so do segments of one line wherever they lie."""
    first = triangle_area2(ax, ay, bx, by, px, py) * triangle_area2(ax, ay, bx, by, qx, qy)
    second = triangle_area2(px, py, qx, qy, ax, ay) * triangle_area2(px, py, qx, qy, bx, by)
    return (first <= 0) & (second <= 0)


def planar_bearing(lon1, lat1, lon2, lat2) -> Column:
    """Degrees by quadrant, 90 to the east and 0 to the south; null without a change of longitude."""
    dx, dy = c(lon2) - c(lon1), c(lat2) - c(lat1)
    slope = F.degrees(F.atan(dy / F.when(dx != 0, dx)))
    return F.when(dx > 0, 90 + slope).when(dx < 0, 270 + slope)


def compass_bearing(lon1, lat1, lon2, lat2) -> Column:
    """Initial great-circle course in degrees from north."""
    p1, p2, dl = F.radians(c(lat1)), F.radians(c(lat2)), F.radians(c(lon2)) - F.radians(c(lon1))
    course = F.degrees(F.atan2(F.sin(dl) * F.cos(p2), F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)))
    return F.pmod(course + 360, F.lit(360.0))


def acute_difference(a, b) -> Column:
    """Difference of two headings, folded to 0..90."""
    d = F.abs(c(a) - c(b)) % 360
    half = F.when(d > 180, 360 - d).otherwise(d)
    return F.when(half > 90, 180 - half).otherwise(half)


def approaching(a, b) -> Column:
    """Headings at most 90 degrees apart, around the circle as well."""
    d = F.abs(c(a) - c(b))
    return (d <= 90) | (d >= 270)


def space_time_km(lon1, lat1, t1, lon2, lat2, t2, weight) -> Column:
    """Distance with time as a third axis scaled by ``weight``."""
    return F.sqrt(F.pow(haversine_km(lon1, lat1, lon2, lat2), 2) + F.pow((c(t1) - c(t2)) * c(weight), 2))


def dot3(a, b) -> Column:
    return F.aggregate(F.zip_with(c(a), c(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cross3(a, b) -> Column:
    a, b = c(a), c(b)
    part = lambda i, j: a[i] * b[j] - a[j] * b[i]
    return F.array(part(1, 2), part(2, 0), part(0, 1))


def cosine3(a, b) -> Column:
    """Cosine between two 3-vectors; null where one is zero."""
    size = F.sqrt(dot3(a, a) * dot3(b, b))
    return dot3(a, b) / F.when(size > 0, size)


def sector_times(distance_km, toward, cog, speed_kmh, radius_km) -> Column:
    """Seconds to enter and leave a circle for a ship whose course lies in its tangent sector; null where it does not."""
    distance, speed = c(distance_km), c(speed_kmh)
    gap = F.abs(c(toward) - c(cog))
    turn = F.when(gap > 180, 360 - gap).otherwise(gap)
    half = F.degrees(F.atan(F.tan(c(radius_km) / F.when(distance > 0, distance))))
    hits = (turn <= half) & (distance > c(radius_km)) & (speed > 0)
    return F.when(hits, F.struct(((distance - radius_km) / speed * 3600).cast("long").alias("enter"), ((distance + radius_km) / speed * 3600).cast("long").alias("leave")))
