"""Spatial joins that go through grid cells: points to polygons, points to the nearest port, points to the nearest of anything."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.functions.geo import EARTH_KM, GRID, cell_id, haversine_km, near_cells, point_in_polygon
from tidewake.sources.tables import checkpointed

BROADCAST_ROWS = 100_000
RADIUS_KM = 25.0


def small(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` marked for broadcast when it has at most ``limit`` rows, as it is when it has more."""
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def _polygon_cells(polygons: DataFrame, grade: float) -> DataFrame:
    """Each polygon under every cell that its bounding box touches."""
    steps = lambda low, high: F.sequence(F.floor(F.col(low) / grade).cast("int") - 1, F.ceil(F.col(high) / grade).cast("int") + 1)
    cells = F.array_distinct(F.flatten(F.transform(steps("west", "east"), lambda x: F.transform(steps("south", "north"), lambda y: cell_id(x * grade, y * grade, grade)))))
    return polygons.withColumn("cell", F.explode(cells))


def points_in_polygons(points: DataFrame, polygons: DataFrame, grade: float = GRID) -> DataFrame:
    """Every point with every polygon that holds it: the columns of both, by an equi-join on the cell."""
    box = F.col("lon").between(F.col("west"), F.col("east")) & F.col("lat").between(F.col("south"), F.col("north"))
    placed = points.withColumn("cell", cell_id("lon", "lat", grade))
    return placed.join(small(_polygon_cells(polygons, grade)), "cell").filter(box & point_in_polygon("lon", "lat", "vertices")).drop("cell")


def first_polygon(points: DataFrame, polygons: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the first polygon by name of every point that lies in one."""
    return points_in_polygons(points, polygons).groupBy(*keys).agg(F.min("polygon").alias("polygon"))


def port_index(ports: DataFrame, radius_km: float = RADIUS_KM, grade: float = GRID) -> DataFrame:
    """Ports with the cells around them in which a point may be in reach."""
    return ports.withColumn("near", near_cells("port_lon", "port_lat", radius_km, grade))


def ports_in_reach(points: DataFrame, ports: DataFrame, radius_km: float = RADIUS_KM, grade: float = GRID) -> DataFrame:
    """Every point with every port closer than ``radius_km``, and the distance, by an equi-join on the cell."""
    index = port_index(ports, radius_km, grade).withColumn("cell", F.explode("near")).drop("near")
    met = points.withColumn("cell", cell_id("lon", "lat", grade)).join(small(index), "cell").drop("cell")
    return met.withColumn("port_km", haversine_km("lon", "lat", "port_lon", "port_lat")).filter(F.col("port_km") < radius_km)


def nearest_port(points: DataFrame, ports: DataFrame, keys: list[str], radius_km: float = RADIUS_KM, by_level: bool = False) -> DataFrame:
    """``keys``, the nearest port in reach and its distance; the finest level in reach comes first with ``by_level``."""
    order = ([(-F.col("level")).alias("rank")] if by_level else []) + ["port_km", "port"]
    best = ports_in_reach(points, ports, radius_km).groupBy(*keys).agg(F.min(F.struct(*order, "level")).alias("best"))
    return best.select(*keys, F.col("best.port").alias("port"), F.col("best.level").alias("level"), F.col("best.port_km").alias("port_km"))


def nearest_port_boxed(points: DataFrame, ports: DataFrame, keys: list[str], radius_km: float = 20.0, degrees: int = 10) -> DataFrame:
    """``keys`` and the nearest port within ``radius_km`` of all that lie in a box of ``degrees`` around the point, over the antimeridian too; points and ports meet by the cell."""
    apart = F.abs(F.col("lon") - F.col("port_lon"))
    boxed = (F.abs(F.col("lat") - F.col("port_lat")) <= degrees) & ((apart <= degrees) | (apart > 330))
    best = ports_in_reach(points, ports, radius_km).filter(boxed).groupBy(*keys).agg(F.min(F.struct("port_km", "port", "level")).alias("best"))
    return best.select(*keys, F.col("best.port").alias("port"), F.col("best.level").alias("level"), F.col("best.port_km").alias("port_km"))


#: The finest grid of the ring search has so many columns around the globe; each round halves their number.
RING_LEVELS = 12


def _ring_cell(lon: Column, lat: Column, level: int, x: int = 0, y: int = 0) -> Column:
    """The cell of a place at a level, moved by ``x`` and ``y`` cells; null beyond the poles."""
    columns = 1 << (RING_LEVELS - level)
    size = 360.0 / columns
    rows = max(1, columns // 2)
    column = F.pmod(F.floor((lon + 180) / size) + x, F.lit(columns))
    row = F.least(F.floor((lat + 90) / size), F.lit(rows - 1)) + y
    return F.when(row.between(0, rows - 1), row * columns + column).cast("long")


def _beyond_km(lat: Column, level: int) -> Column:
    """What lies outside a place's cell and the eight around it is at least so far away."""
    size = math.radians(360.0 / (1 << (RING_LEVELS - level)))
    east = F.asin(F.lit(math.sin(min(size, math.pi / 2))) * F.cos(F.radians(lat)))
    return F.least(F.lit(size), east) * EARTH_KM * (1 - 1e-9)


def nearest_by_rings(points: DataFrame, targets: DataFrame, order: list[str], eligible: Column | None = None, at: tuple[str, str] = ("target_lon", "target_lat")) -> DataFrame:
    """Every row of ``points`` with ``best``: distance in ``km`` and the columns ``order`` of its nearest target that is ``eligible``, null without one.

    Rows and targets meet in a cell or the eight around it.  A row whose best distance is no more than what lies
    outside is settled; the others go on with cells of twice the size, until the cells go around the globe.  So no
    row meets all targets unless none is nearer, and the result is exact.  ``points`` has ``lon, lat``.
    """
    here, there = (F.col("lon"), F.col("lat")), tuple(F.col(c) for c in at)
    km = haversine_km(*here, *there)
    good = F.lit(True) if eligible is None else eligible
    columns, rest, done = points.columns, points.withColumn("_row", F.monotonically_increasing_id()), None
    rest = checkpointed(rest)
    for level in range(RING_LEVELS):
        around = F.array_distinct(F.array(*[_ring_cell(*here, level, x, y) for x in (-1, 0, 1) for y in (-1, 0, 1)]))
        asked = rest.withColumn("_cell", F.explode(F.filter(around, lambda c: c.isNotNull())))
        met = asked.join(small(targets.withColumn("_cell", _ring_cell(*there, level))), "_cell").filter(good)
        found = met.groupBy("_row").agg(F.min(F.struct(km.alias("km"), *order)).alias("best"))
        last = level == RING_LEVELS - 1
        tried = checkpointed(rest.join(found, "_row", "left").withColumn("_settled", F.lit(last) | F.coalesce(F.col("best.km") <= _beyond_km(F.col("lat"), level), F.lit(False))))
        settled = tried.filter("_settled").select(*columns, "best")
        done = settled if done is None else done.unionByName(settled)
        rest = tried.filter("not _settled").drop("best", "_settled")
        if last or rest.isEmpty():
            return done


def stop_ports(stops: DataFrame, polygons: DataFrame, ports: DataFrame, keys: list[str]) -> DataFrame:
    """Polygon of a stop, else the nearest port in reach, else nulls; ``stops`` has ``lon, lat``."""
    inside = first_polygon(stops, polygons, keys)
    rest = stops.join(inside, keys, "left_anti")
    near = nearest_port(rest, ports, keys)
    named = inside.select(*keys, "polygon", F.lit(None).cast("long").alias("port")).unionByName(near.select(*keys, F.lit(None).cast("string").alias("polygon"), "port"))
    return stops.join(named, keys, "left")
