"""Density clustering of positions: core points, border points and noise.

A point is core when at least ``least`` points, itself included, lie within ``eps_km``.  Core points within ``eps_km`` of each
other share a cluster, named by its smallest core identifier.  A point that is not core but has a core point in reach is a border
point of the cluster of the nearest one, of the smaller name where two are as near; all others are noise.

Cells are so small that any two points of one are in reach of each other.  A cell with ``least`` points is therefore core
as a whole and no pairs within it are ever looked at; only points of sparser cells count their neighbours, and of those a
cell has fewer than ``least``.  Cells with core points are the nodes of a graph: two of them are joined when some of
their core points are in reach.  The boxes around the quarters of a cell decide most pairs; points meet only where boxes do
not, and Spark may split those joins.  Components come from smallest labels that spread and skip, until none changes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewake.functions.geo import EARTH_KM, haversine_km
from tidewake.sources.tables import checkpointed

QUARTERS = 4
_SAFE = 0.99


def _least_abs(low: Column, high: Column) -> Column:
    return F.when((low <= 0) & (high >= 0), 0.0).otherwise(F.least(F.abs(low), F.abs(high)))


class _Grid:
    """Rows of equal height, each cut into cells of the width that suits its latitude."""

    def __init__(self, eps_km: float):
        self.reach = math.degrees(eps_km / EARTH_KM)
        self.height = self.reach / math.sqrt(2) * _SAFE

    def row(self, lat: Column) -> Column:
        return F.floor((lat + 90) / self.height)

    def width(self, row: Column) -> Column:
        low = row * self.height - 90
        return self.height / F.greatest(F.cos(F.radians(_least_abs(low, low + self.height))), F.lit(1e-6))

    def cell(self, lon: Column, lat: Column) -> Column:
        row = self.row(lat)
        return F.struct(row.alias("y"), F.floor((lon + 180) / self.width(row)).alias("x"))

    def around(self, west: Column, east: Column, south: Column, north: Column) -> Column:
        """All cells within reach of a box, over the antimeridian too."""
        rows = F.sequence(self.row(south - self.reach), self.row(north + self.reach))
        widest = F.greatest(F.cos(F.radians(F.least(F.greatest(F.abs(south), F.abs(north)) + self.reach, F.lit(89.9)))), F.lit(1e-3))
        reach = F.lit(self.reach * 1.001) / widest
        turns = F.filter(F.array(F.lit(0.0), F.lit(-360.0), F.lit(360.0)), lambda d: (east + d + reach >= -180) & (west + d - reach <= 180))
        column = lambda lon, y: F.floor((lon + 180) / self.width(y))
        cells = lambda y, d: F.transform(F.sequence(column(west + d - reach, y), column(east + d + reach, y)), lambda x: F.struct(y.alias("y"), x.alias("x")))
        return F.array_distinct(F.flatten(F.transform(rows, lambda y: F.flatten(F.transform(turns, lambda d: cells(y, d))))))


def _bounds(lower: bool) -> Column:
    """A bound of the distances between points of two boxes, ``a_`` and ``b_``, by the great-circle formula itself."""
    a, b = ({n: F.col(f"{side}_{n}") for n in ("west", "east", "south", "north")} for side in "ab")
    if lower:
        apart = lambda lo, hi: F.greatest(a[lo] - b[hi], b[lo] - a[hi], F.lit(0.0))
        dx = F.least(apart("west", "east"), F.greatest(360 - F.greatest(a["east"] - b["west"], b["east"] - a["west"]), F.lit(0.0)))
        widest = [F.greatest(F.abs(x["south"]), F.abs(x["north"])) for x in (a, b)]
    else:
        apart = lambda lo, hi: F.greatest(a[hi] - b[lo], b[hi] - a[lo])
        dx = F.least(apart("west", "east"), F.lit(180.0))
        widest = [_least_abs(x["south"], x["north"]) for x in (a, b)]
    dy = apart("south", "north")
    h = F.pow(F.sin(F.radians(dy) / 2), 2) + F.cos(F.radians(widest[0])) * F.cos(F.radians(widest[1])) * F.pow(F.sin(F.radians(dx) / 2), 2)
    return 2 * F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * EARTH_KM


def _near(left: DataFrame, right: DataFrame, grid: _Grid, eps_km: float) -> DataFrame:
    """Each row of ``left`` with each of ``right`` within reach: ``id``, the columns of ``right`` and the distance."""
    asked = left.select("id", F.col("lon").alias("from_lon"), F.col("lat").alias("from_lat"), F.explode(grid.around(F.col("lon"), F.col("lon"), F.col("lat"), F.col("lat"))).alias("cell"))
    met = asked.join(right.withColumnRenamed("id", "other"), "cell")
    return met.withColumn("km", haversine_km("from_lon", "from_lat", "lon", "lat")).filter(F.col("km") <= eps_km)


def _cell_links(core: DataFrame, grid: _Grid, eps_km: float) -> DataFrame:
    """Pairs ``a, b`` of cells that hold core points in reach of each other, in both directions."""
    part = lambda name, low, high: F.when(F.col(high) > F.col(low), F.least(F.floor((F.col(name) - F.col(low)) / (F.col(high) - F.col(low)) * QUARTERS), F.lit(QUARTERS - 1))).otherwise(0)
    box = [F.min("lon").alias("west"), F.max("lon").alias("east"), F.min("lat").alias("south"), F.max("lat").alias("north")]
    cells = core.groupBy("cell").agg(*box)
    quarter = (part("lon", "west", "east") * QUARTERS + part("lat", "south", "north")).alias("quarter")
    placed = core.join(cells, "cell").select("id", "lon", "lat", "cell", quarter)
    boxes = checkpointed(placed.groupBy("cell", "quarter").agg(*box))
    sides = ("west", "east", "south", "north")
    a = boxes.select(F.col("cell").alias("a"), F.col("quarter").alias("a_quarter"), *[F.col(s).alias(f"a_{s}") for s in sides], F.explode(grid.around(*map(F.col, sides))).alias("b"))
    b = boxes.select(F.col("cell").alias("b"), F.col("quarter").alias("b_quarter"), *[F.col(s).alias(f"b_{s}") for s in sides])
    pairs = a.join(b, "b").filter("a < b").withColumns({"low": _bounds(True), "high": _bounds(False)}).filter(F.col("low") <= eps_km * (1 + 1e-9))
    pairs = checkpointed(pairs.select("a", "b", "a_quarter", "b_quarter", (F.col("high") <= eps_km * (1 - 1e-9)).alias("sure")))
    sure = pairs.filter("sure").select("a", "b").distinct()
    open_ = pairs.filter("not sure").join(sure, ["a", "b"], "left_anti")
    here = placed.select(F.col("cell").alias("a"), F.col("quarter").alias("a_quarter"), F.col("lon").alias("a_lon"), F.col("lat").alias("a_lat"))
    there = placed.select(F.col("cell").alias("b"), F.col("quarter").alias("b_quarter"), F.col("lon").alias("b_lon"), F.col("lat").alias("b_lat"))
    tried = open_.join(here, ["a", "a_quarter"]).join(there, ["b", "b_quarter"]).filter(haversine_km("a_lon", "a_lat", "b_lon", "b_lat") <= eps_km)
    links = sure.unionByName(tried.select("a", "b").distinct())
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that each of ``nodes`` reaches over ``links`` (``a, b``, in both directions)."""
    links = checkpointed(links)
    labels = checkpointed(nodes.select("node", F.col("node").alias("label")))
    while True:
        spread = links.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("met"))
        lower = labels.join(spread, "node", "left").select("node", F.col("label").alias("before"), F.coalesce(F.least("label", "met"), "label").alias("label"))
        # The label of one's label is as good and further on.
        skip = lower.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        after = checkpointed(lower.join(skip, "label").select("node", "before", F.least("label", "beyond").alias("label")))
        labels = after.select("node", "label")
        if after.filter("label <> before").isEmpty():
            return labels


def density_clusters(points: DataFrame, eps_km: float, least: int) -> DataFrame:
    """``id, kind, cluster`` of every row of ``points`` (``id, lon, lat``, ids distinct): ``core``, ``border`` or ``noise``, the last without a cluster, as rows without a position are."""
    grid = _Grid(eps_km)
    located = points.select("id", "lon", "lat").filter("lon is not null and lat is not null")
    placed = checkpointed(located.withColumn("cell", grid.cell(F.col("lon"), F.col("lat"))))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    sized = placed.join(sizes, "cell")
    dense, sparse = sized.filter(F.col("n") >= least).drop("n"), sized.filter(F.col("n") < least).drop("n")
    enough = _near(sparse, placed, grid, eps_km).groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least).select("id")
    core = checkpointed(dense.unionByName(sparse.join(enough, "id", "left_semi")))
    labels = components(core.select(F.col("cell").alias("node")).distinct(), _cell_links(core, grid, eps_km))
    labelled = core.join(labels, F.col("cell") == F.col("node")).drop("node")
    names = labelled.groupBy("label").agg(F.min("id").alias("cluster"))
    named = checkpointed(labelled.join(names, "label").drop("label"))
    others = sparse.join(enough, "id", "left_anti")
    border = _near(others, named, grid, eps_km).groupBy("id").agg(F.min(F.struct("km", "cluster")).alias("best")).select("id", F.col("best.cluster").alias("cluster"))
    found = named.select("id", F.lit("core").alias("kind"), "cluster").unionByName(border.select("id", F.lit("border").alias("kind"), "cluster"))
    return points.select("id").join(found, "id", "left").withColumn("kind", F.coalesce("kind", F.lit("noise")))
