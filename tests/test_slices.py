"""Scans of cut tracks against the plain scans."""

import random

import pytest
from pyspark.sql import functions as F

from tidewake.operators import stops, trajectory
from tidewake.operators.slices import homed


def _track(rng, ship, n):
    t, lon, lat, rows = 1_700_000_000, 121.0, 30.0, []
    for i in range(n):
        t += rng.choice([0, 1, 60, 600, 3600, 40_000])
        if rng.random() < 0.2:
            lon, lat = lon + rng.uniform(-0.3, 0.3), lat + rng.uniform(-0.3, 0.3)
        lon, lat = lon + rng.gauss(0, 2e-5), lat + rng.gauss(0, 2e-5)
        rows.append((ship, 10_000 * ship + i, t, lon, lat, rng.random()))
    return rows


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(6)
    rows = [r for ship, n in ((1, 600), (2, 80), (3, 1), (4, 2)) for r in _track(rng, ship, n)]
    # A ship that never moves fast: one stretch over all slices.
    rows += [(None, *r[1:]) for r in _track(rng, 9, 70)]
    rows += [(5, 50_000 + i, 1_700_000_000 + 5000 * i, 121.0, 30.0 + 1e-6 * (i % 3), 0.1) for i in range(200)]
    return spark.createDataFrame(rows, "mmsi long, event_id long, t long, lon double, lat double, sog double").repartition(3).cache()


@pytest.mark.parametrize("slice_s", [3_600, 100_000, 1 << 40])
def test_stops_of_cut_ships(points, slice_s):
    ordered = lambda df: sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[1:]))
    plain = ordered(stops.stop_members(points))
    assert ordered(stops.stop_members(points, longest=50, slice_s=slice_s)) == plain and len({r[:1] + r[-1:] for r in plain}) > 20


def test_one_ship_is_spread_over_tasks(points):
    ship = points.filter("mmsi = 1")
    out = homed(ship, ["mmsi"], "t", ["t", "event_id"], lambda before: F.col("t") - before("t") > 30_000, 50_000)
    rows = sorted(out.collect(), key=lambda r: (r["t"], r["event_id"]))
    assert len({r["home"] for r in rows}) > 20
    for a, b in zip(rows, rows[1:], strict=False):
        assert a["home"] == b["home"] or b["t"] - a["t"] > 30_000 and b["home"] == b["t"] // 50_000


def test_captures_of_cut_ships(points, monkeypatch):
    monkeypatch.setattr(trajectory, "SLICE_S", 30_000)
    for seconds in (50, 5400):
        known = points.filter("mmsi is not null")
        plain = sorted(map(tuple, trajectory.greedy_capture(known, seconds).collect()))
        assert sorted(map(tuple, trajectory.greedy_capture(known, seconds, longest=10).collect())) == plain and len(plain) > 20
