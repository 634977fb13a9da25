"""Places along channels against every piece tried in turn."""

import math
import random

import pytest

from tidewake.functions.geo import haversine
from tidewake.operators import channels


def brute(ships, model, reach):
    out = {}
    lines = {}
    for channel, seq, lon, lat, run, _ in sorted(model):
        lines.setdefault(channel, []).append((seq, lon, lat, run))
    for mmsi, lon, lat, cog in ships:
        found = []
        for channel, vertices in lines.items():
            for (seq, x1, y1, s1), (_, x2, y2, s2) in zip(vertices, vertices[1:], strict=False):
                p1, p2, dl = math.radians(y1), math.radians(y2), math.radians(x2 - x1)
                course = math.degrees(math.atan2(math.sin(dl) * math.cos(p2), math.cos(p1) * math.sin(p2) - math.sin(p1) * math.cos(p2) * math.cos(dl))) % 360
                gap = abs(cog - course)
                if min(gap, 360 - gap) >= 90:
                    continue
                k = math.cos(p1)
                dx, dy, px, py = (x2 - x1) * k, y2 - y1, (lon - x1) * k, lat - y1
                f = min(max((px * dx + py * dy) / (dx * dx + dy * dy), 0), 1) if dx or dy else 0.0
                km = haversine(lon, lat, x1 + (x2 - x1) * f, y1 + (y2 - y1) * f)
                if km < reach:
                    found.append((km, channel, seq, s1 + (s2 - s1) * f))
        if found:
            km, channel, _, now = min(found)
            out[mmsi] = (channel, km, now)
    return out


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    rows = []
    for channel in range(6):
        x, y, run = 121 + rng.random(), 30 + rng.random() - 60 * (channel % 2), 0.0
        for seq in range(8):
            rows.append((channel, seq, x, y, run, 3 <= seq <= 5 and channel != 4))
            x, y, run = x + rng.uniform(-0.05, 0.3), y + rng.uniform(-0.2, 0.2), run + rng.uniform(300, 900)
    return [*rows, (9, 0, 121.0, 30.0, 0.0, True)]


def _tables(spark, model, ships):
    return spark.createDataFrame(ships, "mmsi long, lon double, lat double, cog long"), spark.createDataFrame(model, "channel_id long, seq long, lon double, lat double, run_s double, inside boolean")


@pytest.mark.parametrize("reach", [0.5, 1.5, 12.0])
def test_places_along_channels(spark, model, reach):
    rng = random.Random(2)
    ships = []
    for i in range(300):
        _, _, x, y, *_ = rng.choice(model)
        ships.append((i, x + rng.uniform(-0.1, 0.1), y + rng.uniform(-0.1, 0.1), rng.randint(0, 359)))
    got = {r["mmsi"]: r for r in channels.along_channels(*_tables(spark, model, ships), reach).collect()}
    want = brute(ships, model, reach)
    assert set(got) == set(want) and len(want) > 5
    for mmsi, (channel, km, now) in want.items():
        assert got[mmsi]["channel_id"] == channel and abs(got[mmsi]["channel_km"] - km) < 1e-6 and abs(got[mmsi]["now_s"] - now) < 0.01


def test_times_of_the_channel_come_before_the_sector(spark):
    model = [(1, i, 121.0 + 0.1 * i, 30.0, 600.0 * i, 5 <= i <= 7) for i in range(10)]
    ships = [(1, 121.05, 30.001, 90), (2, 121.55, 30.001, 90), (3, 121.05, 30.3, 90), (4, 121.05, 30.001, 270)]
    latest, table = _tables(spark, model, ships)
    from pyspark.sql import functions as F

    got = {r["mmsi"]: r for r in channels.forecast(latest, table, 121.6, 30.0, 10.0, F.lit(20.0)).collect()}
    assert (got[1]["channel_id"], round(got[1]["enter_s"]), round(got[1]["leave_s"])) == (1, 2700, 3900)
    # Inside its gates, across the circle, and against the channel: by course and speed, if at all.
    assert all(got[m]["channel_id"] is None for m in got if m != 1)
    gates = channels.gates(table).collect()
    assert [(r["gate_in_s"], r["gate_out_s"]) for r in gates] == [(3000.0, 4200.0)]
