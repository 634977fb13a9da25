"""Queries that have to read every point, against brute force over the whole table."""

import math
from collections import defaultdict

import pytest

from tidewake.operators import compress
from tidewake.plans import registry
from tidewake.sources.fixtures import points

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tracks(spark):
    ships = defaultdict(list)
    for r in points(spark, SF).select("mmsi", "t", "event_id", "lon", "lat", "site").collect():
        ships[r["mmsi"]].append(r)
    return {ship: sorted(rows, key=lambda r: (r["t"], r["event_id"])) for ship, rows in ships.items()}


def test_gate_pairs_sees_every_point(spark, tracks):
    expected = set()
    for ship, rows in tracks.items():
        gates = [g for g in ({0: "A", 8: "B", 27: "C"}.get(r["site"]) for r in rows) if g]
        first = (len(gates) + 1) // 2
        if "A" in gates[:first] and "B" in gates[first:] and "C" not in gates:
            expected.add(ship)
    assert expected and {r["mmsi"] for r in registry.QUERIES["gate_pairs"](spark, SF).collect()} == expected


def _km(a, b):
    x1, y1, x2, y2 = map(math.radians, (a["lon"], a["lat"], b["lon"], b["lat"]))
    return 2 * 6378.137 * math.asin(math.sqrt(math.sin((y1 - y2) / 2) ** 2 + math.cos(y1) * math.cos(y2) * math.sin((x1 - x2) / 2) ** 2))


def _length(rows):
    return sum(_km(a, b) for a, b in zip(rows, rows[1:], strict=False))


def _douglas_peucker(rows, limit):
    if len(rows) < 3:
        return rows
    first, last = rows[0], rows[-1]
    base, heights = _km(first, last), []
    for r in rows[1:-1]:
        a, b = _km(first, r), _km(r, last)
        s = (a + b + base) / 2
        heights.append(2 * math.sqrt(max(s * (s - a) * (s - b) * (s - base), 0)) / base if base else a)
    at = max(range(len(heights)), key=heights.__getitem__) + 1
    return _douglas_peucker(rows[: at + 1], limit)[:-1] + _douglas_peucker(rows[at:], limit) if heights[at - 1] > limit else [first, last]


def test_deviation_is_that_of_the_compressors(spark, tracks):
    rows = registry.QUERIES["deviation_compressed"](spark, SF).collect()
    found = {(r["mmsi"], r["method"]): r["deviation"] for r in rows}
    assert len(rows) == 4 * len(tracks) and set(found) == {(ship, m) for ship in tracks for m in compress.METHODS}
    kept = {m: {r["event_id"] for r in registry.QUERIES[f"compress_{m}"](spark, SF).collect()} for m in compress.METHODS}
    for ship, track in tracks.items():
        pieces = _douglas_peucker(track, 0.1)
        assert found[ship, "dp"] == pytest.approx(1 - _length(pieces) / _length(track), abs=2e-6)
        for m, ids in kept.items():
            assert found[ship, m] == pytest.approx(1 - _length([r for r in track if r["event_id"] in ids]) / _length(track), abs=2e-6)
    assert any(found.values())
